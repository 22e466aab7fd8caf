"""Secret scans: candidates by format, false positives removed by a random forest.

A candidate is a run of 12 or more letters, digits and ``+/_~-`` with at least one letter and one digit, or, directly
after a secret word and ``=``, ``:`` or ``is`` (``Bearer`` needs none), the whole value of any length and characters: up to
the closing quote, or without quotes up to the next space, quote or final punctuation. Its features
are its length, its changes between character classes, the share of it that dictionary words cover, whether it stands in
a path, and the words beside it. A random forest trained on labelled findings decides; it is compiled into column
expressions, so that scanning and masking are one narrow projection over the texts.

Labelled findings may be given; otherwise they are made by rule: keys and passwords in the forms that providers and
configuration files use, against commit hashes, checksums, identifiers, paths, addresses and placeholders. The number
of findings is bounded by a parameter; nothing of the corpus is used for training.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "[A-Za-z0-9+/_~-]"
CANDIDATE = f"(?<!{RUN})(?=[A-Za-z+/_~-]*[0-9])(?=[0-9+/_~-]*[A-Za-z]){RUN}{{12,}}={{0,2}}"
#: Words that names, paths and placeholders are made of.
DICTIONARY = (
    "about access account action address admin array article author backup base block book branch build button cache case change check class client code column "
    "commit common config content context control copy count create data date default delete demo device document download dummy email error event example export "
    "fake file filter folder form format function get group handler here home host html http image import index info input insert install invoice item java "
    "json key label language layout length level library line link list local login main make manager master menu message method model module name network "
    "node note number object option order output package page param parent part password path photo picture place plain plugin point print process product "
    "project public python query read record release remote render report request reset resource response result root row sample save schema script search "
    "secret select server service session set shared simple site size sort source start state static status string style sub support system table target task "
    "template test text theme this time title token tool type unit update upload user util value version video view web widget with word work write year your "
    "changed correct disabled empty enabled encrypted expired false generated hidden incorrect invalid kept lost missing needed none null optional protected redacted "
    "required safe sent stored string true undefined unknown used valid weak wrong"
).split()
BEFORE, AFTER = 48, 16
SECRET_WORDS = r"(?i)(passw(or)?d|passphrase|pwd|secret|token|api[_ -]?key|access[_ -]?key(_id)?|auth(orization)?|credentials?|bearer|private[_ -]?key)[\"']?\s*(=|:|is)?\s*[\"']?$"
_WORDS = r"(?:passw(?:or)?d|passphrase|pwd|secret|token|api[_ -]?key|access[_ -]?key(?:_id)?|auth(?:orization)?|credentials?|private[_ -]?key)"
_SAID = rf"(?i:{_WORDS}[\"']?\s{{0,3}}(?:[=:]|(?<=\s)is(?=\s))\s{{0,3}}|bearer\s{{1,3}})"
#: Values directly after secret words, for Java: quoted, then others. The short look-behind first is for speed.
VALUE = rf"(?<=[\"'])(?<={_SAID}\")[^\"\n]+(?=\")|(?<=')(?<={_SAID}')[^'\n]+(?=')|(?<=[=:\s])(?<={_SAID})(?!(?i:bearer)\s)[^\s\"']*[^\s\"'.,;:]"
PLAIN_WORDS = r"(?i)(commit|sha-?[0-9]*|md5|checksum|digest|hash|uuid|guid|id|isbn|doi|version|rev|revision|build|etag|serial|model|ref|order|invoice|branch|tag)[\"']?\s*[=:#]?\s*[\"']?$"
PATH_BEFORE = r"([/\\.@#?&]|://\S*|\b[A-Za-z]:\S*)$"
PATH_AFTER = r"^([/\\@]|\.[A-Za-z0-9]{1,5}\b|\()"
#: How issued keys begin.
ISSUED = r"^((AKIA|ASIA)[0-9A-Z]{16}$|gh[pousr]_|glpat-|xox[abprs]-|sk_live_|AIza|eyJ|npm_|hf_)"
ANY = f"{VALUE}|{CANDIDATE}"
FEATURES = ["length", "changes", "digits", "distinct", "known", "slashes", "joints", "path", "file", "secret_word", "plain_word", "quoted", "issued"]


@dataclass(frozen=True)
class Forest:
    trees: int = 24
    depth: int = 6
    seed: int = 7
    findings: int = 8000
    """Labelled findings that training uses at most."""
    threshold: float = 0.5


def described(c: Column, before: Column, after: Column) -> list[Column]:
    """The features of a candidate with the text before and after it, as doubles in the order of FEATURES."""
    n = F.length(c).cast("double")
    share = lambda x: x.cast("double") / n
    flag = lambda x: x.cast("double")
    changes = "(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]|(?<=[^A-Za-z0-9])[A-Za-z0-9]"
    words = "(" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))) + ")"
    return [
        n,
        share(F.regexp_count(c, F.lit(changes))),
        share(F.length(F.regexp_replace(c, "[^0-9]", ""))),
        share(F.size(F.array_distinct(F.split(c, "")))),
        share(n - F.length(F.regexp_replace(F.lower(c), words, ""))),
        share(F.length(F.regexp_replace(c, "[^/]", ""))),
        share(F.length(F.regexp_replace(c, "[^_-]", ""))),
        flag(before.rlike(PATH_BEFORE)),
        flag(after.rlike(PATH_AFTER)),
        flag(before.rlike(SECRET_WORDS)),
        flag(before.rlike(PLAIN_WORDS)),
        flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        flag(c.rlike(ISSUED)),
    ]


def featured() -> Column:
    """The features of the columns candidate, before and after as a struct."""
    row = F.array(F.struct(F.col("candidate").alias("c"), F.coalesce("before", F.lit("")).alias("b"), F.coalesce("after", F.lit("")).alias("a")))
    return F.transform(row, lambda x: F.struct(*(v.alias(f) for v, f in zip(described(x["c"], x["b"], x["a"]), FEATURES))))[0]


def labelled_findings(spark: SparkSession, n: int) -> DataFrame:
    """n findings by rule: candidate, before, after, label. Every value is a function of the row's number."""
    sha, b64, b62 = F.col("sha"), F.col("b64"), F.col("b62")
    pick = lambda shift, *options: F.element_at(F.array(*(o if isinstance(o, Column) else F.lit(o) for o in options)), F.pmod(F.shiftright("r", shift), F.lit(len(options))).cast("int") + 1)
    word = lambda shift: pick(shift, "user", "get", "page", "module", "data", "image", "test", "config", "report", "service", "update", "index", "with", "und", "pour", "casa", "line", "value")
    num = lambda k: F.pmod("r", F.lit(k)).cast("string")
    prose = pick(3, "of the ", "in and ", "\n", "der die das ", "est la ", "que el ", "see ", ", ", "")
    key = pick(5, "password", "passwd", "token", "api_key", "secret", "access_key", "API-KEY", "Authorization: Bearer", "private key", "pwd")
    join = pick(9, "=", " = \"", ": ", ":", " = '", "=\"", " is ")
    close = pick(9, "", "\"", "", "", "'", "\"", "")
    hexes = F.substring(sha, 1, pick(12, 16, 18, 20, 24, 32, 40, 64).cast("int"))
    random = lambda shift, *sizes: F.substring(b62, 1, pick(shift, *sizes).cast("int"))
    camel = F.concat(word(2), F.initcap(word(7)), F.initcap(word(11)), F.initcap(word(15)), num(40))
    snake = F.concat_ws("_", word(2), word(7), word(11), F.concat(F.lit("v"), num(9)))
    slug = F.concat_ws("-", word(2), word(7), word(11), word(16), F.concat(F.lit("20"), F.lpad(num(25), 2, "0")))
    uuid = F.concat_ws("-", F.substring(sha, 1, 8), F.substring(sha, 9, 4), F.substring(sha, 13, 4), F.substring(sha, 17, 4), F.substring(sha, 21, 12))
    hold = F.call_function("concat_ws", pick(6, "_", "-", ""), pick(2, "your", "example", "test", "change", "dummy", "sample"), pick(8, "token", "password", "key", "secret"), pick(13, "here", "value", "this"), num(1000))
    name = pick(4, "commit ", "sha1: ", "sha256:", "md5 ", "checksum = \"", "ETag: \"", "rev ", "hash: ", "digest=")
    dated = F.concat(pick(2, "invoice", "Order", "IMG", "build", "release", "Fig"), pick(6, "-", "_"), F.lit("20"), F.lpad(num(25), 2, "0"), pick(6, "-", "_"), F.lpad(num(12), 2, "0"), pick(6, "-", "_"), F.lpad(num(28), 2, "0"))
    none = F.lit("")
    letters = F.regexp_replace(b62, "[0-9]", "")
    part = lambda start, shift, *sizes: F.substring(b62, start, pick(shift, *sizes).cast("int"))
    symbol = lambda shift: pick(shift, "&", "!", "$", "#", "%", "*", ".", "?", "^")
    plain = pick(2, "none", "null", "true", "false", "required", "optional", "invalid", "expired", "missing", "wrong", "undefined", "string", "a", "the", "not", "in", "used", "sent", "lost", "self")
    held = pick(2, "${DB_PASSWORD}", "$TOKEN", "<your-password>", "<token>", "{{ secret }}", "getToken()", "config.password", "********", "xxxxxxxx", "......", "your password", "the secret key", "%(password)s", "changeme", "os.environ")
    phrase = F.lower(F.call_function("concat_ws", pick(6, " ", "-", " "), F.substring(letters, 1, 6), F.substring(letters, 7, 5), F.substring(letters, 12, 7), F.substring(letters, 19, 6)))
    kinds = [
        (F.concat(pick(2, "AKIA", "ASIA"), F.substring(F.upper(b62), 1, 16)), pick(7, prose, F.lit("aws_access_key_id = ")), none, 1),
        (hexes, F.concat(prose, key, join), close, 1),
        (random(14, 12, 16, 20, 24, 32, 40), F.concat(prose, key, join), close, 1),
        (F.concat(pick(2, "ghp_", "gho_", "sk_live_", "xoxb-", "glpat-"), random(6, 24, 36)), pick(9, prose, F.concat(key, join)), none, 1),
        (F.concat(F.lit("eyJ"), F.substring(b64, 1, 60)), F.concat(prose, key, join), pick(9, ".", "\""), 1),
        (random(14, 32, 40, 48, 64), prose, F.lit(" "), 1),
        (F.substring(sha, 1, pick(12, 32, 40, 64).cast("int")), F.concat(prose, name), F.lit(" "), 0),
        (uuid, pick(9, prose, F.lit("id: "), F.lit("uuid=")), F.lit(" "), 0),
        (camel, pick(9, prose, F.lit("self."), F.lit("call ")), pick(13, "(", " ", "."), 0),
        (snake, pick(9, prose, F.lit("/usr/lib/"), F.lit("import ")), pick(13, ".py", " ", "("), 0),
        (slug, pick(9, F.lit("https://example.com/"), F.lit("http://www.example.org/de/"), prose), pick(13, ".html", " ", "/"), 0),
        (F.concat_ws("/", word(2), word(7), word(11), F.concat(word(15), num(90))), pick(9, F.lit("/"), F.lit("C:\\\\"), F.lit("./"), prose), pick(13, ".txt", " ", ".so"), 0),
        (hold, F.concat(prose, key, join), close, 0),
        (dated, pick(9, prose, F.lit("order "), F.lit("see ")), pick(13, ".pdf", " ", "."), 0),
        (F.concat(F.substring(sha, 1, 12), F.lit("/"), F.substring(sha, 13, 10)), F.lit("https://cdn.example.net/"), pick(13, ".jpg", ".js", ".css"), 0),
        (random(14, 4, 6, 7, 8, 9, 10, 11), F.concat(prose, key, join), close, 1),
        (F.concat(part(1, 14, 3, 5, 8), symbol(17), part(12, 20, 1, 4, 9), pick(23, symbol(26), none, none)), F.concat(prose, key, join), close, 1),
        (F.when(F.pmod("r", F.lit(2)) == 0, F.lower(F.substring(letters, 1, pick(14, 5, 6, 8, 12, 16, 24).cast("int")))).otherwise(F.substring(letters, 1, pick(14, 5, 6, 8, 12, 16, 24).cast("int"))), F.concat(prose, key, join), close, 1),
        (phrase, F.concat(prose, key, pick(9, "=\"", ": \"", " = \"")), F.lit("\""), 1),
        (F.concat(F.lower(F.substring(letters, 1, pick(14, 4, 6, 8).cast("int"))), num(1000)), F.concat(prose, key, join), close, 1),
        (plain, F.concat(prose, key, join), close, 0),
        (held, F.concat(prose, key, join), close, 0),
        (F.pmod("r", F.lit(1000)).cast("string"), F.concat(prose, key, join), close, 0),
    ]
    out = []
    for k, fields in enumerate(kinds):
        rows = spark.range(k, n, len(kinds), 1).withColumn("sha", F.sha2(F.concat(F.lit("finding "), F.col("id").cast("string")).cast("binary"), 256))
        rows = rows.withColumn("b64", F.base64(F.unhex(F.concat("sha", F.sha2(F.col("sha").cast("binary"), 256)))))
        rows = rows.withColumn("b62", F.regexp_replace("b64", "[+/=]", "")).withColumn("r", F.conv(F.substring("sha", 1, 15), 16, 10).cast("long"))
        candidate, before, after, label = (x if isinstance(x, Column) else F.lit(x) for x in fields)
        out.append(rows.select("id", candidate.alias("candidate"), before.alias("before"), after.alias("after"), label.cast("double").alias("label")))
    return reduce(DataFrame.unionByName, out)


Tree = float | tuple  # a leaf's probability, or (feature, threshold, tree at or below, tree above)


def trained(findings: DataFrame, p: Forest = Forest()) -> list[Tree]:
    """The trees of a forest trained on findings (candidate, before, after, label), of which p.findings are used."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    used = findings.where("candidate is not null and label is not null").orderBy(F.xxhash64("candidate", "before", "after"), "candidate", "before", "after").limit(p.findings).select(featured().alias("x"), "label")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(used.select("x.*", "label"))
    model = RandomForestClassifier(numTrees=p.trees, maxDepth=p.depth, seed=p.seed, featureSubsetStrategy="sqrt", subsamplingRate=0.8).fit(rows)

    def tree(node) -> Tree:
        if node.subtreeDepth() == 0:
            stats = [*node.impurityStats().stats()]
            return stats[1] / sum(stats) if len(stats) > 1 else float(node.prediction())
        split = node.split()
        return split.featureIndex(), split.threshold(), tree(node.leftChild()), tree(node.rightChild())

    return [tree(t._call_java("rootNode")) for t in model.trees]


_forests: dict[Forest, list[Tree]] = {}


def default_forest(spark: SparkSession, p: Forest = Forest()) -> list[Tree]:
    """The forest of the findings made by rule; they are the same everywhere, so it is trained once per process."""
    if p not in _forests:
        _forests[p] = trained(labelled_findings(spark, p.findings), p)
    return _forests[p]


def score(forest: list[Tree], x: Column) -> Column:
    """The mean probability of the trees, for a column of feature structs."""

    def expr(t: Tree) -> Column:
        return F.when(x[FEATURES[t[0]]] <= t[1], expr(t[2])).otherwise(expr(t[3])) if isinstance(t, tuple) else F.lit(float(t))

    return reduce(lambda a, b: a + b, map(expr, forest)) / len(forest)


def scanned(docs: DataFrame, forest: list[Tree], threshold: float = 0.5) -> DataFrame:
    """docs with _gaps (texts around candidates, one more than these) and _hits: array of (candidate, secret)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumn("_found", F.regexp_extract_all(text, F.lit(ANY), 0)).withColumn("_gaps", F.when(F.size("_found") > 0, F.split(text, ANY, -1)).otherwise(F.array(text)))
    features = lambda c, i: F.struct(c.alias("candidate"), *(v.alias(f) for v, f in zip(described(c, F.right(F.get("_gaps", i), F.lit(BEFORE)), F.left(F.get("_gaps", i + 1), F.lit(AFTER))), FEATURES)))
    d = d.withColumn("_described", F.transform("_found", features))
    return d.withColumn("_hits", F.transform("_described", lambda x: F.struct(x["candidate"].alias("candidate"), (score(forest, x) > threshold).alias("secret")))).drop("_found", "_described")


def findings(docs: DataFrame, forest: list[Tree], threshold: float = 0.5) -> DataFrame:
    """doc_id, start, length (code points), candidate, secret: a row for each candidate of docs (doc_id, text).

    A null or empty text has none. Rows are handled alone: repeated rows have their findings repeated; extra columns are
    not read; an empty table gives an empty result.
    """
    d = scanned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), forest, threshold)
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, g: s + F.length(g))
    before = F.transform("_hits", lambda h, i: F.struct((total(F.slice("_gaps", 1, i + 1)) + total(F.slice(F.transform("_hits", lambda x: x["candidate"]), 1, i))).cast("long").alias("start"), h["candidate"].alias("candidate"), h["secret"].alias("secret")))
    rows = d.where(F.size("_hits") > 0).select("doc_id", F.inline(before))
    return rows.select("doc_id", "start", F.length("candidate").cast("long").alias("length"), "candidate", "secret")


MASK = "[SECRET]"


def masked(docs: DataFrame, forest: list[Tree], threshold: float = 0.5, mask: str = MASK) -> DataFrame:
    """docs, all columns, with each secret of the text replaced by the mask; texts without secrets stay as they are, null
    and empty ones too. Rows are handled alone: repeated rows stay repeated, long texts are scanned whole. Other columns
    may have any names; an empty table gives an empty result."""
    d = scanned(docs.select(F.struct("*").alias("_row"), F.col("text").cast("string").alias("text")), forest, threshold)
    said = F.transform("_hits", lambda h: F.when(h["secret"], F.lit(mask)).otherwise(h["candidate"]))
    whole = F.array_join(F.transform("_gaps", lambda g, i: F.concat(g, F.coalesce(F.get(said, i), F.lit("")))), "")
    return d.select(F.col("_row").withField("text", F.when(F.exists("_hits", lambda h: h["secret"]), whole).otherwise(F.col("text"))).alias("_row")).select("_row.*")
