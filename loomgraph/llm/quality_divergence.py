"""Quality rules by distribution divergence.

Each document gets two histograms: of character classes, and of the common words of its language against all other
words. They are compared with references of the language by the Jensen-Shannon distance (square root of the divergence
in bits). References are the sums of the histograms over all documents of the language, so they follow the corpus. A
document that is far from its reference fails; guards leave texts alone that are too short for a histogram to mean
anything, and languages without a word list or with too little text for a reference.

Column expressions only. Features are a dozen and a half small counts per document; references are one row per language
of the list below.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.plans.scratch import stored

#: Common words of each language, most frequent first.
COMMON = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}
K = 12
SPACE = r"[\x20\x09-\x0D]+"
#: Character classes, taken off the text one after the other; what is left is the last class.
CLASSES = [r"\p{Ll}+", SPACE, r"[.,]+", r"\p{Lu}+", r"\p{Nd}+", r"[;:?'\"()-]+", r"\p{L}+"]


@dataclass(frozen=True)
class Divergence:
    """Thresholds are Jensen-Shannon distances in [0, 1]."""

    far_chars: float = 0.33
    far_words: float = 0.30
    least_chars: int = 200
    least_words: int = 60
    least_reference: int = 2000
    """Words of a language that a reference needs."""


def features(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, chars and common (arrays of counts).

    A null text has no words and no lines.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumn("_t", text).withColumn("_w", F.array_remove(F.split("_t", SPACE), ""))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("_lines", lines)
    n = F.size("_w")
    # windows of eight words from hashes of one, two and four
    d = d.withColumn("_h", F.when(n >= 8, F.transform("_w", lambda w: F.xxhash64(w))))
    for k in (1, 2, 4):
        m = F.size("_h") - k
        d = d.withColumn("_h", F.zip_with(F.slice("_h", F.lit(1), m), F.slice("_h", F.lit(k + 1), m), lambda a, b: F.xxhash64(a, b)))
    d = d.withColumnRenamed("_h", "_g")
    d = d.withColumn("_twice", F.size(F.array_distinct("_g")) < F.size("_g"))
    d = d.withColumn("_s", F.when(F.col("_twice"), F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    same = lambda x, j: F.coalesce(F.get("_s", j)["g"] == x["g"], F.lit(False))
    d = d.withColumn("_p", F.array_sort(F.transform(F.filter("_s", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate("_p", start, lambda s, p: F.struct((p + 8).alias("end"), (s["n"] + p + 8 - F.greatest(p, s["end"])).alias("n")), lambda s: s["n"])
    left, sizes = F.col("_t"), [F.length("_t")]
    for c in CLASSES:
        left = F.regexp_replace(left, c, "")
        d = d.withColumn(f"_l{len(sizes)}", left)
        left = F.col(f"_l{len(sizes)}")
        sizes.append(F.length(left))
    chars = F.array(*(a - b for a, b in zip(sizes, sizes[1:])), sizes[-1])
    listed = F.create_map(*(x for lang, words in COMMON.items() for x in (F.lit(lang), F.array(*map(F.lit, words)))))
    d = d.withColumn("_list", F.try_element_at(listed, F.coalesce(F.col("lang").cast("string"), F.lit(""))))
    # words of any list first, by one lookup; few are left for the language's own
    any_list = sorted({w for words in COMMON.values() for w in words})
    d = d.withColumn("_c", F.filter(F.transform(F.filter("_w", lambda w: F.lower(w).isin(any_list)), F.lower), lambda w: F.array_contains("_list", w)))
    hits = F.transform("_list", lambda w: F.size(F.filter("_c", lambda c: c == w)))
    n_words, n_repeat = F.size("_w").cast("long"), F.coalesce(covered, F.lit(0)).cast("long")
    return d.select(
        *docs.columns,
        n_words.alias("n_words"),
        (sizes[0] - (sizes[1] - sizes[2])).cast("long").alias("word_chars"),  # less what the second class took
        F.length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        n_repeat.alias("n_repeat_words"),
        ((n_words < 20) | (100 * n_repeat > 30 * n_words)).alias("base_failed"),
        chars.alias("chars"),
        F.concat(hits, F.array(F.size("_w") - F.size("_c"))).alias("common"),
    )


def references(feats: DataFrame, p: Divergence = Divergence()) -> DataFrame:
    """lang, ref_chars, ref_common: one row at most for each language that has a word list."""
    # conditional sums, not a filter: pushed down, that would be spelled out inside the features' lambdas
    total = lambda c, n: F.array(*(F.coalesce(F.sum(F.when(~F.col("base_failed"), F.col(c)[i])), F.lit(0)) for i in range(n))).alias(f"ref_{c}")
    sums = feats.where(F.col("lang").isin(*COMMON)).groupBy("lang").agg(total("chars", len(CLASSES) + 1), total("common", K + 1))
    return sums.where(_sum(F.col("ref_common")) >= p.least_reference)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)


def js_distance(a: str, b: str) -> Column:
    """Jensen-Shannon distance of two histograms, null where one is empty."""
    na, nb = _sum(F.col(a)), _sum(F.col(b))
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(a, b, lambda x, y: part(x / na, (x / na + y / nb) / 2) + part(y / nb, (x / na + y / nb) / 2))
    js = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2
    return F.when((na > 0) & (nb > 0), F.sqrt(F.greatest(js, F.lit(0.0))))


def judged(feats: DataFrame, refs: DataFrame, p: Divergence = Divergence()) -> DataFrame:
    """feats with far_chars, far_words (null: not judged) and kept. refs has a row per listed language: it is broadcast."""
    met = feats.join(F.broadcast(refs), "lang", "left")
    met = met.withColumn("far_chars", F.when(_sum(F.col("chars")) >= p.least_chars, js_distance("chars", "ref_chars")))
    met = met.withColumn("far_words", F.when(F.col("n_words") >= p.least_words, js_distance("common", "ref_common")))
    bad = F.coalesce(F.col("far_chars") > p.far_chars, F.lit(False)) | F.coalesce(F.col("far_words") > p.far_words, F.lit(False))
    return met.drop("ref_chars", "ref_common").withColumn("kept", ~F.col("base_failed") & ~bad)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def quality(docs: DataFrame, params: Divergence = Divergence()) -> DataFrame:
    """doc_id, the base counts, base_failed and kept for each row of docs (doc_id, text, lang).

    A null or empty text has no words and fails the base. A null or unlisted language has no reference: only the base
    decides. Repeated rows are judged alike; extra columns are not read; an empty table gives an empty result.
    """
    feats = stored(features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")).drop("text"), "quality-features")
    return judged(feats, references(feats, params), params).select("doc_id", *COUNTS, "kept")


def passing(docs: DataFrame, params: Divergence = Divergence()) -> DataFrame:
    """The rows of docs that are kept, with docs' columns only. Features are made once and stored beside their rows."""
    feats = stored(features(docs.select(F.struct("*").alias("_row"), "text", "lang")).drop("text"), "quality-rows")
    return judged(feats, references(feats, params), params).where("kept").select("_row.*")


def oracle(p: Divergence = Divergence()) -> str:
    words = r"'[^\x20\x09-\x0D]+'"
    strip = lambda col, c: f"regexp_replace({col}, '{c.replace(chr(39), chr(39) * 2)}', '', 'g')"
    strips, left = [], "t"
    for i, c in enumerate(CLASSES):
        strips.append(f"s{i} as (select *, {strip(left, c)} as l{i} from {f's{i - 1}' if i else 'w'})")
        left = f"l{i}"
    names = ["t", *(f"l{i}" for i in range(len(CLASSES)))]
    chars = ", ".join([*(f"length({a}) - length({b})" for a, b in zip(names, names[1:])), f"length({left})"])
    lists = " ".join(f"when '{k}' then [{', '.join(repr(w) for w in v)}]" for k, v in COMMON.items())
    part = lambda x, m: f"if({x} > 0, {x} * log2({x} / ({m})), 0)"

    def distance(a: str, b: str) -> str:
        x, y = f"({a}[i]::DOUBLE / list_sum({a}))", f"({b}[i]::DOUBLE / list_sum({b}))"
        return f"sqrt(greatest(0, list_sum(list_transform(range(1, len({a}) + 1), lambda i: {part(x, f'({x} + {y}) / 2')} + {part(y, f'({x} + {y}) / 2')})) / 2))"

    sums = lambda c, n: "[" + ", ".join(f"sum({c}[{i}])" for i in range(1, n + 1)) + f"] as ref_{c}"
    return f"""
with w as (select doc_id, lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), {words}) as ws from documents),
{', '.join(strips)},
f as (select doc_id, lang, ws, t, len(ws)::BIGINT as n_words, length({strip('t', SPACE)})::BIGINT as word_chars, (length(t) - length({strip('t', '[#*$%&|<>]')}))::BIGINT as n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {words})) as lines,
  list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' ')) as g,
  [{chars}] as chars, case lang {lists} end as list from s{len(CLASSES) - 1}),
c as (select *, list_filter(list_transform(ws, lambda x: lower(x)), lambda x: list_contains(list, x)) as cs from f),
u as (select *, (len(lines) - len(list_distinct(lines)))::BIGINT as n_dup_lines, list_append(list_transform(list, lambda x: len(list_filter(cs, lambda y: y = x))), len(ws) - len(cs)) as common from c),
e as (select rowid as r, unnest(g) as g, generate_subscripts(g, 1) as i from (select row_number() over () as rowid, g from (select doc_id, g from u where len(g) > len(list_distinct(g))))),
e2 as (select *, count(*) over (partition by r, g) as n from e),
k as (select doc_id, g, row_number() over () as r from (select doc_id, g from u where len(g) > len(list_distinct(g)))),
p as (select r, i, lag(i) over (partition by r order by i) as before from e2 where n > 1),
q as (select r, sum(if(before is null, 8, least(8, i - before))) as n from p group by r),
rep as (select k.doc_id, max(q.n)::BIGINT as n from k join q using (r) group by k.doc_id),
v as (select u.*, coalesce(rep.n, 0)::BIGINT as n_repeat_words from u left join rep using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from v),
refs as (select lang, {sums('chars', len(CLASSES) + 1)}, {sums('common', K + 1)} from b where list is not null and not base_failed group by lang),
j as (select b.*, if(list_sum(chars) >= {p.least_chars}, {distance('chars', 'ref_chars')}, null) as far_chars, if(n_words >= {p.least_words}, {distance('common', 'ref_common')}, null) as far_words
  from b left join (select * from refs where list_sum(ref_common) >= {p.least_reference}) refs using (lang))
select doc_id, {', '.join(COUNTS)}, not base_failed and not coalesce(far_chars > {p.far_chars}, false) and not coalesce(far_words > {p.far_words}, false) as kept from j"""
