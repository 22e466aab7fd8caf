"""N-Triples terms: escaping, literals, and line parsing in five dialects. Column expressions only.

All expressions over unbounded text use possessive or negated-class patterns: alternation under a star would recurse in
Java and overflow the stack on long literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LITERAL = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
IRI = r"<([^<>]*+)>"
#: Per dialect: blank node, what follows the final dot, whether blank nodes and comments are allowed.
DIALECTS = {
    "strict": {"bnode": r"_:([A-Za-z0-9_][A-Za-z0-9_-]*+(?:\.++[A-Za-z0-9_-]++)*+)", "space": r"[ \t]*+", "tail": r"(#.*)?"},
    "lenient": {"bnode": r"_:(\S++)", "space": r"\s*+", "tail": r"()"},
    "align": {"bnode": None, "space": " ", "tail": r"()"},
    "smush": {"bnode": r"_:(\S++)", "space": r"\s*+", "tail": r"(.*)"},
}
DIALECTS["projection"] = DIALECTS["lenient"]


def escape(x: Column, mode: str = "minimal") -> Column:
    """minimal: backslash, quote and line ends; full: also backspace, form feed and other controls; plain: backslash,
    quote and newline, then trimmed; json: as JSON strings are escaped, without the quotes."""
    out = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    out = F.replace(out, F.lit("\n"), F.lit("\\n"))
    if mode == "plain":
        return strip(out)
    out = F.replace(F.replace(out, F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    if mode in ("full", "json"):
        out = F.replace(F.replace(out, F.lit("\b"), F.lit("\\b")), F.lit("\f"), F.lit("\\f"))
        rest = [c for c in range(32) if chr(c) not in "\n\r\t\b\f"] + [127] * (mode == "full")
        code = "{:04X}" if mode == "full" else "{:04x}"
        parts = F.array(*(F.struct(F.lit(chr(c)).alias("c"), F.lit("\\u" + code.format(c)).alias("u")) for c in rest))
        some = F.aggregate(parts, out, lambda s, p: F.replace(s, p["c"], p["u"]))
        out = F.when(out.rlike(r"[\x00-\x1F\x7F]"), some).otherwise(out)
    return out


def unescape(x: Column) -> Column:
    """One pass from left to right over the escapes of N-Triples; an unknown escape stays as it is.

    The text is cut before each backslash that begins an escape; every piece is then decoded alone, so that what one
    escape yields is never read as part of another.
    """
    pieces = F.regexp_extract_all(x, F.lit(r"(?s)\\(?:u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)|[^\\]++|\\"), F.lit(0))
    simple = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}

    def decoded(p: Column) -> Column:
        out = F.when(p.rlike(r"^\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8})$"), _character(F.conv(F.substring(p, 3, 8), 16, 10).cast("int"), p))
        for k, v in simple.items():
            out = out.when(p == F.lit("\\" + k), F.lit(v))
        return out.otherwise(p)

    return F.when(F.contains(x, F.lit("\\")), F.array_join(F.transform(pieces, decoded), "")).otherwise(x)


def _character(code: Column, otherwise: Column) -> Column:
    """The character of a code point, by its UTF-8 bytes; surrogates and numbers beyond Unicode stay escaped."""
    tail = lambda shift: F.lpad(F.hex((F.expr("0").cast("int") + F.lit(128) + F.pmod(F.floor(code / F.lit(1 << shift)), F.lit(64))).cast("long")), 2, "0")
    lead = lambda base, shift: F.lpad(F.hex((F.lit(base) + F.floor(code / F.lit(1 << shift))).cast("long")), 2, "0")
    text = (
        F.when(code < 0x80, F.lpad(F.hex(code.cast("long")), 2, "0"))
        .when(code < 0x800, F.concat(lead(0xC0, 6), tail(0)))
        .when(code < 0x10000, F.concat(lead(0xE0, 12), tail(6), tail(0)))
        .otherwise(F.concat(lead(0xF0, 18), tail(12), tail(6), tail(0)))
    )
    valid = (code >= 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(text), "UTF-8")).otherwise(otherwise)


def strip(x: Column) -> Column:
    """Leading and trailing white space of any kind off."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def literal(value: Column, lang: Column | None = None, datatype: Column | None = None, mode: str = "minimal") -> Column:
    """A literal token; a language beats a datatype, null ones are left out."""
    lang, datatype = (F.lit(None).cast("string") if c is None else c for c in (lang, datatype))
    tail = F.when(lang.isNotNull() & (lang != ""), F.concat(F.lit("@"), lang)).when(datatype.isNotNull() & (datatype != ""), F.concat(F.lit("^^<"), datatype, F.lit(">"))).otherwise("")
    return F.concat(F.lit('"'), escape(value, mode), F.lit('"'), tail)


def iri(x: Column) -> Column:
    return F.concat(F.lit("<"), x, F.lit(">"))


def unwrapped(token: Column) -> Column:
    """What stands between angle brackets, null without them."""
    return F.when(token.rlike(r"^<.*>$"), token.substr(F.lit(2), F.length(token) - 2))


def parsed(lines: DataFrame, dialect: str = "lenient", column: str = "value") -> DataFrame:
    """lines with s, s_kind, p, o_kind, o, o_lang, o_dt and comment; all null on lines that are no triple.

    Literals stay escaped. strict raises on a bad line that is neither blank nor a comment; align takes no blank nodes,
    needs single spaces after subject and predicate, and lower-cases the language away (see align_key).
    """
    d = DIALECTS[dialect]
    b, gap = d["bnode"], d["space"]
    node = rf"(?:{IRI}|{b})" if b else rf"{IRI}()"
    term = "|".join([IRI, b or r"(?!)()", LITERAL + r"(?:@([A-Za-z]++(?:-[A-Za-z0-9]++)*+)|\^\^<([^<>]*+)>)?+"])
    # the first characters of subject and object tell their kinds
    pattern = rf"(?s)^\s*+(?=(.)){node}{gap}<([^<>]++)>{gap}(?=(.))(?:{term})\s*+\.\s*+{d['tail'] if b else '()'}\s*$"
    line = F.col(column)
    # all groups by one match: no line of a file holds a line end, so it can stand between them; other texts are asked group by group
    joined = F.split(F.regexp_replace(line, pattern, "\n".join(f"${i}" for i in range(1, 12))), "\n", -1)
    each = F.when(line.rlike(pattern), F.array(*(F.regexp_extract(line, pattern, i) for i in range(1, 12))))
    out = lines.withColumn("_g", F.when(F.contains(line, F.lit("\n")), each).otherwise(joined))
    hit = F.coalesce(F.size("_g") == 11, F.lit(False))
    if dialect == "strict":
        blank = line.rlike(r"^\s*(#.*)?$") | line.isNull()
        bad = F.raise_error(F.concat(F.lit("not a triple: "), F.substring(line, 1, 200))).cast("array<string>")
        out = out.withColumn("_g", F.when(hit | blank, F.col("_g")).otherwise(bad))
    out = out.withColumn("_g", F.when(hit, F.col("_g")))
    part = lambda *i: F.concat(*(F.get("_g", F.lit(k - 1)) for k in i))
    kind = lambda i: F.when(part(i) == "<", "iri").when(part(i) == '"', "literal").when(part(i).isNotNull(), "bnode")
    null = lambda c: F.when(c != "", c)
    return (
        out.withColumn("s_kind", kind(1))
        .withColumn("s", part(2, 3))
        .withColumn("p", part(4))
        .withColumn("o_kind", kind(5))
        .withColumn("o", part(6, 7, 8))
        .withColumn("o_lang", null(part(9)))
        .withColumn("o_dt", null(part(10)))
        .withColumn("comment", null(part(11)))
        .drop("_g")
    )


def align_key(lex: Column, datatype: Column) -> Column:
    """The label key of a literal: lower case outside escapes, the language dropped, the datatype kept."""
    pieces = F.regexp_extract_all(lex, F.lit(r"(?s)\\(?:u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)|[^\\]++|\\"), F.lit(0))
    low = F.when(F.contains(lex, F.lit("\\")), F.array_join(F.transform(pieces, lambda p: F.when(p.startswith("\\"), p).otherwise(F.lower(p))), "")).otherwise(F.lower(lex))
    return F.concat(F.lit('"'), low, F.lit('"'), F.when(datatype.isNotNull(), F.concat(F.lit("^^<"), datatype, F.lit(">"))).otherwise(""))


def written(triples: DataFrame) -> DataFrame:
    """One N-Triples line per triple: value. Blank nodes get their mark, literals their tags."""
    node = lambda c, kind: F.when(kind == "bnode", F.concat(F.lit("_:"), c)).otherwise(iri(c))
    tag = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang"))).when(F.col("o_dt").isNotNull(), F.concat(F.lit("^^<"), F.col("o_dt"), F.lit(">"))).otherwise("")
    obj = F.when(F.col("o_kind") == "literal", F.concat(F.lit('"'), F.col("o"), F.lit('"'), tag)).otherwise(node(F.col("o"), F.col("o_kind")))
    return triples.select(F.concat_ws(" ", node(F.col("s"), F.col("s_kind")), iri(F.col("p")), obj, F.lit(".")).alias("value"))
