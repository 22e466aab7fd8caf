"""Text functions: titles, keys, types, pages. Column expressions where Spark has them; Arrow functions where it has not."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from loomgraph.functions.nt import strip

ASCII = r"^[\x00-\x7F]*$"


def arrow(f: Callable[[str], object], kind: str = "string") -> Callable[[Column], Column]:
    """A plain function of one text as an Arrow function; null stays null."""

    @pandas_udf(kind)
    def g(x: pd.Series) -> pd.Series:
        return x.map(f, na_action="ignore").astype(object).where(x.notna(), None)

    return g


def space_normal(x: Column) -> Column:
    return strip(F.regexp_replace(x, r"(?U)\s+", " "))


def family_first(x: Column) -> Column:
    """``Given Family`` as ``Family, Given``; with a comma, or a single word, as it is."""
    words = F.filter(F.split(space_normal(x), " "), lambda w: w != "")
    n = F.size(words)
    return F.when(F.contains(x, F.lit(",")) | (n < 2), space_normal(x)).otherwise(F.concat(F.element_at(words, -1), F.lit(", "), F.array_join(F.slice(words, 1, n - 1), " ")))


def title_ascii(x: Column) -> Column:
    """Lower case, then only a-z and digits."""
    return F.regexp_replace(F.lower(x), "[^a-z0-9]", "")


def title_plain(x: Column) -> Column:
    """Only ASCII letters and digits, then lower case."""
    return F.lower(F.regexp_replace(x, "[^A-Za-z0-9]", ""))


def title_key(x: Column) -> Column:
    """Compatibility form, case folded, letters and digits only; ASCII titles stay in the JVM."""
    wide = arrow(lambda t: "".join(c for c in unicodedata.normalize("NFKC", t).casefold() if c.isalnum()))
    return F.when(x.rlike(ASCII), title_ascii(x)).otherwise(wide(F.when(~x.rlike(ASCII), x)))


def plain_text(x: Column) -> Column:
    """For matching organisations: lower case, marks off, & as and, punctuation as space."""
    def f(t: str) -> str:
        t = "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c)).replace("&", " and ")
        return " ".join(re.sub(r"[^\w\s]|_", " ", t).split())

    return arrow(f)(x)


def slug(x: Column) -> Column:
    def f(t: str) -> str:
        t = unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()
        return re.sub(r"[^a-z0-9]+", "-", t).strip("-") or "unknown"

    return arrow(f)(x)


def is_whole(x: Column) -> Column:
    """Whether it is a whole number with or without sign; null is none."""
    return F.coalesce(x.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.lit(False))


def real(x: Column) -> Column:
    """A number, infinity or NaN; null for other texts."""
    return strip(x.cast("string")).try_cast("double")


def iso_day(x: Column) -> Column:
    """A day written YYYY-MM-DD; null for other texts and days that are none."""
    return F.when(x.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(x, "yyyy-MM-dd"))


def tokens_estimated(x: Column) -> Column:
    """A third of the characters, rounded up, at least one."""
    return F.greatest(F.lit(1), F.expr("0") + F.floor((F.length(x) + 2) / 3)).cast("long")


SCHEMA = "https://schema.org/"
#: Parts of type names and the schema type they mean, in order of precedence.
PUBLICATION_TYPES = [
    (("journal", "zeitschrift"), "ScholarlyArticle"), (("konferenz", "conference"), "ScholarlyArticle"), (("buch", "book"), "Book"), (("kapitel", "chapter"), "Chapter"), (("bericht", "report", "tech"), "Report"),
    (("dissertation", "thesis", "qualifikations"), "Thesis"), (("patent",), "Patent"), (("software", "dataset", "daten"), "CreativeWork"),
]


def schema_type(publication: Column, document: Column, types=PUBLICATION_TYPES) -> Column:
    """The local name of the schema.org type guessed from publication type, then document type."""
    p, d = F.lower(F.coalesce(publication, F.lit(""))), F.lower(F.coalesce(document, F.lit("")))
    out = None
    for parts, name in types:
        out = (F if out is None else out).when(p.rlike("|".join(parts)), name)
    return out.when(d.rlike("artikel|article"), "ScholarlyArticle").otherwise("CreativeWork")


def pages(x: Column) -> Column:
    """start, end, n: the ends of a page range, and the number of pages where both are numbers in order. The first dash
    divides; later ones belong to the end."""
    t = F.regexp_replace(space_normal(x), "--|–|—", "-")
    some = lambda c: F.when(c != "", c)
    start, end = some(F.trim(F.substring_index(t, "-", 1))), some(F.trim(F.regexp_extract(t, "^[^-]*-(.*)$", 1)))
    both = start.rlike("^[0-9]+$") & end.rlike("^[0-9]+$")
    a, b = F.when(both, start).try_cast("long"), F.when(both, end).try_cast("long")
    return F.struct(start.alias("start"), end.alias("end"), F.when(b >= a, b - a + 1).alias("n"))
