"""Fields of JSON payloads: institutions, works, and what language models return. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INSTITUTION = "struct<id:string,ror:string,display_name:string,country_code:string,geo:struct<city:string,country:string,country_code:string,latitude:double,longitude:double>>"
WORK = (
    "struct<id:string,doi:string,title:string,display_name:string,publication_date:string,publication_year:string,primary_location:struct<pdf_url:string>,"
    "authorships:array<struct<author:struct<id:string,display_name:string,orcid:string>,author_position:string,is_corresponding:boolean,"
    "affiliations:array<struct<raw_affiliation_string:string>>,raw_affiliation_strings:array<string>,institutions:array<struct<id:string,ror:string,display_name:string,country_code:string>>>>>"
)


def some(x: Column) -> Column:
    """A text without outer spaces, null for an empty one."""
    return F.when(F.trim(x) != "", F.trim(x))


def institution_places(institution: Column) -> Column:
    """city, country, code, latitude, longitude of an institution (see INSTITUTION); the code is that of the place, else
    of the institution, in capitals."""
    geo = institution["geo"]
    return F.struct(some(geo["city"]).alias("city"), some(geo["country"]).alias("country"), F.upper(F.coalesce(some(geo["country_code"]), some(institution["country_code"]))).alias("code"), geo["latitude"].alias("latitude"), geo["longitude"].alias("longitude"))


def primary_pdf(work: Column) -> Column:
    """The PDF address of a work's primary location, null without one."""
    return some(work["primary_location"]["pdf_url"])


def _typed(value: Column, path: str, kind: str) -> Column:
    """The value at a path of a variant if it has a type, else null."""
    found = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(found) == kind, F.try_variant_get(value, path, "string"))


def output_text(payload: Column) -> Column:
    """The text of a model's JSON response: ``output_text``; else the texts of ``output[].content[]``, a line each; else
    the message of the first choice, a text or a list of texts. Empty if there is none."""
    value = F.try_parse_json(payload)
    listed_in = lambda v, path: F.try_variant_get(v, path, "array<variant>")
    texts_of = lambda a: F.transform(a, lambda c: _typed(c, "$.text", "STRING"))
    blocks = F.flatten(F.filter(F.transform(listed_in(value, "$.output"), lambda o: listed_in(o, "$.content")), lambda c: c.isNotNull()))
    texts = F.filter(texts_of(blocks), lambda t: F.trim(t) != "")
    message = "$.choices[0].message.content"
    several = F.filter(texts_of(listed_in(value, message)), lambda t: t.isNotNull())
    clean = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    listed = lambda a: F.when(F.size(a) > 0, clean(F.array_join(a, "\n")))
    first = clean(_typed(value, "$.output_text", "STRING"))
    return F.coalesce(F.when(first != "", first), listed(texts), clean(_typed(value, message, "STRING")), listed(several), F.lit(""))


def usage_tokens(payload: Column) -> Column:
    """input, output and total tokens of a model's JSON response, each null if it is missing or no number."""
    value = F.try_parse_json(payload)
    one = lambda name: F.floor(F.try_variant_get(value, f"$.usage.{name}_tokens", "double")).cast("long")
    return F.struct(one("input").alias("input"), one("output").alias("output"), one("total").alias("total"))
