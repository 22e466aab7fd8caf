"""BibTeX entries to triples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.identifiers import first_doi, hash12, percent
from loomgraph.functions.text import pages, space_normal
from loomgraph.operators.graph import RDF_TYPE, XSD, emitted, schema, triple
from loomgraph.sources.bibtex import people_of


def bib_triples(rows: DataFrame, base: str) -> DataFrame:
    """The triples of entries (see sources.bibtex), a set. A work is named by DOI, key, or the hash of title and year;
    the first field that is there counts, even if it is empty."""
    d = rows.where("entry_type is not null").withColumn("_f", F.map_from_entries(F.array_distinct(F.transform("fields", lambda x: F.struct(x["name"], F.element_at(F.filter("fields", lambda y: y["name"] == x["name"]), -1)["value"])))))
    field = lambda *names: F.coalesce(*(F.try_element_at("_f", F.lit(n)) for n in names))
    some = lambda c: F.when(F.trim(c) != "", F.trim(c))
    doi, key, title, date = first_doi(field("doi")), some(F.col("key")), some(field("title")), some(field("year", "date"))
    root = F.lit(base.rstrip("/"))
    work = F.concat(root, F.lit("/publication/ris/"), F.coalesce(F.concat(F.lit("doi/"), percent(doi)), F.concat(F.lit("bib/"), percent(key)), F.concat(F.lit("hash/"), hash12(F.lower(F.concat(space_normal(F.coalesce(title, F.lit(""))), F.lit("||"), space_normal(F.coalesce(date, F.lit("")))))))))
    named = lambda kind, c: F.when(some(c).isNotNull(), F.concat(root, F.lit(f"/{kind}/"), hash12(F.lower(space_normal(c)))))
    d = d.withColumn("_w", work).withColumn("_pages", pages(field("pages"))).withColumn("_a", people_of(field("author"))).withColumn("_e", people_of(field("editor")))
    w = F.col("_w")

    def person(role: str):
        oid = lambda n: F.lower(n).startswith("https://orcid.org/")
        who = lambda n: F.when(oid(n), n).otherwise(named("person/hash", n))
        return lambda n: F.array(triple(w, schema(role), who(n), "iri"), F.when(~oid(n), triple(who(n), RDF_TYPE, F.lit(schema("Person")), "iri")), F.when(~oid(n), triple(who(n), schema("name"), n)))

    def venue(c, kind="venue", type_="CreativeWork", link="isPartOf"):
        return [triple(named(kind, c), RDF_TYPE, F.lit(schema(type_)), "iri"), triple(named(kind, c), schema("name"), some(c)), triple(w, schema(link), named(kind, c), "iri")]

    return emitted(
        d,
        triple(w, RDF_TYPE, F.lit(schema("CreativeWork")), "iri"),
        triple(w, schema("name"), title),
        triple(w, schema("datePublished"), date),
        triple(w, schema("identifier"), F.concat(F.lit("bibtex:"), key)),
        triple(w, schema("identifier"), F.concat(F.lit("DOI:"), doi)),
        triple(w, schema("sameAs"), F.concat(F.lit("https://doi.org/"), percent(doi, "/:._-;()")), "iri"),
        triple(w, schema("identifier"), F.when(doi.isNull(), F.concat(F.lit("DOI_RAW:"), some(F.regexp_replace(field("doi"), "<[^>]+>", ""))))),
        triple(w, schema("volumeNumber"), some(field("volume"))),
        triple(w, schema("issueNumber"), some(field("number"))),
        triple(w, schema("bookEdition"), some(field("edition"))),
        triple(w, schema("pageStart"), F.col("_pages.start")),
        triple(w, schema("pageEnd"), F.col("_pages.end")),
        triple(w, schema("numberOfPages"), F.col("_pages.n"), datatype=XSD + "integer"),
        triple(w, schema("location"), some(field("location", "address"))),
        *venue(field("journal", "journaltitle", "booktitle")),
        *venue(field("publisher"), "org", "Organization", "publisher"),
        *venue(field("series")),
        *venue(field("collection")),
        lists=(F.flatten(F.transform("_a", person("author"))), F.flatten(F.transform("_e", person("editor")))),
    ).distinct()
