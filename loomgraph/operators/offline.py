"""Enrichment of publications from caches alone: works by DOI or title, DOIs, affiliations and identities of authors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.identifiers import doi_url, search_keys, work_keys
from loomgraph.functions.payloads import WORK
from loomgraph.functions.similarity import block_ratio_of, token_sort_ratio_of
from loomgraph.operators.enrich import best_scored, first_scored, looked_up
from loomgraph.operators.graph import emitted, schema, triple
from loomgraph.operators.publications import doi_identifier

#: Least similarities: of titles, and in percent of names by their sorted tokens.
TITLES_ALIKE, NAMES_ALIKE = 0.80, 75


def cached_works(pubs: DataFrame, works: DataFrame, searches: DataFrame) -> DataFrame:
    """pub, work (see functions.payloads.WORK) of publications (pub, title, doi_sameas, doi_ident): the cached work of the
    DOI, the sameAs one first; else the hit of a cached search whose title is nearest and near enough. Caches hold k and v
    (JSON: a work, a list of works). Publications without a work are left out."""
    rows = pubs.select(F.col("pub").alias("id"), "title", F.coalesce("doi_sameas", "doi_ident").alias("doi"))
    by_doi = looked_up(rows, work_keys(F.col("doi")), works).withColumn("work", F.from_json("v", WORK))
    found = by_doi.where("work is not null").select("id", "work")
    rest = by_doi.where("work is null").select("id", "title")
    hits = looked_up(rest, search_keys(F.col("title")), searches).select("id", "title", F.posexplode(F.from_json("v", f"array<{WORK}>")).alias("position", "work")).where("work is not null")
    name = F.coalesce(F.when(F.col("work.display_name") != "", F.col("work.display_name")), F.col("work.title"), F.lit(""))
    scored = hits.withColumn("other", name).withColumn("score", block_ratio_of("title", "other"))
    return found.unionByName(best_scored(scored, ["id"], "score", "position", TITLES_ALIKE).select("id", "work")).withColumnRenamed("id", "pub")


def matched_authors(found: DataFrame, authors: DataFrame) -> DataFrame:
    """pub, person, authorship: for each author of a publication (pub, person, name) the first authorship of its work whose
    name is near enough."""
    each = found.select("pub", F.posexplode("work.authorships").alias("position", "authorship"))
    met = authors.where("name is not null and name <> ''").select("pub", "person", "name").join(each, "pub").withColumn("other", F.coalesce("authorship.author.display_name", F.lit("")))
    return first_scored(met.withColumn("score", token_sort_ratio_of("name", "other")), ["pub", "person"], "score", "position", NAMES_ALIKE).select("pub", "person", "authorship")


def enriched(pubs: DataFrame, works: DataFrame, searches: DataFrame, authors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The triples of :func:`cached_works` and :func:`matched_authors` (a set) and their counts, one row.

    A DOI is added only where the publication has no DOI identifier; an author gets each different raw affiliation of the
    authorship and the identity of its author.
    """
    found = cached_works(pubs, works, searches).join(pubs.select("pub", "doi_ident"), "pub")
    doi = F.when(F.col("doi_ident").isNull(), doi_identifier(doi_url(F.col("work.doi"))))
    people = matched_authors(found, authors)
    raw = F.transform(F.coalesce("authorship.affiliations", F.array().cast("array<struct<raw_affiliation_string:string>>")), lambda a: F.trim(a["raw_affiliation_string"]))
    people = people.withColumn("raw", F.array_distinct(F.filter(raw, lambda r: r != ""))).withColumn("identity", F.col("authorship.author.id"))
    person = F.col("person")
    triples = emitted(found, triple(F.col("pub"), schema("identifier"), doi)).unionByName(
        emitted(people, triple(person, schema("sameAs"), F.col("identity"), "iri"), lists=(F.transform("raw", lambda r: triple(person, schema("affiliation"), r)),))
    )
    n = lambda df, name, c: df.agg(F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name))
    counts = n(pubs, "publications", F.lit(1)).crossJoin(n(found, "with_work", F.lit(1))).crossJoin(n(found, "dois_added", doi.isNotNull()))  # one row each
    counts = counts.crossJoin(n(people, "authors_enriched", F.col("identity").isNotNull() | (F.size("raw") > 0)))
    return triples.distinct(), counts
