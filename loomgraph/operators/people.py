"""Persons of a graph, and which of them the authors of a work are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.similarity import names_match_of, surname
from loomgraph.functions.text import arrow
from loomgraph.operators.enrich import resolved_authors

#: Candidates of a lower tier count only where a higher one has none.
TIERS = {"explicit_map": 0, "identifier": 1, "unique_name": 2}


def person_records(triples: DataFrame, people: DataFrame) -> DataFrame:
    """person, ids, names (sets) of people (person): the person's own IRI and its sameAs IRIs, and its name literals."""
    rows = triples.where(F.col("p").rlike("^https?://schema[.]org/(name|sameAs)$")).withColumnRenamed("s", "person")
    wanted = people.select("person").distinct()
    facts = rows.join(wanted, "person", "left_semi").groupBy("person").agg(
        F.collect_set(F.when(F.col("p").endswith("sameAs") & (F.col("o_kind") == "iri"), F.col("o"))).alias("same"),
        F.collect_set(F.when(F.col("p").endswith("name") & (F.col("o_kind") == "literal"), F.col("o"))).alias("names"),
    )
    none = F.array().cast("array<string>")
    found = wanted.join(facts, "person", "left")
    return found.select("person", F.array_union(F.array("person"), F.coalesce("same", none)).alias("ids"), F.coalesce("names", none).alias("names"))


def author_candidates(authors: DataFrame, people: DataFrame, records: DataFrame, explicit: DataFrame | None = None) -> DataFrame:
    """paper, author, person, method, tier: which persons of a paper (paper, person) its authors (paper, author, orcid,
    name) may be, by records (see person_records).

    A mapped author (explicit: author, person; one row per author) is that person, if the paper has it, or nobody. Others
    share an identifier or ORCID with the person, or else match one of its names. Every way is an equi-join within the
    paper: on identifiers, on the ORCID at the end of the person's IRI, and on the folded surname before names are compared.
    """
    authors = authors.where("author is not null and author <> ''").select("paper", "author", "orcid", "name").distinct()
    known = people.select("paper", "person").distinct().join(records, "person")
    mapped = authors.sparkSession.createDataFrame([], "author string, person string") if explicit is None else explicit.select("author", "person").distinct()
    free = authors.join(mapped, "author", "left_anti")
    tail = lambda c: F.regexp_extract(c, "([^/]*)$", 1)

    def found(rows: DataFrame, method: str) -> DataFrame:
        return rows.select("paper", "author", "person", F.lit(method).alias("method"), F.lit(TIERS[method]).alias("tier")).distinct()

    by_map = authors.join(mapped, "author").join(people.select("paper", "person").distinct(), ["paper", "person"])
    ids = free.select("paper", "author", F.explode(F.array_compact(F.array("author", F.when(F.col("orcid") != "", F.col("orcid"))))).alias("id"))
    by_id = ids.join(known.select("paper", "person", F.explode("ids").alias("id")), ["paper", "id"])
    orcids = free.where(F.col("orcid") != "").select("paper", "author", tail("orcid").alias("id"))
    by_orcid = orcids.join(known.select("paper", "person", F.regexp_extract("person", "/orcid/([^/]+)$", 1).alias("id")).where("id <> ''"), ["paper", "id"])
    key = arrow(surname)
    named = known.select("paper", "person", F.explode("names").alias("known_as"))
    by_name = free.withColumn("key", key(F.col("name"))).join(named.withColumn("key", key(F.col("known_as"))), ["paper", "key"])
    by_name = by_name.where("key <> ''").where(F.coalesce(names_match_of("known_as", "name"), F.lit(False)))
    return found(by_map, "explicit_map").unionByName(found(by_id.select("paper", "author", "person").unionByName(by_orcid.select("paper", "author", "person")), "identifier")).unionByName(found(by_name, "unique_name"))


def author_report(authors: DataFrame, candidates: DataFrame) -> DataFrame:
    """paper, author, persons, status for each author of a paper: the method of an accepted one, ``ambiguous`` with its
    candidates, ``unresolved``, or ``missing_author_id``."""
    accepted = resolved_authors(candidates)
    low = candidates.groupBy("paper", "author").agg(F.min("tier").alias("tier"))
    best = candidates.join(low, ["paper", "author", "tier"]).groupBy("paper", "author").agg(F.array_join(F.array_sort(F.collect_set("person")), ";").alias("persons"))
    every = authors.select("paper", F.coalesce("author", F.lit("")).alias("author")).distinct()
    rows = every.join(best, ["paper", "author"], "left").join(accepted.select("paper", "author", "method"), ["paper", "author"], "left")
    status = F.when(F.col("author") == "", "missing_author_id").otherwise(F.coalesce("method", F.when(F.col("persons").isNotNull(), "ambiguous"), F.lit("unresolved")))
    return rows.select("paper", "author", F.coalesce("persons", F.lit("")).alias("persons"), status.alias("status"))
