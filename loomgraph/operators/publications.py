"""Publication-level enrichment: DOI, PDF and topic triples, choices among hits, missing addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.identifiers import dblp_pid, serializable
from loomgraph.functions.similarity import block_ratio_of
from loomgraph.operators.enrich import newest
from loomgraph.operators.graph import RDF_TYPE, emitted, schema, triple


def doi_identifier(x: Column) -> Column:
    """``DOI:x`` of a DOI in any written form, null for nothing."""
    core = F.trim(F.regexp_replace(F.regexp_replace(F.trim(x), r"(?i)^https?://(dx\.)?doi\.org/", ""), r"(?i)^doi:\s*", ""))
    return F.when(core != "", F.concat(F.lit("DOI:"), core))


def publication_facts(rows: DataFrame) -> DataFrame:
    """Triples of publications (pub, doi, pdf_url, topics array, has_doi): the DOI only where there is none, the PDF only
    if its address can be written, each topic."""
    pub, url = F.col("pub"), F.trim("pdf_url")
    return emitted(
        rows,
        triple(pub, schema("identifier"), F.when(~F.coalesce("has_doi", F.lit(False)), doi_identifier(F.col("doi")))),
        triple(pub, schema("url"), F.when(serializable(url) & url.rlike("^https?://"), url), "iri"),
        lists=(F.transform("topics", lambda t: triple(pub, schema("about"), t, "iri")),),
    ).distinct()


def preferred_pdfs(rows: DataFrame, limit: int = 0) -> DataFrame:
    """pub, pdf_url: the first address that looks like a PDF, else the first (rows: line_no, pub, pdf_url); of the first
    publications only, in order of their first line, if a limit is given."""
    good = rows.where(F.col("pdf_url").rlike("^https?://")).withColumn("_plain", ~F.lower("pdf_url").rlike(r"\.pdf($|[?#])|/pdf(/|$)"))
    best = good.groupBy("pub").agg(F.min_by("pdf_url", F.struct("_plain", "line_no")).alias("pdf_url"), F.min("line_no").alias("_at"))
    return (best.orderBy("_at", "pub").limit(limit) if limit else best).drop("_at")


def picked_publication(hits: DataFrame, at_least: float = 0.80) -> DataFrame:
    """id and the hit of each wanted publication: an equal DOI first, else the best title ratio, 0.05 more for an equal
    year; the first on ties. hits: id, title, year, doi, position, hit, hit_title, hit_year, hit_doi."""
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    same = (low("doi") != "") & (low("doi") == low("hit_doi"))
    score = F.coalesce(block_ratio_of(low("title"), low("hit_title")), F.lit(0.0)) + F.when(F.col("year") == F.col("hit_year"), 0.05).otherwise(0.0)
    rows = hits.select("id", "hit", same.alias("same"), score.alias("score"), (-F.col("position")).alias("p")).where(F.col("same") | (F.col("score") >= at_least))
    return newest(rows.withColumn("score", F.when(F.col("same"), 9.0).otherwise(F.col("score"))), ["id"], "score", "p", "hit").select("id", "hit")


def picked_author(hits: DataFrame, at_least: float = 0.75) -> DataFrame:
    """id and the hit whose name is nearest (id, name, position, hit, hit_name)."""
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    rows = hits.select("id", "hit", block_ratio_of(low("hit_name"), low("name")).alias("score"), (-F.col("position")).alias("p")).where(F.col("score") >= at_least)
    return newest(rows, ["id"], "score", "p", "hit").select("id", "hit")


def external_authors(rows: DataFrame, internal: DataFrame, base: str) -> DataFrame:
    """Author triples of papers (paper, name, pid_url, affiliations array) for names that are no internal author of the
    paper (paper, name)."""
    new = rows.join(internal.select("paper", "name").distinct(), ["paper", "name"], "left_anti")
    who = F.concat(F.lit(f"{base}/author/dblp/"), F.replace(dblp_pid(F.col("pid_url")), F.lit("/"), F.lit("_")))
    notes = F.array_distinct(F.filter(F.transform("affiliations", lambda x: F.trim(x)), lambda x: x != ""))
    return emitted(
        new,
        triple(who, RDF_TYPE, F.lit(schema("Person")), "iri"),
        triple(who, schema("name"), F.col("name")),
        triple(who, schema("sameAs"), F.col("pid_url"), "iri"),
        triple(F.col("paper"), schema("author"), who, "iri"),
        lists=(F.transform(notes, lambda x: triple(who, schema("affiliation"), x)),),
    ).distinct()


def missing_urls(entries: DataFrame, graph_titles: DataFrame) -> DataFrame:
    """url triples for entries (entry, key, urls array) and the subjects of their title key (key, s, url); an entry any of
    whose subjects has a url already is left out."""
    met = entries.join(graph_titles, "key")
    has = met.groupBy("entry").agg(F.bool_or(F.col("url").isNotNull()).alias("has"), F.array_sort(F.collect_set("s")).alias("subjects"), F.first("urls").alias("urls")).where("not has")
    return has.select(F.explode("subjects").alias("s"), F.lit(schema("url")).alias("p"), "urls").select("s", "p", F.explode(F.array_distinct("urls")).alias("o")).distinct()


def tagged(entries: DataFrame, graph_titles: DataFrame, predicate: str, tag: str) -> DataFrame:
    """A keyword for the smallest subject of each entry's title key, a set: s, p, o."""
    one = graph_titles.groupBy("key").agg(F.min("s").alias("s"))
    return entries.select("key").distinct().join(one, "key").select("s", F.lit(predicate).alias("p"), F.lit(tag).alias("o")).distinct()


def affiliation_state(rows: DataFrame, cache: DataFrame) -> DataFrame:
    """rows (org, openalex) with state and payload from a cache (org, openalex, state, payload): cached unless the
    identifier has changed since; an identifier of another form is invalid; what is not cached is a miss."""
    c = cache.select("org", F.col("openalex").alias("_o"), F.col("state").alias("_s"), F.col("payload").alias("_p"))
    hit = F.col("_s").isNotNull() & F.col("_o").eqNullSafe(F.col("openalex"))
    good = F.upper(F.regexp_extract("openalex", "([^/]*)/*$", 1)).rlike("^I[0-9]+$")
    return rows.join(c, "org", "left").select(*rows.columns, F.when(hit, F.col("_s")).when(~F.coalesce(good, F.lit(False)), "invalid_openalex_id").otherwise("cache_miss").alias("state"), F.when(hit, F.col("_p")).alias("payload"))
