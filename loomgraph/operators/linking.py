"""Linking, merging and rewriting of entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.components import connected_components

LINK = "u1 string, u2 string, conf double"


def labelled(triples: DataFrame, label: str, types: list[str], type_predicate: str, state: DataFrame | None = None) -> DataFrame:
    """uri, label (the first by line), typed for each subject. triples need line_no and key (see functions.nt.align_key);
    state holds rows of an earlier run: its labels win, its rows without a flag count as typed."""
    first = F.min_by(F.when(F.col("p") == label, F.col("key")), F.when((F.col("p") == label) & F.col("key").isNotNull(), F.col("line_no")))
    rows = triples.where((F.col("p") == label) | (F.col("p") == type_predicate)).groupBy(F.col("s").alias("uri"))
    now = rows.agg(first.alias("label"), F.coalesce(F.bool_or((F.col("p") == type_predicate) & F.col("o").isin(*types)), F.lit(False)).alias("typed"))
    if state is None:
        return now
    old = state.select("uri", F.col("label").alias("_l"), F.coalesce("typed", F.lit(True)).alias("_t"))
    return now.join(old, "uri", "full").select("uri", F.coalesce("_l", "label").alias("label"), (F.coalesce("typed", F.lit(False)) | F.coalesce("_t", F.lit(False))).alias("typed"))


def same_label(entities: DataFrame, mode: str = "canonical") -> DataFrame:
    """Links (u1, u2, conf) of entities (uri, label) that share a label: each with the smallest of its label, or, in
    mode allpairs, all pairs u1 < u2, whose number grows with the square of a label's entities."""
    rows = entities.where("label is not null").select("uri", "label").distinct()
    if mode == "canonical":
        low = rows.groupBy("label").agg(F.min("uri").alias("u1"), F.count("*").alias("n")).where("n > 1")
        return rows.join(low, "label").where("uri <> u1").select("u1", F.col("uri").alias("u2"), F.lit(1.0).alias("conf"))
    return _pairs(rows.withColumnRenamed("uri", "u"), "label", F.col("l.u") < F.col("r.u"))


def joining(entities: DataFrame, threshold: float) -> DataFrame:
    """Links (u1, u2, conf), fewer than entities, that join at threshold what all pairs u1 < u2 of a label with the conf of u1
    join, and name the same uris: of those pairs, each uri keeps the one with the smallest uri of its label that reaches
    threshold, or, up to that one, with the smallest of all. entities have uri, label, conf; rows without label or uri are left out."""
    own = F.struct("uri", "conf")
    reach = F.min(F.when(F.col("conf") >= threshold, own)).alias("_reach")
    ends = entities.where("label is not null and uri is not null").groupBy("label").agg(F.min(own).alias("_low"), F.max("uri").alias("_high"), reach)
    rows = entities.select("uri", "label").join(ends.where("_low.uri < _high"), "label")
    to = F.when(F.col("uri") > F.col("_reach.uri"), F.col("_reach")).otherwise(F.col("_low"))
    return rows.select(to["uri"].alias("u1"), F.col("uri").alias("u2"), to["conf"].alias("conf")).where("u1 <> u2")


def shared_object(statements: DataFrame) -> DataFrame:
    """Links of subjects (s, key, line_no) that share an object key; the one seen first is u1."""
    seen = statements.where("key is not null").groupBy("key", F.col("s").alias("u")).agg(F.min("line_no").alias("at"))
    return _pairs(seen, "key", (F.col("l.at") < F.col("r.at")) | ((F.col("l.at") == F.col("r.at")) & (F.col("l.u") < F.col("r.u"))))


def classes(rows: DataFrame, key: str, uri: str = "uri") -> DataFrame:
    """uri, first, n: which rows share a key, without pairs: each uri with the smallest of its class and the class's size,
    so its links are n - 1. Classes of one are left out; the rows grow with the uris, not with the square of a class."""
    each = rows.where(F.col(key).isNotNull()).select(key, F.col(uri).alias("uri")).distinct()
    size = each.groupBy(key).agg(F.min("uri").alias("first"), F.count("*").alias("n")).where("n > 1")
    return each.join(size, key).select("uri", key, "first", "n")


def _pairs(rows: DataFrame, key: str, before: Column) -> DataFrame:
    many = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
    rows = rows.join(many, key, "left_semi")
    met = rows.alias("l").join(rows.alias("r"), key).where(before)
    return met.select(F.col("l.u").alias("u1"), F.col("r.u").alias("u2"), F.lit(1.0).alias("conf")).distinct()


def preference(uri: Column) -> Column:
    """The order of canonical choice: without percent signs, then shorter, then smaller."""
    return F.struct(F.contains(uri, F.lit("%")).alias("percent"), F.length(uri).alias("n"), uri.alias("uri"))


def mapping(links: DataFrame, threshold: float = 0.7) -> DataFrame:
    """old, canonical for each uri of the links; those linked by conf >= threshold share the best of their component.
    A NaN confidence counts as reaching any threshold."""
    every = links.select(F.col("u1").alias("node")).union(links.select("u2")).where("node is not null").distinct()
    parts = connected_components(links.where(F.col("conf") >= threshold), "u1", "u2")
    placed = every.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    best = placed.groupBy("component").agg(F.min(preference(F.col("node")))["uri"].alias("canonical"))
    return placed.join(best, "component").select(F.col("node").alias("old"), "canonical")


def rewritten_by(triples: DataFrame, old_new: DataFrame) -> DataFrame:
    """triples with mapped subjects and IRI objects replaced; predicates stay. Only IRIs are dealt out by their object."""
    changed = old_new.where("old <> canonical")
    s = changed.select(F.col("old").alias("s"), F.col("canonical").alias("_s"))
    o = changed.select(F.col("old").alias("o"), F.col("canonical").alias("_o"))
    out = triples.join(s, "s", "left").withColumn("s", F.coalesce("_s", "s")).select(*triples.columns)
    iri = F.coalesce(F.col("o_kind") == "iri", F.lit(False))
    named = out.where(iri).join(o, "o", "left").withColumn("o", F.coalesce("_o", "o")).select(*triples.columns)
    return named.unionByName(out.where(~iri))


def read_links(lines: DataFrame) -> DataFrame:
    """Links of tab-separated lines ``<u1> <u2> conf``; lines of another form are skipped."""
    f = F.split(F.trim("value"), "\t")
    inner = lambda i: F.regexp_extract(F.trim(F.get(f, F.lit(i))), "^<(.*)>$", 1)
    rows = lines.where(F.size(f) >= 3).select(inner(0).alias("u1"), inner(1).alias("u2"), F.trim(F.get(f, F.lit(2))).try_cast("double").alias("conf"))
    return rows.where("u1 <> '' and u2 <> '' and conf is not null")
