"""Canonical IRIs: external subjects, and objects that occur as such, are minted under one base, with a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.identifiers import internal, rewritten


def external_subjects(triples: DataFrame, base: str) -> DataFrame:
    return triples.where(~internal(F.col("s"), base)).select(F.col("s").alias("iri")).distinct()


def canonicalized(triples: DataFrame, base: str, prefix: str = "/id") -> DataFrame:
    """triples with new_s and new_o: subjects outside the base are minted, IRI objects only if they occur as such."""
    known = external_subjects(triples, base).select(F.col("iri").alias("o"), F.lit("iri").alias("o_kind"), F.lit(True).alias("_known"))
    out = triples.join(known, ["o", "o_kind"], "left")
    return out.select(*triples.columns, F.coalesce(rewritten(F.col("s"), base, prefix), F.col("s")).alias("new_s"), F.when(F.col("_known"), rewritten(F.col("o"), base, prefix)).otherwise(F.col("o")).alias("new_o"))


def report(done: DataFrame) -> DataFrame:
    """external_iri, canonical_iri, count_subject_rewrites, count_object_rewrites, first_seen_line of canonicalized rows
    (with line_no). An external IRI with two canonical ones raises when it is read."""
    ends = F.array(F.struct(F.col("s").alias("external_iri"), F.col("new_s").alias("canonical_iri"), F.lit(1).alias("a"), F.lit(0).alias("b")), F.struct(F.col("o").alias("external_iri"), F.col("new_o").alias("canonical_iri"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    rows = done.select("line_no", F.inline(ends)).where("external_iri <> canonical_iri")
    one = F.when(F.min("canonical_iri") == F.max("canonical_iri"), F.min("canonical_iri")).otherwise(F.raise_error(F.concat(F.lit("two canonical IRIs of "), F.first("external_iri"))).cast("string"))
    return rows.groupBy("external_iri").agg(one.alias("canonical_iri"), F.sum("a").cast("long").alias("count_subject_rewrites"), F.sum("b").cast("long").alias("count_object_rewrites"), F.min("line_no").alias("first_seen_line"))


def same_as(rows: DataFrame) -> DataFrame:
    """sameAs triples canonical -> external of a report, a set."""
    return rows.select(F.col("canonical_iri").alias("s"), F.lit("http://www.w3.org/2002/07/owl#sameAs").alias("p"), F.col("external_iri").alias("o"), F.lit("iri").alias("o_kind")).distinct()
