"""Collaboration and coverage analytics over a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collaborations(works: DataFrame, names: list[str] | None = None, at_least: int = 2, exactly: bool = False) -> DataFrame:
    """Works (pub, name) by as many of the names: pub. All names if none are given."""
    if at_least < 2:
        raise ValueError("a collaboration has two authors at least")
    rows = works if names is None else works.where(F.col("name").isin(*names))
    n = F.count_distinct("name")
    return rows.groupBy("pub").agg(n.alias("n")).where(F.col("n") == at_least if exactly else F.col("n") >= at_least).select("pub")


def collaboration_count(works: DataFrame, names: list[str], at_least: int = 2, exactly: bool = False) -> DataFrame:
    if len(set(names)) < at_least:
        return works.sparkSession.createDataFrame([(0,)], "n_publications long")
    return collaborations(works, names, at_least, exactly).agg(F.count("*").alias("n_publications"))


def collaboration_pairs(works: DataFrame, names: list[str] | None = None, at_least: int = 2, exactly: bool = False) -> DataFrame:
    """name1 < name2 and the publications they share. Works below the threshold leave before pairs are made."""
    rows = (works if names is None else works.where(F.col("name").isin(*names))).select("pub", "name").distinct()
    rows = rows.join(collaborations(rows, None, at_least, exactly), "pub", "left_semi")
    met = rows.select("pub", F.col("name").alias("name1")).join(rows.select("pub", F.col("name").alias("name2")), "pub").where("name1 < name2")
    return met.groupBy("name1", "name2").agg(F.count_distinct("pub").alias("n_publications"))


def frequencies(df: DataFrame, value: str, order: str) -> DataFrame:
    """value, n and the first position of each, for listing by count, then first seen."""
    return df.groupBy(value).agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))


def joined_sorted(column: str) -> F.Column:
    return F.array_join(F.array_sort(F.collect_set(column)), "; ")
