"""Connected components of an edge table by alternating large-star and small-star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.plans.scratch import cut, release


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (u > v) are stars already: every u has one edge, and no v is a u. A root is then the smallest."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root")).where("up > 1 or up = 1 and root = 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest node of its neighbourhood. Repeats may come; they go in the
    next small star."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of them; edges come as u > v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    side = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return side.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, left: str = "u", right: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of an undirected edge table; component is the smallest node reachable.

    Loops, repeated and reversed edges and rows with a null end are allowed and change nothing; a node seen only in
    loops is its own component. Minima are pre-aggregated and joined back, so the edges of a hub are never gathered in
    one task. Each round is checkpointed; only whether stars are left comes to the driver. Edges that are no stars yet
    after max_rounds raise an error: they would give wrong components.
    """
    raw = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null")
    nodes = raw.select(F.col("u").alias("node")).union(raw.select("v")).distinct()
    now = cut(raw.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    rounds = 0
    while not _settled(now):
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        now, rounds = cut(_small_star(_large_star(now))), rounds + 1
    release(edges.sparkSession)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
