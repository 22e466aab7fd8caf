"""The triple table and the pattern algebra over it.

A triple has s, p, o, o_kind (iri, bnode or literal) and, for literals, o_lang and o_dt. Bags unless said otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.text import SCHEMA

COLUMNS = ["s", "p", "o", "o_kind", "o_lang", "o_dt"]
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
XSD = "http://www.w3.org/2001/XMLSchema#"
DCTERMS = "http://purl.org/dc/terms/"


def triple(s: Column, p: str | Column, o: Column, kind: str = "literal", lang: Column | None = None, datatype: str | None = None) -> Column:
    """A triple struct; null where s or o is null or an empty literal, so that optional ones can be listed."""
    p = p if isinstance(p, Column) else F.lit(p)
    none = F.lit(None).cast("string")
    row = F.struct(s.alias("s"), p.alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), (none if lang is None else lang.cast("string")).alias("o_lang"), (none if datatype is None else F.lit(datatype)).alias("o_dt"))
    return F.when(s.isNotNull() & o.isNotNull() & (o.cast("string") != ""), row)


def emitted(df: DataFrame, *rows: Column, lists: tuple[Column, ...] = ()) -> DataFrame:
    """The triples of single structs and of lists of them: one narrow projection."""
    every = F.array(*rows) if rows else None
    for x in lists:
        x = F.coalesce(x, F.array().cast("array<struct<s:string,p:string,o:string,o_kind:string,o_lang:string,o_dt:string>>"))
        every = x if every is None else F.concat(every, x)
    return df.select(F.inline(F.filter(every, lambda t: t.isNotNull())))


def pattern(triples: DataFrame, s: str = "s", p: str | None = None, o: str = "o", where: Column | None = None) -> DataFrame:
    """A basic triple pattern: subjects and objects of a predicate, named after the variables."""
    rows = triples if p is None else triples.where(F.col("p") == p)
    rows = rows if where is None else rows.where(where)
    return rows.select(F.col("s").alias(s), F.col("o").alias(o))


def optional(left: DataFrame, right: DataFrame, on: str, condition: Column | None = None) -> DataFrame:
    """OPTIONAL with its filter inside: a left join whose condition does not drop rows of the left side."""
    return left.join(right if condition is None else right.where(condition), on, "left")


def sampled(df: DataFrame, by: str, *columns: str) -> DataFrame:
    """SAMPLE for each group, taken as the minimum so that it is the same in every run."""
    return df.groupBy(by).agg(*(F.min(c).alias(c) for c in columns))


def optionals_sampled(left: DataFrame, on: str, *rights: DataFrame) -> DataFrame:
    """Several optionals, each brought to one row per key first: their product never arises."""
    return reduce(lambda a, r: a.join(sampled(r, on, *(c for c in r.columns if c != on)), on, "left"), rights, left)


def union_set(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).distinct()


def nodes(triples: DataFrame) -> DataFrame:
    """Every IRI that occurs as a subject or an object: node."""
    return triples.select(F.col("s").alias("node")).union(triples.where("o_kind = 'iri'").select("o")).distinct()


def present(aliases: DataFrame, triples: DataFrame, item: str = "item", alias: str = "alias") -> DataFrame:
    """Items any of whose aliases occurs anywhere in the graph."""
    return aliases.join(nodes(triples).withColumnRenamed("node", alias), alias, "left_semi").select(item).distinct()


def of_values(df: DataFrame, column: str, values: list[str] | DataFrame) -> DataFrame:
    """VALUES: the rows of df whose column is among the values: a list, or a table of one column of any size."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias(column)).distinct(), column, "left_semi").select(df.columns)
    return df.where(F.col(column).isin(list(values))) if values else df.where("false")


def in_graphs(**graphs: DataFrame) -> DataFrame:
    """The triples of named graphs in one table with a column g; ``default`` names the unnamed one, its g is null."""
    named = [t.withColumn("g", F.lit(None if name == "default" else name).cast("string")) for name, t in graphs.items()]
    return reduce(DataFrame.unionByName, named)


def any_graph(quads: DataFrame) -> DataFrame:
    """The triples of all graphs of a quad table, each once: what GRAPH ?g and the default graph together match."""
    return quads.drop("g").distinct()


def has_any(items: DataFrame, facts: DataFrame, on: str, value: str, name: str = "has") -> DataFrame:
    """items with a flag: whether the facts (on, value) have one value or more for it."""
    n = facts.where(F.col(value).isNotNull()).groupBy(on).agg(F.count_distinct(value).alias("_n"))
    return items.join(n, on, "left").withColumn(name, F.coalesce("_n", F.lit(0)) > 0).drop("_n")


def without_existing(new: DataFrame, existing: DataFrame, *on: str) -> DataFrame:
    """The rows of new that the graph does not have yet, by the columns on (s, p, o if none are given)."""
    keys = list(on) or ["s", "p", "o"]
    return new.join(existing.select(*keys).distinct(), keys, "left_anti").select(new.columns)


def page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def missing_any(items: DataFrame, facts: DataFrame, on: str, value: str, wanted: list[str]) -> DataFrame:
    """Items lacking at least one of the wanted values: one aggregate instead of a disjunction of anti joins."""
    have = facts.where(F.col(value).isin(*wanted)).groupBy(on).agg(F.count_distinct(value).alias("_n"))
    return items.join(have, on, "left").where(F.coalesce("_n", F.lit(0)) < len(wanted)).drop("_n")


def schema(name: str) -> str:
    return SCHEMA + name
