"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source and ranked; a row's fractional rank is (2 rank + 1) / (2 n) in a
source of n rows. Sorted by fractional rank, every stretch holds the sources in their shares of the whole, and cutting
the order into equal stretches gives shards that match the mixture, with row counts at most one apart.

Ranks come from two levels, so that no source and no sorted order passes through one task: hashes and fractional ranks
fall evenly into buckets of a bounded number of rows, buckets are counted and offset, and only rows of one bucket are
numbered together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.plans.scratch import cut

#: Rows of a bucket, about: what one task numbers.
BUCKET_ROWS = 4_000
#: Buckets whose counts are summed up in one place: a power of two.
SPAN = 1024


def _numbered(rows: DataFrame, within: list[str], bucket: str, order: list[str]) -> DataFrame:
    """rows with at (0-based rank within the group by bucket, then order) and n (rows of the group). Counts of buckets are
    summed up within spans of buckets, and spans within the group, so that no group's buckets meet in one task."""
    keys = [*within, bucket]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("c")).withColumn("span", F.floor(F.col(bucket) / SPAN))
    spans = counts.groupBy(*within, "span").agg(F.sum("c").alias("c"))
    earlier = lambda over, by: F.coalesce(F.sum("c").over(Window.partitionBy(*over).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(*within, "span", earlier(within, "span").alias("above"), F.sum("c").over(Window.partitionBy(*within)).alias("n"))
    offsets = counts.withColumn("base", earlier([*within, "span"], bucket)).join(spans, [*within, "span"]).select(*keys, (F.col("base") + F.col("above")).alias("base"), "n")
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return rows.withColumn("at", at).join(offsets, keys).withColumn("at", F.col("at") + F.col("base")).drop("base")


def interleaved_shards(docs: DataFrame, shards: int = 40, seed: str = "interleave") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of docs (doc_id, text, source).

    size is the UTF-8 bytes of the text plus 16, a null text has none; the law is ``rows``. Null sources are a source of
    their own. Ties of the seeded hash, as of repeated doc_ids, are ordered by doc_id, size and checksum; rows equal in
    all of them are interchangeable. A null doc_id is hashed as an empty string. Rows of one doc_id, or without one, are
    numbered together: doc_ids are expected to tell documents apart. Extra columns are not read. An empty
    table gives an empty result; with fewer rows than shards some shards stay empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("stratum"),
    )
    total = docs.count()
    buckets = 1 << max(0, (total // BUCKET_ROWS).bit_length())
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = rows.withColumn("h", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    rows = rows.withColumn("b", F.expr(f"shiftright(h, {60 - buckets.bit_length() + 1})"))
    ties = ["h", "doc_id", "size", "text_crc32"]
    ranked = _numbered(rows, ["stratum"], "b", ties).withColumn("frac", (2 * F.col("at") + 1) / (2 * F.col("n")))
    ranked = cut(ranked.select("doc_id", "size", "text_crc32", "stratum", "h", "frac").withColumn("b", F.floor(F.col("frac") * buckets)).withColumn("all", F.lit(0)))
    order = _numbered(ranked, ["all"], "b", ["frac", "h", "stratum", "doc_id", "size", "text_crc32"])
    shard = F.expr(f"(at * {shards}) div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return order.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("at") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


#: The CRC-32 table, made from its polynomial; DuckDB has no such function.
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]), lambda c, k: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)))"


def oracle(shards: int = 40, seed: str = "interleave") -> str:
    return f"""
with tab as (select {_CRC_TABLE} as t),
bytes as (select *, lower(hex(encode(coalesce(text, '')))) as x from documents),
d as (
  select doc_id, (octet_length(encode(coalesce(text, ''))) + 16)::BIGINT as size,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as text_crc32,
    coalesce('s' || source, '') as stratum,
    ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT as h
  from bytes, tab),
r as (select *, (2 * (row_number() over (partition by stratum order by h, doc_id, size, text_crc32) - 1) + 1)::DOUBLE / (2 * count(*) over (partition by stratum))::DOUBLE as frac from d),
o as (select *, row_number() over (order by frac, h, stratum, doc_id, size, text_crc32) - 1 as pos, count(*) over () as n from r)
select doc_id, size, text_crc32, 'rows' as law, (pos * {shards} // n)::INTEGER as shard, (pos - ((pos * {shards} // n) * n + {shards - 1}) // {shards})::BIGINT as slot, null::INTEGER as grown_shard
from o"""
