"""The corpus pipeline: documents to token digests, in stages that each call one operator.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns all columns of documents, of
any names (the last: token counts and digests). Null doc_ids are kept and never compared; null and empty texts, and texts
without words, fail the base quality rules and go with the first stage; long texts are read whole; rows that come again
share the fate of the first; an empty table gives an empty result. Between stages rows are written and read again, so a lost executor costs at most
the stage under way.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import bpe_codec, near_dedup, quality_divergence, secret_forest, winnowing
from loomgraph.plans.scratch import discard, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far from their language's histograms go."""
    return quality_divergence.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8 or more) the smallest doc_id stays.

    Rows go, not doc_ids: a row whose doc_id also stands for another text is judged by its own text. Rows without
    doc_id, text or words stay; a row that comes again stays or goes with the first.
    """
    found = near_dedup.near_duplicates(docs, near_dedup.NearDup(shingle=5, num=80, den=100), by_text=True)
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone_id"), F.col("text_md5").alias("_gone_md5")).distinct()
    same = (docs["doc_id"] == gone["_gone_id"]) & (F.unhex(F.md5(docs["text"].cast("binary"))) == gone["_gone_md5"])
    return docs.join(gone, same, "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, of eight words or the whole of a shorter item, go."""
    hits = winnowing.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep_rows=True)
    return hits.where(F.size("items") == 0).select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; the document stays."""
    out = secret_forest.masked(docs, secret_forest.default_forest(spark))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return bpe_codec.digests(bpe_codec.round_trip(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("near_dedup", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("bpe", tokens)]

#: The forest and the tokenizer have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *steps, last = [partial(f, spark, sf_dir=sf_dir) for _, f in STAGES]
    for (name, _), step in zip(STAGES, steps):
        before, docs = docs, stored(step(docs=docs), f"pipeline-{name}")
        discard(before)  # the stage's result is written: nothing reads its input again
    return last(docs=docs)
