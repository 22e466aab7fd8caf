"""The registered queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import bpe_codec, pii_feistel, quality_divergence, secret_forest, stratified_shards, token_records, warc_revisits, winnowing, wordpiece_counts
from loomgraph.llm.near_dedup import NearDup, near_duplicates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 85 / 100 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), NearDup(shingle=3, num=85, den=100))


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_records.write_records(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_records.read_records(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a fixed one, so that runs can be compared; a real one comes from a key store."""
    return pii_feistel.report(pii_feistel.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), key=b"loomgraph demonstration key"))


def op4_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_divergence.quality(table(spark, sf_dir, "documents"))


def op5_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_shards.interleaved_shards(table(spark, sf_dir, "documents"), shards=40)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(bpe_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op7_wordpiece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets are shown by their digests only."""
    found = secret_forest.findings(table(spark, sf_dir, "documents"), secret_forest.default_forest(spark))
    return found.where("secret").select("doc_id", "start", "length", F.sha2(F.col("candidate").cast("binary"), 256).alias("secret_sha256"))


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisits.shown(warc_revisits.resolve_revisits(warc_revisits.captures(table(spark, sf_dir, "pages"))))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.verdicts(winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


QUERIES = {f.__name__: f for f in (op1_minhash_near_dedup, op2_token_records, op3_pii_feistel, op4_quality_divergence, op5_stratified_shards, op6_bpe_codec, op7_wordpiece_counts, op8_secret_forest, op9_warc_revisits, op10_winnowing)}

SQL: dict[str, str] = {"op4_quality_divergence": quality_divergence.oracle(), "op5_stratified_shards": stratified_shards.oracle(), "op9_warc_revisits": warc_revisits.oracle()}
