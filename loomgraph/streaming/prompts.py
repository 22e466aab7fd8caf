"""Incremental prompts and answers: directories of JSON lines as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROMPT = "pub string, pdf_url string, title string, abstract string, llm_prompt string"


def prompts(spark: SparkSession, path: str, schema: str = PROMPT, file_format: str = "json") -> DataFrame:
    """New files of a directory; lines that are no JSON objects are dropped."""
    rows = spark.readStream.schema(schema).format(file_format).load(path)
    return rows.where(F.col("pub").isNotNull()) if "pub" in rows.columns else rows


def first_seen(rows: DataFrame, keys: list[str], time: str | None = None, within: str | None = None) -> DataFrame:
    """The first row of each key; the state is kept in the checkpoint. Over the life of the stream it grows with the
    different keys; with a time column and an interval, keys are forgotten once the watermark has passed it."""
    if time and within:
        return rows.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)
    return rows.dropDuplicates(keys)


def answered(rows: DataFrame, model: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Runs batches of prompts through a model (an injected function of DataFrames) and appends JSON lines, skipping
    publications that the output already answers. A batch that is run again writes the same folder again."""

    def step(batch: DataFrame, number: int) -> None:
        model(batch).write.mode("overwrite").json(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drained(rows: DataFrame, out: str, checkpoint: str) -> None:
    """Runs a stream over what is there now, into Parquet."""
    rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
