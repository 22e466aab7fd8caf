"""Text, CSV, JSON-lines and key-value sources, with exact line numbers."""

from __future__ import annotations

import json
import sqlite3
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.functions.identifiers import http_iri, openalex_institution
from loomgraph.functions.text import plain_text, space_normal


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no (from 1, in the order of the file), file and value. Lines are counted per block of the file, and numbered
    within a block, so no file passes through one task."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value").withColumn("_m", F.monotonically_increasing_id())
    counts = rows.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = counts.select("file", "block", F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    at = F.row_number().over(Window.partitionBy("file", "block").orderBy("_m"))
    return rows.withColumn("at", at).join(before, ["file", "block"]).select((F.col("base") + F.col("at")).alias("line_no"), "file", "value")


def read_publications(spark: SparkSession, path: str) -> DataFrame:
    """A semicolon CSV of publications: all strings; rows without id are dropped."""
    return spark.read.csv(path, sep=";", quote='"', escape='"', multiLine=True, header=True).where("trim(id) <> ''")


def sniffed(head: str, separators: str = ",;\t") -> str:
    """The separator that splits the head's lines into the most equal columns."""
    lines = [x for x in head.splitlines() if x.strip()]
    return max(separators, key=lambda s: (min((x.count(s) for x in lines), default=0), sum(x.count(s) for x in lines)))


def read_csv(spark: SparkSession, path: str, required: list[str] = ()) -> DataFrame:
    """A CSV of unknown separator; a byte-order mark is dropped, missing columns raise."""
    head = next(iter(spark.read.text(path, wholetext=True).limit(1).select(F.substring("value", 1, 4096).alias("v")).collect()), [""])[0]
    df = spark.read.csv(path, sep=sniffed(head), quote='"', escape='"', multiLine=True, header=True)
    df = df.toDF(*(c.lstrip("\ufeff").strip() for c in df.columns))
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return df


def single_valued(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key; a key with two values raises when it is read."""
    n = df.groupBy(key).agg(F.collect_set(value).alias("_v"))
    return n.select(key, F.when(F.size("_v") == 1, F.get("_v", F.lit(0))).otherwise(F.raise_error(F.concat(F.lit(f"conflicting {value} of "), F.col(key)))).cast("string").alias(value))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON objects, one a line; other lines are dropped."""
    rows = spark.read.text(path).where(F.try_parse_json("value").isNotNull() & F.ltrim("value").startswith("{"))
    return rows.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_papers(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """s, paperName, authors (array, each once, in order) of a papers CSV; the first rows only if a limit is given."""
    df = read_csv(spark, path, ["s", "paperName", "authors"])
    people = F.array_distinct(F.filter(F.transform(F.split(F.coalesce("authors", F.lit("")), ","), lambda a: F.trim(a)), lambda a: a != ""))
    rows = df.select(F.trim("s").alias("s"), "paperName", people.alias("authors"))
    return rows.limit(limit) if limit else rows


def read_missing_affiliations(spark: SparkSession, path: str) -> DataFrame:
    """institution, name, aliases, openalex_id of a CSV (institution, name, external_ids). Institutions and aliases must be
    http(s) IRIs; the identifier is the only one among them, several raise when the row is read."""
    df = read_csv(spark, path, ["institution", "name", "external_ids"])
    aliases = F.array_distinct(F.filter(F.transform(F.split(F.coalesce("external_ids", F.lit("")), ";"), lambda a: F.trim(a)), lambda a: a != ""))
    rows = df.select(F.trim("institution").alias("institution"), F.coalesce("name", F.lit("")).alias("name"), aliases.alias("aliases"))
    checked = lambda x: F.when(http_iri(x), x).otherwise(F.raise_error(F.concat(F.lit("not an IRI: "), F.coalesce(x, F.lit(""))))).cast("string")
    every = F.filter(F.array_append("aliases", F.col("institution")), lambda v: v.rlike("^https?://openalex[.]org/"))
    ids = F.array_distinct(F.array_compact(F.transform(every, openalex_institution)))
    one = F.when(F.size(ids) <= 1, F.coalesce(F.get(ids, F.lit(0)), F.lit(""))).otherwise(F.raise_error(F.concat(F.lit("conflicting identifiers of "), F.col("institution")))).cast("string")
    return rows.select(checked(F.col("institution")).alias("institution"), "name", F.transform("aliases", checked).alias("aliases"), one.alias("openalex_id"))


def read_affiliations(spark: SparkSession, path: str) -> DataFrame:
    """uri, name, norm, position of an affiliation CSV (affiliation, affiliationName); rows without either are dropped."""
    df = read_csv(spark, path, ["affiliation", "affiliationName"]).select(F.trim("affiliation").alias("uri"), F.trim("affiliationName").alias("name"))
    return df.withColumn("position", F.monotonically_increasing_id()).where("uri <> '' and name <> ''").withColumn("norm", plain_text(F.col("name")))


def name_list(lines: DataFrame) -> DataFrame:
    """name of lines (value): blank lines and ``#`` comments are skipped, white space is single. No name at all raises when
    it is read."""
    names = lines.select(space_normal(F.col("value")).alias("name")).where("name <> '' and not startswith(name, '#')")
    guard = names.agg(F.count("*").alias("n")).select(F.when(F.col("n") == 0, F.raise_error(F.lit("no names")).cast("string")).alias("name")).where("name is not null")
    return names.unionByName(guard)


def read_key_values(spark: SparkSession, path: str, table: str = "cache") -> DataFrame:
    """k, v, t of an SQLite file with plain or deflated JSON values, read on the driver: a local cache being imported."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        rows = [(k, (zlib.decompress(v) if isinstance(v, bytes) and v[:1] == b"\x78" else v if isinstance(v, bytes) else str(v).encode()).decode(), t) for k, v, t in con.execute(f'select k, v, t from "{table}" order by t, k')]
    return spark.createDataFrame(rows, "k string, v string, t long")


def migrated_cache(spark: SparkSession, path: str, target: str) -> DataFrame:
    """A JSON cache (see read_json_cache) written as a Parquet table of k, v, t; newer rows are merged by enrich.upserted."""
    read_json_cache(spark, path).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def read_json_cache(spark: SparkSession, path: str) -> DataFrame:
    """k, v, t of a JSON file with one object; a damaged file is empty, another value than an object raises."""
    try:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
    except (OSError, ValueError):
        data = {}
    if not isinstance(data, dict):
        raise ValueError(f"{path}: not a JSON object")
    return spark.createDataFrame([(k, json.dumps(v), 0) for k, v in data.items()], "k string, v string, t long")
