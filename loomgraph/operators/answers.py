"""Prompts to a language model and its answers: prompt text, salvage of JSON, budgets, resulting triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.functions.identifiers import github_repository, serializable
from loomgraph.plans.scratch import cut

ANSWER = "struct<paper_uri:string,related_github:array<struct<url:string,confidence:string,reason:string>>>"


def json_salvaged(text: Column, schema: str) -> Column:
    """The JSON object of a model's text: the whole, a fenced block, or from the first brace to the last."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*\})\s*```", 1)
    outer = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    tried = [F.when(F.try_parse_json(t).isNotNull() & F.trim(t).startswith("{"), F.from_json(t, schema)) for t in (text, fenced, outer)]
    return F.coalesce(*tried)


def salvage_error(text: Column) -> Column:
    """Why json_salvaged finds nothing, null where it finds something."""
    any_json = F.coalesce(*(F.when(F.try_parse_json(t).isNotNull() & F.trim(t).startswith("{"), F.lit(True)) for t in (text, F.regexp_extract(text, r"(?s)(\{.*\})", 1))))
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", "empty_output").when(any_json, F.lit(None).cast("string")).when(~F.contains(text, F.lit("{")), "no_json_object").otherwise("invalid_json")


def repositories(answers: DataFrame, predicate: str, minimum: float = 0.6, states: tuple[str, ...] = ("ok",)) -> DataFrame:
    """codeRepository triples of answers (pub, status, response struct), a set: s, p, o. A confidence that is NaN
    passes, one that is no number does not."""
    uri = F.coalesce(F.when(serializable(F.col("pub")) & F.col("pub").rlike("^https?://"), F.col("pub")), F.when(serializable(F.col("response.paper_uri")) & F.col("response.paper_uri").rlike("^https?://"), F.col("response.paper_uri")))
    each = answers.where(F.col("status").isin(*states)).select(uri.alias("s"), F.explode("response.related_github").alias("g")).where("s is not null")
    good = each.where(F.trim("g.confidence").try_cast("double") >= minimum)
    return good.select("s", F.lit(predicate).alias("p"), github_repository(F.col("g.url")).alias("o")).where("o is not null").distinct()


def within_budget(rows: DataFrame, tokens: str, order: list[str], limit: int, day: str | None = None) -> DataFrame:
    """rows up to the first whose running sum of tokens exceeds the limit, for each day; rows after it stop too. tokens are
    not negative. Rows are dealt by ranges of day and order, sums of earlier ranges are added to those within one: no day
    passes through one task."""
    keys = [day] if day else []
    dealt = cut(rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    sums = dealt.groupBy(*keys, "_range").agg(F.sum(tokens).alias("_sum"))
    # one row for each range, or range and day
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*keys, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    met = dealt.withColumn("_inside", F.sum(tokens).over(inside)).join(base.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_range").alias("_r"), "_base"), _same(keys))
    return met.withColumn("running", F.col("_base") + F.col("_inside")).where(F.col("running") <= limit).select(*rows.columns, "running")


def _same(keys: list[str]) -> Column:
    on = F.col("_range") == F.col("_r")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return on


def pending(prompts: DataFrame, done: DataFrame, only_ok: bool = True) -> DataFrame:
    """prompts without an answer yet, each pub once, the first by line_no."""
    answered = (done.where("status = 'ok'") if only_ok else done).select("pub").distinct()
    rest = [c for c in prompts.columns if c != "pub"]
    first = prompts.groupBy("pub").agg(F.min_by(F.struct(*rest), "line_no").alias("_r")).select("pub", "_r.*")
    return first.join(answered, "pub", "left_anti").select(*prompts.columns)


def prompt(title: Column, abstract: Column, mentions: Column, window: int) -> Column:
    """The prompt for a publication with its numbered mentions (url, context, source)."""
    lines = F.transform(mentions, lambda m, i: F.concat((i + 1).cast("string"), F.lit(". "), m["url"], F.lit(" ["), m["source"], F.lit("]\\n   "), m["context"]))
    listed = F.when(F.size(mentions) > 0, F.array_join(lines, "\n")).otherwise("(none)")
    return F.concat(F.lit("Title: "), F.coalesce(title, F.lit("")), F.lit("\nAbstract: "), F.coalesce(abstract, F.lit("")), F.lit(f"\nGitHub links within {window} characters of context:\n"), listed, F.lit('\nReply with JSON: {"paper_uri": ..., "related_github": [{"url": ..., "confidence": ..., "reason": ...}]}'))
