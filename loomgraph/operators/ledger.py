"""Token budgets of a day: limits by model, what a ledger has used up, and which prompts still fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.text import tokens_estimated
from loomgraph.operators.answers import within_budget

#: Daily token limits and the models that have them; other models need a limit of their own.
DAILY_LIMITS = {
    250_000: ["gpt-5.2", "gpt-5.1", "gpt-5.1-codex", "gpt-5", "gpt-5-codex", "gpt-5-chat-latest", "gpt-4.1", "gpt-4o", "o1", "o3"],
    2_500_000: ["gpt-5.1-codex-mini", "gpt-5-mini", "gpt-5-nano", "gpt-4.1-mini", "gpt-4.1-nano", "gpt-4o-mini", "o1-mini", "o3-mini", "o4-mini", "codex-mini-latest"],
}
LEDGER = "day string, model string, input_tokens long, output_tokens long, total_tokens long"


def daily_limit(model: str | None, explicit: int = 0) -> int:
    """The tokens a model may take a day; one without a limit raises unless an explicit one is given."""
    if explicit > 0:
        return explicit
    for limit, models in DAILY_LIMITS.items():
        if (model or "").strip() in models:
            return limit
    raise ValueError(f"no daily limit is known for {model!r}; give one")


def used(ledger: DataFrame, day: str) -> DataFrame:
    """tokens, input_tokens, output_tokens used on a day: one row. Other days do not count, negative entries neither."""
    total = lambda c: F.coalesce(F.sum(F.greatest(F.col(c), F.lit(0))), F.lit(0)).cast("long")
    return ledger.where(F.col("day") == day).agg(total("total_tokens").alias("tokens"), total("input_tokens").alias("input_tokens"), total("output_tokens").alias("output_tokens"))


def affordable(prompts: DataFrame, ledger: DataFrame, day: str, limit: int, order: list[str], prompt: str = "llm_prompt", reserve: int = 0) -> DataFrame:
    """prompts, in order, as long as what the day has used and the estimates of prompts so far (with a reserve for each
    answer) stay within the limit; columns estimate and running. The first that does not fit stops all after it."""
    spent = used(ledger, day).first().tokens
    rows = prompts.withColumn("estimate", tokens_estimated(F.coalesce(F.col(prompt), F.lit(""))) + reserve)
    return within_budget(rows, "estimate", order, limit - spent) if spent < limit else rows.withColumn("running", F.lit(None).cast("long")).where("false")


def entries(answers: DataFrame, day: str, model: str, usage: Column, estimate: Column) -> DataFrame:
    """The ledger rows of answers: usage (see functions.payloads.usage_tokens) where the response has it, else the estimate."""
    row = answers.select(F.lit(day).alias("day"), F.lit(model).alias("model"), usage.alias("u"), estimate.alias("e"))
    parts = F.coalesce(F.col("u.input"), F.lit(0)) + F.coalesce(F.col("u.output"), F.lit(0))
    total = F.coalesce(F.col("u.total"), F.when(F.col("u.input").isNotNull() | F.col("u.output").isNotNull(), parts), F.col("e"))
    return row.select("day", "model", F.col("u.input").alias("input_tokens"), F.col("u.output").alias("output_tokens"), total.cast("long").alias("total_tokens"))
