"""Cleaning of name statements and small graph repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.functions.nt import escape, unescape
from loomgraph.functions.names import name_corrupt, name_repaired, name_score, problem_name_repaired


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each group in an order that must be total."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def best_of(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row of each group whose order struct is largest, by a partial aggregate: large groups are not sorted."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*")


def cleaned_names(triples: DataFrame, predicate: str, drop_corrupt: bool = True, dedupe: bool = False, best_only: bool = False) -> DataFrame:
    """triples (with line_no) whose literals of a predicate are repaired: columns o (escaped) and state, one of other,
    same, changed. Corrupt names are dropped; dedupe keeps the first of equal names of a subject; best_only keeps the
    best-scored name of a subject, the first on ties."""
    is_name = (F.col("p") == predicate) & (F.col("o_kind") == "literal")
    plain = F.when(is_name, unescape(F.col("o")))
    done = triples.withColumn("_clean", name_repaired(plain))
    done = done.withColumn("_bad", F.coalesce(name_corrupt(F.col("_clean")), F.lit(False)))
    done = done.where(~F.col("_bad")) if drop_corrupt else done
    done = done.withColumn("_new", F.when(is_name, escape(F.col("_clean"), "full")).otherwise(F.col("o")))
    done = done.withColumn("state", F.when(~is_name, "other").when(F.col("_new") == F.col("o"), "same").otherwise("changed")).withColumn("o", F.col("_new"))
    names, rest = done.where(is_name), done.where(~is_name | F.col("p").isNull())
    if dedupe:
        names = best_of(names, ["s", "o", "o_lang", "o_dt"], -F.col("line_no"))
    if best_only:
        names = best_of(names, ["s"], F.struct(name_score(F.col("_clean")), -F.col("line_no")))
    return names.unionByName(rest).select(*triples.columns, "state")


def problem_names(triples: DataFrame, predicate: str | None = None, odd_quotes: bool = False) -> DataFrame:
    """triples whose literals of a predicate, or all literals, are mended (see problem_name_repaired): o (escaped again),
    changed, and reasons to look at what is left (see suspicious; an empty array for other rows). Works on streams too."""
    wanted = F.col("o_kind") == "literal" if predicate is None else (F.col("p") == predicate) & (F.col("o_kind") == "literal")
    done = triples.withColumn("_plain", problem_name_repaired(F.when(wanted, unescape(F.col("o")))))
    done = done.withColumn("_new", F.coalesce(escape(F.col("_plain"), "full"), F.col("o")))
    reasons = F.when(F.col("_plain").isNotNull(), suspicious(F.col("_new"), F.col("_plain"), odd_quotes)).otherwise(F.array().cast("array<string>"))
    return done.withColumn("changed", ~F.col("_new").eqNullSafe(F.col("o"))).withColumn("reasons", reasons).withColumn("o", F.col("_new")).select(*triples.columns, "changed", "reasons")


def literals_containing(triples: DataFrame, predicate: str, text: str = '\\"') -> DataFrame:
    return triples.where((F.col("p") == predicate) & (F.col("o_kind") == "literal") & F.contains(F.col("o"), F.lit(text)))


def suspicious(escaped: Column, plain: Column, odd_quotes: bool = False) -> Column:
    """Reasons to look at a repaired name."""
    odd = F.when((F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))) % 2 == 1, "odd_quote_count") if odd_quotes else F.lit(None).cast("string")
    return F.array_compact(
        F.array(
            F.when(escaped.rlike(r'(?U)\\\\\s*\\"\s*\{?\s*[A-Za-z]\s*\}?'), "raw_escaped_umlaut_pattern"),
            F.when(escaped.rlike(r"(?U)\\\\\s*(ss|SS)\b"), "raw_escaped_sharp_s_pattern"),
            F.when(plain.rlike(r"(?U)(?:^|\s)[äöüÄÖÜ](?:\s|$)"), "isolated_umlaut_token"),
            odd,
        )
    )


def duplicate_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """surplus: how many rows repeat an earlier one."""
    return lines.groupBy(column).agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("surplus"))


def base_moved(x: Column, old: str, new: str) -> Column:
    return F.replace(x, F.lit(old), F.lit(new))
