"""Sinks: N-Triples as a bag, set or sorted set, reports and mappings."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.nt import written


def check_paths(source: str, target: str) -> None:
    """Raises if the output would overwrite the input."""
    if os.path.normpath(source.removeprefix("file://")) == os.path.normpath(target.removeprefix("file://")):
        raise ValueError("input and output are the same path")


def replace_text(path: str, text: str, suffix: str = ".bak") -> str | None:
    """Writes a local text file in place; what was there is kept beside it with a suffix, whose path is returned. A text
    that is there already is not written again."""
    if os.path.exists(path):
        with open(path, encoding="utf-8", newline="") as f:
            if f.read() == text:
                return None
        shutil.copy2(path, path + suffix)
    with open(path + ".part", "w", encoding="utf-8", newline="") as f:
        f.write(text)
    os.replace(path + ".part", path)
    return path + suffix if os.path.exists(path + suffix) else None


def write_triples(triples: DataFrame, path: str, mode: str = "bag", one_file: bool = False) -> None:
    """Lines of triples: bag (as they come), set, or sorted (a set in line order, range-partitioned; one_file only for
    results that one task can hold)."""
    lines = written(triples)
    lines = lines if mode == "bag" else lines.distinct()
    lines = lines.orderBy("value") if mode == "sorted" else lines
    (lines.coalesce(1) if one_file else lines).write.text(path)


def insert_statement(triples: DataFrame, most: int = 10_000) -> str:
    """An INSERT DATA statement of a small set of triples; more than ``most`` raise."""
    rows = written(triples).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} triples")
    return "INSERT DATA {\n" + "\n".join(sorted(r.value for r in rows)) + "\n}"


def write_report(rows: DataFrame, path: str, order: str, form: str = "csv") -> None:
    rows = rows.orderBy(order)
    (rows.write.json if form == "json" else lambda p: rows.write.csv(p, header=True))(path)


def write_mapping(old_new: DataFrame, path: str) -> None:
    old_new.where("old <> canonical").select("old", "canonical").write.csv(path, sep="\t")


def write_table(rows: DataFrame, path: str, header: bool = True) -> None:
    """Tab-separated pairs or a summary, with or without a header."""
    rows.write.csv(path, sep="\t", header=header, lineSep="\n")


#: Columns of the reports, in their order.
REPORTS = {"match": ["paper", "state", "work", "candidates"], "author": ["paper", "author", "persons", "status"], "affiliation": ["institution", "status", "cache_hit"], "missing": ["institution", "name", "external_ids", "authorships"]}


def report_rows(rows: DataFrame, kind: str) -> DataFrame:
    """The columns of a report of a kind, lists joined by semicolons; a missing column raises."""
    kinds = dict(rows.dtypes)
    text = lambda c: F.array_join(F.array_sort(c), "; ") if kinds[c].startswith("array") else F.col(c).cast("string")
    return rows.select(*(text(c).alias(c) for c in REPORTS[kind]))


def json_report(rows: DataFrame, order: str, most: int = 50, **conditions) -> DataFrame:
    """One JSON text: how many rows meet each condition, and the first rows that do, in input order."""
    counts = counted(rows, **conditions)
    keep = [c for c in rows.columns]
    lists = [examples(rows.where(c), order, most).agg(F.to_json(F.array_sort(F.collect_list(F.struct(order, *(k for k in keep if k != order))))).alias(f"{name}_examples")) for name, c in conditions.items()]
    for one in lists:
        counts = counts.crossJoin(one)  # one row each
    pairs = [F.concat(F.lit(f'"{n}": '), F.col(n).cast("string")) for n in conditions] + [F.concat(F.lit(f'"{n}_examples": '), F.col(f"{n}_examples")) for n in conditions]
    return counts.select(F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}")).alias("value"))


def write_unless_dry(rows: DataFrame, path: str, dry: bool, write=None) -> None:
    """Writes rows, as Parquet or by a function of rows and path; a dry run writes nothing (reports are made all the same)."""
    if not dry:
        (write or (lambda r, p: r.write.parquet(p)))(rows, path)


def examples(rows: DataFrame, order: str, most: int = 50) -> DataFrame:
    """The first examples of a report, in input order."""
    return rows.orderBy(order).limit(most)


def counted(rows: DataFrame, **conditions) -> DataFrame:
    """Run counters by one aggregate: a column for each condition."""
    return rows.agg(*(F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(k) for k, c in conditions.items()))
