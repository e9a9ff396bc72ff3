"""Sinks: samples with audit rows, quarantine, annotated rows, exports, and checked cube files."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files


def write_pair(df: DataFrame, sample: list[str], audit: list[str], path: str) -> None:
    """Samples and their audit rows, from one written table, so that both hold the same rows. Spark's committer shows
    either all of a table or nothing."""
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    try:
        rows.select(*sample).write.json(f"{path}/samples")
        rows.select(*audit).write.json(f"{path}/audit")
    except BaseException:
        for half in ("samples", "audit", "rows"):
            files.delete(spark, f"{path}/{half}")
        raise


def write_export(df: DataFrame, path: str, kind: str = "jsonl") -> None:
    """A small export as one file on any store: JSON lines, or CSV that spreadsheet programs read as UTF-8."""
    if kind == "jsonl":
        files.write_text(df.sparkSession, path, (r[0] + "\n" for r in df.select(F.to_json(F.struct("*"))).toLocalIterator()))
        return

    def line(values: list) -> str:
        out = io.StringIO()
        csv.writer(out).writerow(values)
        return out.getvalue()

    def lines() -> Iterator[str]:
        yield "\ufeff" + line(df.columns)
        for r in df.toLocalIterator():
            yield line(list(r))

    files.write_text(df.sparkSession, path, lines())


def failing(df: DataFrame, wrong: Column, message: str) -> DataFrame:
    """df; a row for which ``wrong`` holds makes the job fail with a message."""
    return df.filter(F.coalesce(F.when(wrong, F.raise_error(F.lit(message))).cast("boolean"), F.lit(True)))


def load_cells(spark: SparkSession, path: str, by: str, dims: dict[str, list[str]]) -> DataFrame:
    """A cube's CSV: columns, levels, counts that aren't negative and cells that occur once are checked."""
    df = spark.read.csv(path, header=True)
    if lacking := {by, "count", *dims} - set(df.columns):
        raise ValueError(f"cube file lacks {sorted(lacking)}")
    rows = df.select(by, *dims, F.col("count").try_cast("long").alias("count"))
    rows = failing(rows, F.col("count").isNull() | (F.col("count") < 0), "cube count is no non-negative number")
    for d, values in dims.items():
        rows = failing(rows, ~F.coalesce(F.col(d).isin(*values), F.lit(False)), f"unknown level of {d}")
    keys = [c for c in rows.columns if c != "count"]
    once = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum("count").alias("count"))
    return failing(once, F.col("_n") > 1, "duplicate cube cell").drop("_n")


def load_distributions(spark: SparkSession, path: str, by: str = "source") -> DataFrame:
    """A cube's file with columns by, quality, difficulty and count, checked; by, dimension, value, count. The totals of both
    dimensions must agree for each value of ``by``."""
    from ..operators.resolve import DIFFICULTY, QUALITY

    cells = load_cells(spark, path, by, {"quality": list(QUALITY), "difficulty": list(DIFFICULTY)})
    tall = cells.select(by, "count", F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in ("quality", "difficulty")))).alias("p"))
    sums = tall.groupBy(by, "p.dimension", "p.value").agg(F.sum("count").alias("count"))
    totals = sums.groupBy(by).agg(F.sum(F.when(F.col("dimension") == "quality", F.col("count"))).alias("q"), F.sum(F.when(F.col("dimension") == "difficulty", F.col("count"))).alias("d"))
    return sums.join(failing(totals, ~F.col("q").eqNullSafe(F.col("d")), "totals of quality and difficulty differ").select(by), by)
