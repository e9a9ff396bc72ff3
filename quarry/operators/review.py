"""Human review as an append-only history of events.

An event is (dataset, line_index, revision, verdict or null for a deletion, ...). The state is the event of the largest
revision; revisions go on after a deletion. A writer reads the largest revision before it appends and fails where it is
not the one that it saw: one writer at a time is assumed, as files have no transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import percent


class Conflict(ValueError):
    """Another revision was written since."""


def current(events: DataFrame, keys: list[str], revision: str = "revision", deleted: Column | None = None) -> DataFrame:
    """The latest event of each key, deletions left out. Partial aggregation: a key with many events is no hot task."""
    names = [c for c in events.columns if c not in keys]
    out = events.groupBy(*keys).agg(F.max_by(F.struct(*names), F.col(revision)).alias("e")).select(*keys, "e.*")
    return out.filter(~deleted) if deleted is not None else out


def append(events: DataFrame, path: str, change: DataFrame, keys: list[str], expected: Column) -> None:
    """Appends changes with the next revision; raises Conflict where the stored revision isn't the expected one."""
    last = events.groupBy(*keys).agg(F.max("revision").alias("_last"))
    new = change.withColumn("_expected", expected).join(last, keys, "left").withColumn("_last", F.coalesce("_last", F.lit(0)))
    if not new.filter("_last <> _expected").isEmpty():
        raise Conflict("the record was changed since it was read")
    new.withColumn("revision", F.col("_last") + 1).drop("_last", "_expected").write.mode("append").parquet(path)


def delete(events: DataFrame, path: str, keys: DataFrame, names: list[str], expected: Column) -> None:
    """Appends tombstones (verdict null) for keys that have a review; a key without one raises KeyError."""
    state = current(events, names, deleted=F.col("verdict").isNull())
    if not keys.join(state, names, "left_anti").isEmpty():
        raise KeyError("no review to delete")
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields if f.name not in (*names, "revision")]
    append(events, path, keys.select(*names, *blank), names, expected)


def stale(state: DataFrame, records: DataFrame, keys: list[str]) -> DataFrame:
    """state with ``stale``: the record's hash or its data's signature is no longer the reviewed one."""
    now = records.select(*keys, F.col("record_hash").alias("_h"), F.col("signature").alias("_s"))
    out = state.join(now, keys, "left")
    return out.withColumn("stale", ~(F.col("record_hash").eqNullSafe(F.col("_h")) & F.col("signature").eqNullSafe(F.col("_s")))).drop("_h", "_s")


def progress(records: DataFrame, state: DataFrame, by: str) -> DataFrame:
    """good, bad, labeled, remaining and coverage by dataset and overall (dataset null)."""
    kept = state.filter("NOT stale") if "stale" in state.columns else state
    seen = kept.groupBy(by).agg(F.count_if(F.col("verdict") == "good").alias("good"), F.count_if(F.col("verdict") == "bad").alias("bad"), F.count("*").alias("labeled"))
    total = records.groupBy(by).agg(F.count("*").alias("total")).join(seen, by, "left").fillna(0)
    out = total.rollup(by).agg(*(F.sum(c).alias(c) for c in ("total", "good", "bad", "labeled")))
    return out.withColumns({"remaining": F.col("total") - F.col("labeled"), "coverage": percent(F.col("labeled"), F.col("total"))})


def next_unlabeled(records: DataFrame, state: DataFrame, keys: list[str], index: str, after: int) -> DataFrame:
    """The first record without a review after an index, going round at the end."""
    left = records.join(state.select(*keys).distinct(), keys, "left_anti")
    return left.orderBy(F.col(index) <= after, index).limit(1)


def exported(state: DataFrame, with_stale: bool = False) -> DataFrame:
    out = state if with_stale or "stale" not in state.columns else state.filter("NOT stale")
    return out.orderBy("dataset", "line_index")
