"""Incremental review state.

The engine's sources are bounded; what grows is the review history. ``fold`` keeps the latest event of each key while
new events arrive in files, as a Structured Streaming query with an upsert a micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.review import current
from ..sources import files

#: Parts of the state, by a hash of the key; a micro-batch rewrites those that its keys are in.
PARTS = 64
#: Versions of a part that are kept: the newest, and the one that a reader may still be at.
KEPT = 2


def fold(events: DataFrame, keys: list[str], state: str, checkpoint: str, parts: int = PARTS) -> StreamingQuery:
    """Folds each micro-batch into the state: for the parts of its keys a new version is written as
    ``state``/part=<p>/version=<batch>; the others stay as they are.

    A batch that is run again reads the versions before it and writes the same one, so nothing is counted twice.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = current(batch, keys).withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
        new.persist()
        try:
            touched = sorted(r._part for r in new.select("_part").distinct().collect())  # PARTS rows at most
            before = [x for p in touched if (x := _newest(spark, state, p, number)) is not None]
            rows = new.drop("_part")
            if before:
                rows = current(spark.read.parquet(*before).unionByName(rows), keys)
            placed = rows.withColumns({"part": F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"), "version": F.lit(number)})
            placed.repartition(min(parts, len(touched) or 1), "part").write.mode("append" if not touched else "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part", "version").parquet(state)
            for p in touched:
                for old in _versions(spark, state, p, number)[:-KEPT]:
                    files.delete(spark, f"{state}/part={p}/version={old}")
        finally:
            new.unpersist()

    return events.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, state: str, part: int, before: int | None) -> list[int]:
    found = sorted(int(n.split("=")[1]) for n in files.listed(spark, f"{state}/part={part}") if n.startswith("version="))
    return [v for v in found if before is None or v < before]


def _newest(spark: SparkSession, state: str, part: int, before: int | None = None) -> str | None:
    found = _versions(spark, state, part, before)
    return f"{state}/part={part}/version={found[-1]}" if found else None


def latest(spark: SparkSession, state: str, before: int | None = None) -> DataFrame | None:
    """The newest version of each part of the state (before a batch), or None."""
    parts = [int(n.split("=")[1]) for n in files.listed(spark, state) if n.startswith("part=")]
    found = [x for p in parts if (x := _newest(spark, state, p, before)) is not None]
    return spark.read.parquet(*found) if found else None
