"""What several operators share: durable intermediate tables and gapless row numbers."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "/tmp/checkpoints"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def trim() -> None:
    """Gives memory that a Python worker has freed back to the system: workers live on and share an executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable, every: int = 64) -> Callable:
    """A function of record batches that trims now and then, and at its end."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, out in enumerate(run(batches), 1):
            yield out
            if k % every == 0:
                trim()
        gc.collect()
        trim()

    return wrapped


def bound_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Lowers the bytes of an Arrow batch for this session: a batch of many whole texts takes much of a worker's memory."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if as_bytes(spark.conf.get(name)) > size:
        spark.conf.set(name, size)


def as_bytes(text: str) -> int:
    """A size as a setting gives it."""
    return int(text) if text.lstrip("-").isdigit() else 1 << 62


#: Files of a small intermediate table: so many a core, or a file for so many shuffle partitions, whichever is more.
A_CORE, A_FILE = 3, 8
#: Folders that this process has made for intermediate tables, and those of the run that is under way, if it is told of.
_made: list[str] = []
_run: ContextVar[list[str] | None] = ContextVar("run", default=None)


def materialize(df: DataFrame, release: bool = False, few: bool = False) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: cuts the lineage, survives lost executors.

    few: for a table far smaller than the input; its partitions are written one after another to fewer files (where
    rows know their partition's number it mustn't be set). release: also lets the driver collect its garbage, on which
    Spark deletes the shuffle files of jobs that are over.
    """
    spark, schema = df.sparkSession, df.schema
    path = f"{shared_dir(spark)}/quarry-{uuid.uuid4().hex}"
    _made.append(path)
    if (own := _run.get()) is not None:
        own.append(path)
    if few:
        df = df.coalesce(max(A_CORE * spark.sparkContext.defaultParallelism, partitions(spark) // A_FILE))
    df.write.parquet(path)
    if release:
        del df
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


class Run:
    """Tells the intermediate tables of one run from those of all others, within a ``with`` block of one thread."""

    def __enter__(self) -> Run:
        self.made: list[str] = []
        self._token = _run.set(self.made)
        return self

    def __exit__(self, *_: object) -> None:
        _run.reset(self._token)

    def clean(self, spark: SparkSession, but: DataFrame | None = None) -> None:
        """Deletes this run's tables, less those that ``but`` reads."""
        clean(spark, but, self.made)


def clean(spark: SparkSession, but: DataFrame | None = None, made: list[str] | None = None) -> None:
    """Deletes intermediate tables, those of a list or all that this process has made, less those that ``but`` reads. What
    was returned lazily from them before can't be read any more."""
    kept = {f.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") for f in but.inputFiles()} if but is not None else set()
    jvm = spark.sparkContext._jvm
    for path in list(_made if made is None else made):
        if path.split(":", 1)[-1].lstrip("/") not in kept:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
            for held in {id(x): x for x in (_made, made or _made)}.values():
                held.remove(path)


class KeyFilter:
    """A Bloom filter of a column of 64-bit hashes, 8 MB whatever its number of keys, for use where a join would
    otherwise shuffle the texts of rows that have no partner. It lets all rows with a partner through."""

    BITS = 26

    def __init__(self, hashes: DataFrame) -> None:
        (name,) = hashes.columns
        bits = hashes.select(F.explode(F.array(*self._places(F.col(name)))).alias("p")).select(F.shiftright("p", 5).alias("w"), F.expr("shiftleft(1L, cast(p & 31 as int))").alias("m"))
        words = bits.groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
        self.bits = np.zeros(1 << (self.BITS - 5), np.uint32)
        self.bits[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64).astype(np.uint32)

    def _places(self, key: Column) -> list[Column]:
        return [F.shiftrightunsigned(F.xxhash64(key, F.lit(k)), 64 - self.BITS) for k in (1, 2)]

    def may_have(self, key: Column, once: Column | None = None) -> Column:
        """Whether the filter may hold key. once: of equal values of it, a task lets only the first through."""
        bits = self.bits

        def hits(p: pa.Array, q: pa.Array) -> np.ndarray:
            p, q = p.to_numpy(), q.to_numpy()
            return ((bits[p >> 5] >> (p & 31).astype(np.uint32)) & (bits[q >> 5] >> (q & 31).astype(np.uint32)) & 1).astype(bool)

        if once is None:

            @F.arrow_udf("boolean")
            def may(p: pa.Array, q: pa.Array) -> pa.Array:
                return pa.array(hits(p, q))

            return may(*self._places(key))
        seen: set[int] = set()

        @F.arrow_udf("boolean")
        def first(p: pa.Array, q: pa.Array, h: pa.Array) -> pa.Array:
            out = hits(p, q)
            for i in np.flatnonzero(out).tolist():
                x = h[i].as_py()
                out[i] = x not in seen
                seen.add(x)
            return pa.array(out)

        return first(*self._places(key), once)


def partitions(spark: SparkSession) -> int:
    """How many partitions a wide step uses: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_ranks(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``name``: gapless numbers from 0 within each value of ``by``, in ascending ``order``.

    No group is gathered in one task: rows are dealt by ranges of ``order``, numbered within (range, group), and
    shifted by the counts of the ranges before. What is summed up per group is one row a range. Rows that tie on
    ``order`` are numbered in any order. The frame should be narrow: it is written once.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(partitions(spark), *order).withColumn("_range", F.spark_partition_id())
    dealt = materialize(dealt)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_range", *by).agg(F.count("*").alias("_n"))
    shifts = counts.select("_range", *by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_range", *by).orderBy(*order)
    out = dealt.withColumn("_rank", F.row_number().over(within) - 1)
    same: Column = out["_range"].eqNullSafe(shifts["_range"])
    for c in by:
        same = same & out[c].eqNullSafe(shifts[c])
    keep = [out[c] for c in df.columns]
    return out.join(shifts, same).select(*keep, (out["_rank"] + shifts["_shift"]).cast("long").alias(name))
