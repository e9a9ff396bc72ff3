"""Point lookups in an index of records: buckets by place, each with its least and largest place.

``write`` deals an index by ranges of (file, line_index) into Parquet files of a bounded number of rows in small row groups,
sorted, and notes for each file the range that it holds: one small row a file, themselves in place order. A lookup reads
the notes, finds the one file that can hold a place, and reads of it the row groups whose statistics allow it. Other tables of
the same places (audits, annotations, answers) are attached by position once, at writing, so one read gives all places of a
record.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import zipped
from . import files
from .offsets import BOM

#: Rows a file and bytes a row group.
ROWS, GROUP = 1 << 20, 1 << 20
KEYS = ["file", "line_index"]


def attached(index: DataFrame, others: Mapping[str, DataFrame], strict: bool = True) -> DataFrame:
    """index (file, line_index, byte_offset, byte_length) with ``<name>``: struct<file, byte_offset, byte_length> of the record
    of another table that stands at the same line_index; others: {name: index of that table with ``of``, the file whose
    records it tells of}. Strict: a record that stands alone on either side fails the job; else it has a null."""
    out = index
    for name, other in others.items():
        own = other.select(F.col("of").alias("file"), "line_index", F.struct("file", "byte_offset", "byte_length").alias(name))
        out = zipped(out, own, KEYS, name) if strict else out.join(own, KEYS, "left")
    return out


def write(index: DataFrame, path: str, rows: int = ROWS) -> None:
    """Writes an index for lookups: ``<path>/places`` and ``<path>/notes``."""
    spark = index.sparkSession
    number = max(1, -(-index.count() // rows))
    dealt = index.repartitionByRange(number, *KEYS).sortWithinPartitions(*KEYS)
    dealt.write.option("parquet.block.size", GROUP).option("maxRecordsPerFile", rows).parquet(f"{path}/places")
    own = spark.read.parquet(f"{path}/places").select(*KEYS, F.col("_metadata.file_path").alias("part"))
    notes = own.groupBy("part").agg(F.min(F.struct(*KEYS)).alias("least"), F.max(F.struct(*KEYS)).alias("largest"), F.count("*").alias("n"))
    notes.withColumns({"first_file": F.col("least.file"), "last_file": F.col("largest.file")}).repartitionByRange(max(1, number // 10_000), "first_file").sortWithinPartitions("least").write.parquet(f"{path}/notes")


def lookup(spark: SparkSession, path: str, file: str, line_index: int) -> DataFrame:
    """The index's row of one place (or none), from the one file that can hold it."""
    place = F.struct(F.lit(file).alias("file"), F.lit(line_index).cast("long").alias("line_index"))
    notes = spark.read.parquet(f"{path}/notes").filter((F.col("first_file") <= file) & (F.col("last_file") >= file)).filter((F.col("least") <= place) & (F.col("largest") >= place))
    parts = [r.part for r in notes.select("part").collect()]  # one, or two where a place is there twice
    schema = spark.read.parquet(f"{path}/places").schema
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*parts).filter((F.col("file") == file) & (F.col("line_index") == line_index))


def record_at(spark: SparkSession, path: str, file: str, line_index: int) -> dict:
    """One record with all that is attached to it, as values (of what is no JSON: null). An unknown place raises IndexError."""
    row = lookup(spark, path, file, line_index).first()
    if row is None:
        raise IndexError(line_index)

    def value(place) -> object:
        if place is None:
            return None
        try:
            return json.loads(files.read_bytes(spark, place.file, place.byte_offset, place.byte_length).removeprefix(BOM))
        except ValueError:
            return None

    rest = [c for c in row.__fields__ if c not in (*KEYS, "byte_offset", "byte_length")]
    return {"record": value(row)} | {c: value(row[c]) for c in rest}
