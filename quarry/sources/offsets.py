"""Byte places of records, for random access to large files of records.

``line_index`` is one pass in Spark over the lines of any number of files; ``array_index`` takes files that are one JSON
array. An index is a table (file, line_index, byte_offset, byte_length) that other queries filter by key;
``record_at`` reads one record back.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import files, records

TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*+"|[\[\]{},]', re.S)
BOM = b"\xef\xbb\xbf"


def line_index(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line_index (records from 0), byte_offset, byte_length (without the line break) of every line that isn't blank.

    A line's offset is the bytes of all lines before it: summed within the block of the file that holds it, and over the
    blocks before. A byte order mark counts to the first line's offset.
    """
    text = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"))
    own = text.withColumns({"n": F.octet_length("value") + 1, "record": (F.trim(F.translate("value", "\r\t", "  ")) != "").cast("int"), "at": F.monotonically_increasing_id()})
    sums = own.groupBy("file", "block").agg(F.sum("n").alias("bytes"), F.sum("record").alias("records"), F.max("size").alias("size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("file")
    # The text reader drops a byte order mark: then the lines are three bytes shorter than the file (or two, if its
    # last line has no break).
    short = F.when(F.max("size").over(every) - F.sum("bytes").over(every) >= 2, 3).otherwise(0)
    shift = sums.select("file", "block", (F.coalesce(F.sum("bytes").over(before), F.lit(0)) + short).alias("b"), F.coalesce(F.sum("records").over(before), F.lit(0)).alias("r"))
    within = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    out = own.withColumns({"bb": F.coalesce(F.sum("n").over(within), F.lit(0)), "rr": F.coalesce(F.sum("record").over(within), F.lit(0))}).join(shift, ["file", "block"]).filter("record = 1")
    return out.select("file", (F.col("r") + F.col("rr")).alias("line_index"), (F.col("b") + F.col("bb")).alias("byte_offset"), (F.col("n") - 1).cast("long").alias("byte_length"))


def array_places(data: bytes) -> list[tuple[int, int]]:
    """(offset, length) of the elements of a top-level JSON array; strings and escapes are heeded."""
    out, depth, begin = [], 0, 0
    for m in TOKEN.finditer(data):
        sign = m[0]
        if sign in (b"[", b"{"):
            depth += 1
            if depth == 1:
                if sign == b"{":
                    raise ValueError("not an array")
                begin = m.end()
        elif sign in (b"]", b"}", b","):
            if depth == 1 and sign != b"}":
                raw = data[begin : m.start()]
                if raw.strip():
                    out.append((begin + len(raw) - len(raw.lstrip()), len(raw.strip())))
                begin = m.end()
            if sign != b",":
                depth -= 1
                if depth == 0:
                    break
    return out


def array_index(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same index of files that are one JSON array each, split over tasks (``records``). In stores that Arrow's file
    systems don't know, a file is read whole by one task."""
    if all(records.reaches(p) for p in ([path] if isinstance(path, str) else path)):
        return records.records(spark, path, "array")

    @F.arrow_udf("array<struct<byte_offset:long,byte_length:long>>")
    def places(data: pa.Array) -> pa.Array:
        found = [[{"byte_offset": o, "byte_length": n} for o, n in array_places(x.as_py())] for x in data]
        return pa.array(found, pa.list_(pa.struct([("byte_offset", pa.int64()), ("byte_length", pa.int64())])))

    found = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.posexplode(places("content")).alias("line_index", "p"))
    return found.select("file", F.col("line_index").cast("long").alias("line_index"), "p.byte_offset", "p.byte_length")


def record_at(index: DataFrame, file: str, line_index: int) -> dict | None:
    """One record of an indexed file, or None where it is no JSON object."""
    row = index.filter((F.col("file") == file) & (F.col("line_index") == line_index)).first()
    if row is None:
        raise IndexError(line_index)
    raw = files.read_bytes(index.sparkSession, file, row.byte_offset, row.byte_length)
    try:
        value = json.loads(raw.removeprefix(BOM))
    except ValueError:
        return None
    return value if isinstance(value, dict) else None
