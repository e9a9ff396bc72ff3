"""Readers: discovery, lines with their places, dispatch by format, registries."""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files

FORMATS = ("csv", "json", "jsonl", "parquet")


def discover(spark: SparkSession, inputs: list[str]) -> list[str]:
    """Files with a known suffix (any case) under the inputs, once each, sorted; none is an error. Listed by Spark's own
    file systems, so any store will do."""
    jvm = spark.sparkContext._jvm
    conf, found = spark.sparkContext._jsc.hadoopConfiguration(), set()
    for x in inputs:
        path = jvm.org.apache.hadoop.fs.Path(x)
        system = path.getFileSystem(conf)
        if system.getFileStatus(path).isFile():
            found.add(str(system.makeQualified(path)))
            continue
        files = system.listFiles(path, True)
        while files.hasNext():
            found.add(str(files.next().getPath()))
    out = sorted(f for f in found if f.rsplit(".", 1)[-1].lower() in FORMATS)
    if not out:
        raise FileNotFoundError(f"no supported files in {inputs}")
    return out


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, source_index (physical line from 0), raw, sha256 of the raw line.

    Spark splits files at any byte, so places come from the byte offsets of splits: lines are numbered within each
    file by window over offset blocks, not by one task a file.
    """
    text = spark.read.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    # Lines of one block come in order; the row id grows with it.
    text = text.withColumn("at", F.monotonically_increasing_id())
    counts = text.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    own = text.withColumn("k", F.row_number().over(Window.partitionBy("file", "block").orderBy("at")) - 1)
    out = own.join(shift, ["file", "block"])
    return out.select("file", (F.col("k") + F.col("shift")).cast("long").alias("source_index"), "raw", F.sha2("raw", 256).alias("source_sha256"))


def strict_json(raw: Column, keys: tuple[str, ...] | None = None) -> Column:
    """Why a line is no JSON object (with exactly these keys), or null. Spark's reader takes trailing text, so Python's is
    used, a batch of lines at a time."""
    def reason(line: str | None) -> str | None:
        try:
            value = json.loads((line or "").removeprefix("﻿"))
        except ValueError:
            return "JSONDecodeError"
        if not isinstance(value, dict):
            return "not an object"
        return "unexpected keys" if keys is not None and set(value) != set(keys) else None

    @F.arrow_udf("string")
    def checked(batch: pa.Array) -> pa.Array:
        return pa.array([reason(x) for x in batch.to_pylist()], pa.string())

    return checked(raw)


def validated(spark: SparkSession, path: str, keys: tuple[str, ...] = ("input", "timeseries", "output")) -> tuple[DataFrame, DataFrame]:
    """Valid samples and quarantined lines (index, digest, reason, 200 characters). Blank lines are skipped but count."""
    all_ = lines(spark, path).filter(F.trim("raw") != "").withColumn("reason", strict_json(F.col("raw"), keys))
    shape = "struct<input:string,timeseries:array<array<double>>,output:string>"
    good = all_.filter("reason IS NULL").withColumn("s", F.from_json("raw", shape)).select("file", "source_index", "source_sha256", "s.*")
    return good, all_.filter("reason IS NOT NULL").select("file", "source_index", "source_sha256", "reason", F.substring("raw", 1, 200).alias("preview"))


#: Columns that tell where a row of ``read_many`` stands: its file, the block of it, and its order there.
PLACE = ("_path", "_start", "_at")
LISTS = ("train", "data", "rows", "examples")


def _placed(df: DataFrame) -> DataFrame:
    return df.withColumns({"_path": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id()})


def _csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.csv(paths, header=True, multiLine=True, quote='"', escape='"')


def _json(df: DataFrame) -> DataFrame:
    """Rows of files of which some are a list or an object, and some an object with a list of rows."""
    for name in LISTS:
        if name in df.columns and isinstance(df.schema[name].dataType, T.ArrayType) and isinstance(df.schema[name].dataType.elementType, T.StructType):
            own = [c for c in df.columns if c in PLACE]
            listed = df.filter(F.col(name).isNotNull()).select(*own, F.posexplode(name).alias("_item", "r")).select(*own, "_item", "r.*")
            rest = df.filter(F.col(name).isNull()).drop(name)
            return listed if not [c for c in rest.columns if c not in own] else alike([listed, rest])
    return df


def _jsonl(spark: SparkSession, paths: list[str], placed: bool) -> DataFrame:
    """Lines are checked as they are read; their columns are found by a pass before."""
    shape = spark.read.json(paths).schema
    text = spark.read.text(paths)
    text = (_placed(text) if placed else text).filter(F.trim("value") != "")
    reason = strict_json(F.col("value"))
    told = text.withColumn("_why", reason)
    told = told.filter(F.coalesce(F.when(F.col("_why").isNotNull(), F.raise_error(F.concat(F.lit("a line is no record: "), F.col("_why")))).cast("boolean"), F.lit(True)))
    own = [c for c in told.columns if c in PLACE]
    return told.select(*own, F.from_json(F.regexp_replace("value", "^\ufeff", ""), shape).alias("r")).select(*own, "r.*")


def alike(parts: list[DataFrame]) -> DataFrame:
    """The union of frames of different columns. Of a column that has several types the values become text: numbers as Spark
    writes them, arrays and structs as JSON."""
    kinds: dict[str, set[str]] = {}
    for p in parts:
        for f in p.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    out: DataFrame | None = None
    for p in parts:
        told = {}
        for f in p.schema.fields:
            if len(kinds[f.name]) > 1 and f.dataType != T.StringType():
                told[f.name] = F.to_json(f.name) if isinstance(f.dataType, T.ArrayType | T.StructType | T.MapType) else F.col(f.name).cast("string")
        p = p.withColumns(told) if told else p
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def read_many(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of files of all formats with their places (``PLACE``): one scan a format, and for CSV one a header. Lines that are
    no JSON object fail the job."""
    by: dict[str, list[str]] = {}
    for p in paths:
        kind = p.rsplit(".", 1)[-1].lower()
        if kind not in FORMATS:
            raise ValueError(f"unsupported format: {p}")
        by.setdefault(kind, []).append(p)
    parts = []
    headers: dict[bytes, list[str]] = {}
    for p in by.get("csv", ()):  # a header is a file's first line
        headers.setdefault(files.read_bytes(spark, p, 0, 1 << 16).split(b"\n")[0].strip(), []).append(p)
    parts += [_placed(_csv(spark, own)) for own in headers.values()]
    if "json" in by:
        parts.append(_json(_placed(spark.read.json(by["json"], multiLine=True))))
    if "jsonl" in by:
        parts.append(_jsonl(spark, by["jsonl"], True))
    if "parquet" in by:
        parts.append(_placed(spark.read.option("mergeSchema", True).parquet(*by["parquet"])))
    out = alike(parts)
    return out if "_item" in out.columns else out.withColumn("_item", F.lit(0))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Strings only, quoted line breaks kept."""
    return _csv(spark, [path])


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A top-level list, an object with a list under train, data, rows or examples, or one object."""
    out = _json(spark.read.json(path, multiLine=True))
    return out.drop("_item")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One object a line; blank lines are skipped, a line that is no object fails the job. ``validated`` quarantines instead."""
    return _jsonl(spark, [path], False)


def read(spark: SparkSession, path: str) -> DataFrame:
    """By suffix."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind not in FORMATS:
        raise ValueError(f"unsupported format: {path}")
    return {"csv": read_csv, "json": read_json, "jsonl": read_jsonl, "parquet": lambda s, p: s.read.parquet(p)}[kind](spark, path)


@dataclass(frozen=True)
class Source:
    name: str
    path: str
    split: str = "train"
    audit: str | None = None


def registry(path: str, spark: SparkSession | None = None) -> list[Source]:
    """Sources of a JSON file: unique names, existing paths, relative to the file. With a session on any store."""
    spark = spark or SparkSession.active()
    base = path.rsplit("/", 1)[0] if "/" in path else "."
    found = json.loads(files.read_text(spark, path))
    out = []
    for x in found["sources"] if isinstance(found, dict) else found:
        places = {}
        for name in ("path", "audit"):
            if x.get(name):
                places[name] = x[name] if x[name].startswith("/") or "://" in x[name] else f"{base}/{x[name]}"
                if not files.exists(spark, places[name]):
                    raise FileNotFoundError(places[name])
        out.append(Source(x["name"], places["path"], x.get("split", "train"), places.get("audit")))
    if len({s.name for s in out}) != len(out):
        raise ValueError("source names must be unique")
    return out


def benchmark_files(spark: SparkSession, roots: list[str], tasks: dict[str, tuple[str, str]]) -> dict[str, tuple[str, str]]:
    """{task: (path, group)} under the first of the roots that is a folder: at the task's usual place, or any file of its name.

    tasks: {task: (relative path, group)}. Roots come in order of precedence: a user's choice first, then usual places.
    """
    root = next((r for r in roots if files.is_dir(spark, r)), None)
    if root is None:
        return {}
    stems = {f.rsplit("/", 1)[1].removesuffix(".jsonl"): f for f in discover(spark, [root]) if f.endswith(".jsonl")}
    out = {}
    for task, (relative, group) in tasks.items():
        usual = f"{root.rstrip('/')}/{relative}"
        place = usual if files.exists(spark, usual) else stems.get(task)
        if place:
            out[task] = (place, group)
    return out
