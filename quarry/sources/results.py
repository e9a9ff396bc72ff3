"""Outputs of evaluation runs: their files, what a file's folders say about it, its rows, and the import of a folder.

A result file is a JSON array, an object that holds one (or is one row itself), or JSON lines. Folders name the task
and the model. Everything after the listing of files is one Spark job over all files.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import evaluate
from ..operators.views import ALIASES, TASKS
from . import commits, files, records

# Names of result files, and of fields in order of precedence.
NAMES = "generated_answer*.{json,jsonl}"
INDEX = ("idx", "index", "sample_index", "sample_idx", "line_index")
RESPONSE = ("response", "model_response", "completion", "output", "text")
LISTS = ("results", "responses")
#: Files above this size are read by lines or by elements, as ``layout`` tells from their first bytes; others are parsed whole.
WHOLE, HEAD = 64 << 20, 1 << 20

_KNOWN = {**{t: t for t in TASKS}, **ALIASES}
_FOLDER = "^(" + "|".join(sorted(_KNOWN, key=len, reverse=True)) + ")(?:_(.*))?$"


def identity(path: Column, root: str, model: str | None = None) -> Column:
    """struct<task, model_name, scope> of a result file, or null where no folder above it names a task.

    The deepest folder ``<task>`` or ``<task>_<model>`` decides. Its rest and the folders below are the model, joined by
    slashes; without any, the folder above is. The scope is the folder above, as seen from the root.
    """
    top = root.rstrip("/")
    folders = F.slice(F.split(F.regexp_replace(path, "^file:/*", "/"), "/"), 1, F.size(F.split(F.regexp_replace(path, "^file:/*", "/"), "/")) - 1)
    at = F.array_max(F.transform(folders, lambda x, i: F.when(x.rlike(_FOLDER), i)))

    def told(parts: Column, k: Column) -> Column:
        own = F.get(parts, k)
        above = F.array_join(F.slice(parts, F.lit(1), k), "/")
        below = F.slice(parts, k + 2, F.size(parts))
        named = F.array_join(F.filter(F.concat(F.array(F.regexp_extract(own, _FOLDER, 2)), below), lambda x: x != ""), "/")
        said = F.lit((model or "").strip())
        name = F.when(said != "", said).when(named != "", named).otherwise(F.element_at(F.split(above, "/"), -1))
        tasks = F.create_map(*(F.lit(x) for pair in _KNOWN.items() for x in pair))
        scope = F.when(above == top, ".").when(above.startswith(top + "/"), F.substring(above, F.lit(len(top) + 2), F.length(above))).otherwise(above)
        return F.when(name != "", F.struct(tasks[F.regexp_extract(own, _FOLDER, 1)].alias("task"), name.alias("model_name"), scope.alias("scope")))

    return F.when(at.isNotNull(), told(folders, at))


def result_files(spark: SparkSession, root: str, model: str | None = None, names: str = NAMES) -> DataFrame:
    """file, size, modified and identity of all result files under a folder (or of one file). No content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(root)
    return found.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), identity(F.col("path"), root, model).alias("of"))


def _listed(content: str) -> Iterator[tuple[int, str]]:
    """(item, JSON text) of each row of a file; raises ValueError where it has none of the three layouts."""
    told = lambda i, x: (i, json.dumps(x, ensure_ascii=False, separators=(",", ":")))
    if not content or content.isspace():
        return
    try:
        value = json.loads(content)
    except ValueError:
        at = i = 0
        while at <= len(content):
            stop = content.find("\n", at)
            stop = len(content) if stop < 0 else stop
            if (line := content[at:stop]).strip():
                if not isinstance(x := json.loads(line), dict):
                    raise ValueError("a line is no object") from None
                yield told(i, x)
            at, i = stop + 1, i + 1
        return
    if isinstance(value, dict):
        value = next((value[k] for k in LISTS if value.get(k)), [value])
    if not isinstance(value, list):
        raise ValueError("neither a list nor objects")
    for i, x in enumerate(value):
        if isinstance(x, dict):
            yield told(i, x)


_ROWS = pa.schema([("file", pa.string()), ("item", pa.int32()), ("raw", pa.string()), ("error", pa.string())])


def _batches(file: str, content: str) -> list[pa.RecordBatch]:
    """The rows of a file as record batches, or its error alone: a file counts whole or not at all. Until its last row is
    read, rows are kept in Arrow's buffers, not as Python's objects."""
    out, held, size = [], [], 0

    def put() -> None:
        items, raws = zip(*held, strict=True)
        out.append(pa.RecordBatch.from_arrays([pa.array([file] * len(held), pa.string()), pa.array(items, pa.int32()), pa.array(raws, pa.string()), pa.nulls(len(held), pa.string())], schema=_ROWS))
        held.clear()

    try:
        for row in _listed(content):
            held.append(row)
            size += len(row[1]) + 64
            if size >= records.BATCH:
                put()
                size = 0
    except ValueError as e:
        return [pa.RecordBatch.from_pylist([{"file": file, "error": str(e)}], _ROWS)]
    if held:
        put()
    return out


def result_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, item, raw (JSON text of a row), error (of a file that can't be read; then raw is null)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield from _batches(b.column(0)[i].as_py(), b.column(1)[i].as_py().decode("utf-8", "replace").removeprefix("\ufeff"))

    # Rows leave a file one by one: an array of them would be copied with each row that is made of it.
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("content"))
    return whole.mapInArrow(run, "file string, item int, raw string, error string")


def result_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The same of large files of JSON lines, which no task holds whole."""
    from .readers import lines, strict_json

    own = lines(spark, paths).filter(F.trim("raw") != "").withColumn("error", strict_json(F.col("raw")))
    return own.select("file", F.col("source_index").cast("int").alias("item"), F.when(F.col("error").isNull(), F.col("raw")).alias("raw"), "error")


def layout(spark: SparkSession, path: str) -> str:
    """How a large file is read: as an array, as lines (by its name, or if its first line is an object and more follows) or
    whole (one object, over several lines or alone in the file)."""
    size = files.size(spark, path)
    begin = files.read_bytes(spark, path, 0, HEAD).removeprefix(b"\xef\xbb\xbf").lstrip()
    if begin[:1] == b"[" and path.endswith(".json"):
        return "array" if records.reaches(path) else "whole"
    if path.endswith(".jsonl"):
        return "lines"
    first, _, rest = begin.partition(b"\n")
    try:
        one = isinstance(json.loads(first), dict)
    except ValueError:
        one = False
    return "lines" if one and (rest.strip() or size > HEAD) else "whole"


def result_elements(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The same of large files that are one JSON array each: their elements are cut in many tasks. Elements that are no
    objects are left out, as in small files; one that is no JSON is an error of its own."""
    from .readers import strict_json

    own = records.records(spark, paths, "array", columns=("raw",)).withColumn("raw", F.col("raw").cast("string")).withColumn("error", strict_json(F.col("raw")))
    rows = own.filter("error IS NULL OR error <> 'not an object'")
    return rows.select("file", F.col("line_index").cast("int").alias("item"), F.when(F.col("error").isNull(), F.col("raw")).alias("raw"), "error")


def fields(rows: DataFrame) -> DataFrame:
    """rows with the fields of an answer: idx (text), response, raw_response, answer, error, prompt_mode, counts of tokens."""
    m = F.col("m")
    first_key = F.coalesce(*(F.when(F.map_contains_key(m, k), F.struct(m[k].alias("v"))) for k in INDEX))["v"]
    filled = lambda k: F.nullif(m[k], F.lit(""))
    response = F.coalesce(*(filled(k) for k in RESPONSE), F.lit(""))
    out = rows.withColumn("m", F.from_json("raw", "map<string,string>"))
    told = {"idx": first_key, "response": response, "raw_response": F.coalesce(filled("raw_response"), response), "answer": filled("answer"), "error": filled("error"), "prompt_mode": F.coalesce(filled("prompt_mode"), F.lit("unknown")), "question_text": filled("question_text"), "reasoning_path": filled("reasoning_path")}
    told |= {k: m[k].try_cast("long") for k in ("input_tokens", "processed_input_tokens", "num_tokens")}
    return out.withColumns(told).drop("m", "raw")


@dataclass
class Import:
    """runs, answers and diagnostics as DataFrames; files whose folders name no task."""

    runs: DataFrame
    answers: DataFrame
    diagnostics: DataFrame
    ignored: list[str]


def import_results(spark: SparkSession, root: str, gold: DataFrame, work: str, model: str | None = None, prefix: str = "bench_", names: str = NAMES) -> Import:
    """All results under a folder, scored against gold (dataset, idx, output); a dataset is the prefix and its task.

    A run is a (model, scope, prompt mode); its id is a hash of root, model and mode, so an import that is repeated
    takes the place of the earlier one (``evaluate.replaced``). The first answer to an index counts, a different second
    one makes it an error. work: a new folder for the rows and the scored rows, which are made once.
    """
    found = result_files(spark, root, model, names).collect()  # one row a file
    if not found:
        raise FileNotFoundError(f"no result files under {root}")
    ignored = sorted(r.file for r in found if r.of is None)
    known = [r for r in found if r.of is not None]
    if not known:
        raise ValueError("no result folder is named after a known task")
    kinds: dict[str, list[str]] = {"whole": [], "lines": [], "array": []}
    for r in known:
        kinds[layout(spark, r.file) if r.size > WHOLE else "whole"].append(r.file)
    rows = [f(spark, p) for f, p in zip((result_rows, result_lines, result_elements), kinds.values(), strict=True) if p]
    # Files are read once; what follows takes the columns that it needs.
    reduce(DataFrame.unionByName, rows).write.mode("errorifexists").parquet(f"{work}/rows")
    raw = spark.read.parquet(f"{work}/rows")
    # What folders say is told once a file: written, so that no filter on it is moved to the rows.
    raw.select("file").distinct().coalesce(1).select("file", identity(F.col("file"), root, model).alias("of")).write.parquet(f"{work}/files")
    raw = raw.join(F.broadcast(spark.read.parquet(f"{work}/files")), "file")
    top = root.rstrip("/")
    run_root = F.when(F.col("of.scope") == ".", F.lit(top)).when(F.col("of.scope").startswith("/"), F.col("of.scope")).otherwise(F.concat(F.lit(top + "/"), F.col("of.scope")))
    tagged = {"model_name": F.col("of.model_name"), "root_path": run_root, "dataset": F.concat(F.lit(prefix), F.col("of.task"))}
    broken = raw.filter("error IS NOT NULL").withColumns(tagged).select("model_name", "root_path", "dataset", F.lit("file_error").alias("type"), "file", "item", F.col("error").alias("value"))
    said = fields(raw.filter("raw IS NOT NULL").drop("error").withColumns(tagged))
    said = said.withColumn("run_id", F.substring(F.sha2(F.concat_ws("\n", "root_path", "model_name", "prompt_mode"), 256), 1, 24)).drop("of")
    good, wrong = evaluate.scored(said, gold)
    good.write.mode("errorifexists").parquet(f"{work}/scored")
    scored = spark.read.parquet(f"{work}/scored")
    answers = evaluate.deduplicated(scored)
    named = said.select("run_id", "model_name", "root_path").distinct()
    sets = gold.groupBy("dataset").agg(F.count("*").alias("n"))
    lacking = raw.withColumns(tagged).select("model_name", "root_path", "dataset").distinct().join(sets, "dataset", "left_anti")
    none = F.lit(None)
    invalid = wrong.join(sets.select("dataset"), "dataset", "left_semi").join(named, "run_id").select("model_name", "root_path", "dataset", "type", "file", "item", F.col("idx").alias("value"))
    first = scored.groupBy("run_id", "dataset", "line_index").agg(F.min(F.struct("file", "item")).alias("f"), F.min_by(F.xxhash64(F.to_json(F.struct("response", "raw_response", "answer", "error"))), F.struct("file", "item")).alias("h"))
    again = scored.join(first, ["run_id", "dataset", "line_index"]).filter(F.struct("file", "item") != F.col("f"))
    differs = F.xxhash64(F.to_json(F.struct("response", "raw_response", "answer", "error"))) != F.col("h")
    twice = again.select("model_name", "root_path", "dataset", F.when(differs, "duplicate_index_conflict").otherwise("duplicate_index").alias("type"), "file", "item", F.col("line_index").cast("string").alias("value"))
    diagnostics = broken.unionByName(invalid).unionByName(twice).unionByName(lacking.select("model_name", "root_path", "dataset", F.lit("dataset_missing").alias("type"), none.cast("string").alias("file"), none.cast("int").alias("item"), F.col("dataset").alias("value")))
    diagnostics.write.parquet(f"{work}/diagnostics")
    diagnostics = spark.read.parquet(f"{work}/diagnostics")
    group = ["model_name", "root_path"]
    expected = raw.withColumns(tagged).select(*group, "dataset").distinct().join(sets, "dataset", "left").groupBy(*group).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("expected"))
    counted = diagnostics.groupBy(*group).agg(F.count("*").alias("invalid"))
    per_file = raw.withColumns(tagged).select(*group, "file").distinct().groupBy(*group).agg(F.count("*").alias("files"))
    runs = scored.select("run_id", *group, "prompt_mode").distinct().join(expected, group).join(counted, group, "left").join(per_file, group).fillna(0, ["invalid"])
    runs = evaluate.scoreboard(runs, answers)
    runs = evaluate.import_summary(runs, F.col("expected"), F.col("invalid")).drop("expected", "invalid")
    return Import(runs, answers, diagnostics, ignored)


def commit_import(log: commits.Log, found: Import) -> commits.State:
    """Puts an import's answers into a log, each run's in place of its earlier ones, in one step."""
    return commits.replace_each(log, found.answers, "run_id")


def source_signature(found: DataFrame) -> str:
    """A hash of the listed files, their sizes and times: what an import was made from."""
    told = found.select(F.concat_ws(":", "file", "size", F.col("modified").cast("long")).alias("s"))
    return told.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("s")), "\n"), 256)).first()[0]  # one row a file
