"""Conversion of raw rows to input, timeseries and output, with reasons for what can't be converted."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.series import SOURCE_MARK, Options, Unusable, channels, context, filled, inline, quoted_pair
from ..functions.text import PLACEHOLDER, combined_text

# Field aliases in order of precedence.
QUESTION = ("question", "query", "prompt", "input")
ANSWER = ("answer", "output", "response", "target", "label")
SERIES = ("input_ts", "timeseries", "time_series", "series", "ts_data", "data_points", "time_series_data")
CONTEXT = ("meta_info", "context", "context_text", "description")
EMBEDDED_CONTEXT = ("context", "context_text", "meta_info", "description")
COMBINED = ("text", "qa", "question_answer", "formatted_text")
PAIRS = ("qa_list", "qa_pair", "qa")
NOT_TRAIN = ("test", "val", "valid", "validation", "dev")

SAMPLE = "struct<input:string,timeseries:array<array<double>>,output:string,used_missing_mask:boolean,reason:string>"


def field(df: DataFrame, aliases: tuple[str, ...]) -> Column:
    """The first alias, in any case, whose value is neither null nor blank."""
    names = {c.lower(): c for c in reversed(df.columns)}
    found = [F.col(names[a]) for a in aliases if a in names]
    text = [F.when(F.trim(c.cast("string")) != "", c.cast("string")) if not str(df.schema[names[a]].dataType).startswith(("Array", "Struct")) else F.to_json(c) for a, c in ((a, F.col(names[a])) for a in aliases if a in names)]
    return F.coalesce(*text) if found else F.lit(None).cast("string")


def is_training_file(path: Column) -> Column:
    """No part of the file's stem names another split."""
    stem = F.regexp_extract(F.lower(path), r"([^/]*?)(?:\.[^./]*)?$", 1)
    return ~F.arrays_overlap(F.split(stem, "[^a-z0-9]+"), F.array(*map(F.lit, NOT_TRAIN)))


def is_contaminated_file(path: Column) -> Column:
    return F.array_contains(F.split(F.lower(path), "/"), "classification")


def is_contaminated_row(dataset: Column) -> Column:
    return F.contains(F.lower(F.coalesce(dataset, F.lit(""))), F.lit("sunspot"))


def invalid_reason(sample: Column, most_series: int = 30) -> Column:
    """Why a sample isn't valid, or null."""
    series, prompt = sample["timeseries"], sample["input"]
    marks = F.regexp_count(prompt, F.lit(PLACEHOLDER))
    return (
        F.when(F.trim(F.coalesce(prompt, F.lit(""))) == "", "empty input prompt")
        .when(F.trim(F.coalesce(sample["output"], F.lit(""))) == "", "empty output answer")
        .when(F.coalesce(F.size(series), F.lit(0)) < 1, "no time series extracted")
        .when(marks != F.size(series), "placeholder/series mismatch")
        .when(F.size(series) > most_series, "too many series")
        .when(F.exists(series, lambda s: F.size(s) == 0), "empty time-series array")
        .when(F.exists(F.flatten(series), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), "non-finite value remains after conversion")
    )


def _primary(question: str, series: str | None, said: str | None, options: Options) -> tuple[str, list[list[float]], bool]:
    if series is None:
        raise Unusable("missing input series")
    arrays, mark, mask = filled(channels(series, False), options)
    text, more, inner = inline(question, options)
    parts = [f"Context information: {context(said)}"] if context(said) else []
    return "\n\n".join([*parts, f"Input time series: {mark}.", text.strip()]), arrays + more, mask or inner


def _embedded(question: str, series: str | None, said: str | None, options: Options) -> tuple[str, list[list[float]], bool]:
    text, arrays, mask = inline(question, options)
    if not arrays:
        if series is None:
            raise Unusable("no numeric array found in question")
        arrays, mark, mask = filled(channels(series, True), options)
        if SOURCE_MARK.search(text):
            text = SOURCE_MARK.sub(lambda _: mark, text, count=1)
        elif text.count(PLACEHOLDER) != len(arrays):
            text = f"Input time series: {mark}.\n\n{text}"
    about = context(said)
    if about and about not in text:
        text = f"Context information: {about}\n\n{text}"
    return text.strip(), arrays, mask


def converted(df: DataFrame, adapter: str, options: Options = Options()) -> DataFrame:  # noqa: B008
    """df with ``sample``: input, timeseries, output, used_missing_mask and reason (null where the row is valid).

    adapter ``primary``: a series field, then arrays in the question. ``embedded``: arrays in the question, else a series
    field; question and answer may stand in a fragment or in one text.
    """
    asked, told = combined_text(field(df, COMBINED))
    embedded = adapter == "embedded"
    build = _embedded if embedded else _primary

    @F.arrow_udf(SAMPLE)
    def sample(question: pa.Array, answer: pa.Array, series: pa.Array, about: pa.Array, pair: pa.Array, asked: pa.Array, told: pa.Array) -> pa.Array:
        out = []
        for q, a, s, c, p, q2, a2 in zip(*(x.to_pylist() for x in (question, answer, series, about, pair, asked, told)), strict=True):
            q, a = (q or "").strip(), (a or "").strip()
            if embedded and not (q and a):
                x, y = quoted_pair(p)
                q, a = q or x or (q2 or ""), a or y or (a2 or "")
            try:
                if not q:
                    raise Unusable("missing question")
                text, arrays, mask = build(q, s, c, options)
                out.append({"input": text, "timeseries": arrays, "output": a, "used_missing_mask": mask, "reason": None})
            except Unusable as e:
                out.append({"input": None, "timeseries": None, "output": a, "used_missing_mask": None, "reason": str(e)})
        kind = pa.struct([("input", pa.string()), ("timeseries", pa.list_(pa.list_(pa.float64()))), ("output", pa.string()), ("used_missing_mask", pa.bool_()), ("reason", pa.string())])
        return pa.array(out, kind)

    question = QUESTION + (("instruction",) if embedded else ())
    series = SERIES if embedded else SERIES[:4]
    out = df.withColumn("sample", sample(field(df, question), field(df, ANSWER), field(df, series), field(df, EMBEDDED_CONTEXT if embedded else CONTEXT), field(df, PAIRS), asked, told))
    return out.withColumn("sample", F.col("sample").withField("reason", F.coalesce("sample.reason", invalid_reason(F.col("sample"), options.most_series))))


def sample_digest(sample: Column) -> Column:
    """SHA-256 of a sample's canonical JSON (sorted keys, Python's way of writing numbers)."""

    @F.arrow_udf("string")
    def digest(prompt: pa.Array, series: pa.Array, output: pa.Array) -> pa.Array:
        import hashlib

        rows = zip(prompt.to_pylist(), series.to_pylist(), output.to_pylist(), strict=True)
        return pa.array([hashlib.sha256(json.dumps({"input": p, "output": o, "timeseries": s}, ensure_ascii=False, separators=(",", ":")).encode("utf-8", "surrogatepass")).hexdigest() for p, s, o in rows])

    return digest(sample["input"], sample["timeseries"], sample["output"])


def first_of_each(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """Of the rows of one key the first in order: the rank limit is applied before the shuffle."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_r = 1").drop("_r")


def value_histogram(df: DataFrame, names: tuple[str, ...] = ("task", "type")) -> DataFrame:
    """field, value, rows: how many converted rows have each task and type, most first."""
    own = {n: field(df, (n,)) for n in names}
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("field"), c.alias("value")) for n, c in own.items())))
    out = df.filter("sample.reason IS NULL").select(pairs.alias("p")).filter("p.value IS NOT NULL")
    return out.groupBy("p.field", "p.value").agg(F.count("*").alias("rows")).orderBy("field", F.desc("rows"), "value")


def conversion_report(df: DataFrame) -> DataFrame:
    """Counts of rows by reason (null: written), with series and lengths of what was written."""
    sizes = F.transform("sample.timeseries", lambda s: F.size(s))
    return df.groupBy(F.col("sample.reason").alias("reason")).agg(F.count("*").alias("rows"), F.sum(F.size("sample.timeseries")).alias("series"), F.max(F.size("sample.timeseries")).alias("most_series"), F.max(F.array_max(sizes)).alias("longest"), F.count_if("sample.used_missing_mask").alias("masked"))
