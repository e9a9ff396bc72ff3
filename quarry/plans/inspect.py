"""What a browser of datasets asks for: catalogue, one record with all that is known of it, progress, settings.

Each function filters indexed tables by key or joins small ones; errors are typed, and ``status_of`` gives each its number.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import series, text
from ..operators import evaluate
from ..operators.review import Conflict
from ..sources import commits, files


#: Tries to have a settings file for oneself.
TRIES = 10


class Forbidden(PermissionError):
    """The record must not be changed."""


def status_of(error: BaseException) -> int:
    """An error's number in HTTP."""
    kinds = ((Conflict, 409), (PermissionError, 403), (FileNotFoundError, 404), (KeyError, 404), (IndexError, 416), (ValueError, 400))
    return next((n for kind, n in kinds if isinstance(error, kind)), 500)


def setting(name: str, environment: str, saved: Mapping[str, object], config: Mapping[str, object]) -> tuple[object, str]:
    """A setting and where it comes from: the environment, what was saved, the configuration; blank ones don't count."""
    for where, value in (("environment", os.environ.get(environment)), ("settings", saved.get(name)), ("config", config.get(name))):
        if value is not None and str(value).strip():
            return value, where
    return None, "none"


def load_settings(spark: SparkSession, path: str) -> dict:
    return json.loads(files.read_text(spark, path)) if files.exists(spark, path) else {}


def save_setting(spark: SparkSession, path: str, name: str, value: object) -> None:
    """Saves one setting; two writers of one file take turns, so that none of their settings is lost."""
    for k in range(TRIES):
        lease = commits.Lease(spark, f"{path}.lease", 60)
        if lease.take():
            try:
                files.write_text(spark, path, json.dumps(load_settings(spark, path) | {name: value}, ensure_ascii=False, sort_keys=True))
            finally:
                lease.release()
            return
        time.sleep(min(0.05 * 2**k, 1.0))
    raise Conflict(f"{path} is being written")


def with_fields(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """df with the columns that it lacks, as nulls: rows written before a column was added."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in df.columns})


def is_training(datasets: DataFrame) -> DataFrame:
    """Datasets that may be reviewed for training: three-field samples of the train split that aren't for evaluation only."""
    return datasets.filter((F.col("schema") == "chatts") & (F.col("split") == "train") & ~F.col("training_role").eqNullSafe(F.lit("evaluation_only")))


def catalogue(datasets: DataFrame, records: DataFrame, template_stats: DataFrame, answers: DataFrame, state: DataFrame) -> DataFrame:
    """datasets (name, ...) with rows, templates and compression, runs that answered them, and reviews.

    records: dataset; template_stats: dataset, templates; answers: dataset, run_id; state: dataset, verdict. What a dataset
    lacks is 0, but for templates, which fall back to null where no statistics were made.
    """
    own = lambda df, *aggs: df.groupBy(F.col("dataset").alias("name")).agg(*aggs)
    out = datasets.join(own(records, F.count("*").alias("rows")), "name", "left")
    out = out.join(template_stats.select(F.col("dataset").alias("name"), "templates"), "name", "left")
    out = out.join(own(answers, F.count_distinct("run_id").alias("runs")), "name", "left")
    out = out.join(own(state, F.count_if(F.col("verdict") == "good").alias("good"), F.count_if(F.col("verdict") == "bad").alias("bad")), "name", "left")
    out = out.fillna(0, ["rows", "runs", "good", "bad"])
    return out.withColumn("compression", F.when(F.col("templates") > 0, F.bround(F.col("rows") / F.col("templates"), 3))).orderBy("name")


def runs_in_order(runs: DataFrame) -> DataFrame:
    """The latest import first, then by name."""
    return runs.orderBy(F.desc("imported_at"), "display_name")


def datasets_of_runs(answers: DataFrame) -> DataFrame:
    """How many runs each dataset has answers of."""
    return answers.groupBy("dataset").agg(F.count_distinct("run_id").alias("runs"))


def badcases(answers: DataFrame, runs: DataFrame, run_id: str, kind: str = "all", dataset: str | None = None, words: str = "") -> DataFrame:
    """A run's answers of one kind with its name, also by dataset and by words in the response, the raw one or the question."""
    out = evaluate.badcases(answers, run_id, kind, dataset)
    if words:
        found = [F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(words.lower())) for c in ("response", "raw_response", "question_text") if c in out.columns]
        any_ = found[0]
        for f in found[1:]:
            any_ = any_ | f
        out = out.filter(any_)
    return out.join(runs.select("run_id", "model_name", "prompt_mode"), "run_id")


def record_view(index: DataFrame, dataset: str, line_index: int, runs: DataFrame, answers: DataFrame, state: DataFrame) -> dict:
    """One record with its series' statistics, its template's summary, all runs' answers and its review.

    index: dataset, line_index, input, output, timeseries, template_id and, optionally, audit and annotation, all of one
    place. Every part reads only the rows of its key.
    """
    row = index.filter((F.col("dataset") == dataset) & (F.col("line_index") == line_index)).select("*", F.transform("timeseries", lambda s: series.statistics(s)).alias("series")).first()
    if row is None:
        if index.filter(F.col("dataset") == dataset).isEmpty():
            raise KeyError(dataset)
        raise IndexError(line_index)
    members = index.filter((F.col("dataset") == dataset) & (F.col("template_id") == row.template_id))
    told = members.withColumn("_class", text.answer_class(F.col("output")))
    summary = told.agg(F.count("*").alias("members"), F.count_distinct("_class").alias("answers"), F.min("line_index").alias("first_index"), F.max("line_index").alias("last_index")).first().asDict()
    top = evaluate.top_answers(told, ["template_id"], "_class").orderBy("rank").select(F.col("_class").alias("answer"), "count").collect()  # twelve rows
    seen = evaluate.answers_at(runs, answers, dataset, line_index).orderBy("run_id").collect()  # a row a run
    review = state.filter((F.col("dataset") == dataset) & (F.col("line_index") == line_index)).first()
    out = {k: v for k, v in row.asDict(recursive=True).items() if k != "series"}
    return {"record": out, "series": [s.asDict() for s in row.series or []], "template": summary | {"top_answers": [r.asDict() for r in top]}, "responses": [r.asDict() for r in seen], "review": review.asDict() if review else None}
