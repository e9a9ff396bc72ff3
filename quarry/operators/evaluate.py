"""Imported model answers: parsing, scoring, duplicates, scoreboards and bad cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

STATUSES = ("all", "correct", "incorrect", "unparsed", "error", "empty", "unknown")


def scored(rows: DataFrame, gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Answers joined with gold, and what couldn't be.

    rows: run_id, dataset, idx (text), response, raw_response, answer, error, file, item; gold: dataset, idx (long),
    output. The second frame has rows whose index is no non-negative whole number or has no gold row.
    """
    rows = rows.withColumn("line_index", text.nonnegative(F.col("idx")))
    known = gold.select("dataset", F.col("idx").alias("line_index"), text.choice(F.col("output")).alias("gold_answer"), F.lit(True).alias("_known"))
    both = rows.join(known, ["dataset", "line_index"], "left")
    kind = F.when(F.col("line_index").isNull(), "invalid_index").otherwise("index_out_of_range")
    wrong = both.filter(F.col("_known").isNull()).select(kind.alias("type"), "run_id", "dataset", "idx", "file", "item")
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    said = F.coalesce(blank("raw_response"), blank("response"), F.lit(""))
    parsed = F.coalesce(text.choice(F.col("answer")), text.choice(said))
    state = F.when(blank("error").isNotNull() | said.startswith("INPUT_SKIPPED:"), "error").when(text.strip(said) == "", "empty").otherwise("ok")
    good = both.filter("_known").drop("_known", "idx").withColumns({"parsed_answer": parsed, "generation_status": state})
    good = good.withColumn("parse_status", F.when(F.col("parsed_answer").isNotNull(), "parsed").otherwise("unparsed"))
    both_known = (F.col("generation_status") == "ok") & F.col("parsed_answer").isNotNull() & F.col("gold_answer").isNotNull()
    return good.withColumn("correctness", F.when(both_known, F.when(F.col("parsed_answer") == F.col("gold_answer"), "correct").otherwise("incorrect")).otherwise("unknown")), wrong


def deduplicated(answers: DataFrame) -> DataFrame:
    """The first answer of each (run, dataset, index) by file and item; answers that differ make it an error."""
    keys = ["run_id", "dataset", "line_index"]
    told = F.struct("response", "raw_response", "answer", "error")
    names = [c for c in answers.columns if c not in keys]
    out = answers.groupBy(*keys).agg(F.min_by(F.struct(*names), F.struct("file", "item")).alias("f"), F.count_distinct(F.xxhash64(F.to_json(told))).alias("n"), F.count("*").alias("copies")).select(*keys, "f.*", "n", "copies")
    clash = F.col("n") > 1
    return out.withColumns({"generation_status": F.when(clash, "error").otherwise(F.col("generation_status")), "correctness": F.when(clash, "unknown").otherwise(F.col("correctness")), "error": F.when(clash, "conflicting duplicate answers").otherwise(F.col("error"))}).drop("n")


def status(generation: Column, parse: Column, correctness: Column) -> Column:
    """What is shown: a failed generation, then an answer that can't be read, then whether it is right."""
    return F.when(generation != "ok", generation).when(parse != "parsed", "unparsed").otherwise(correctness)


def scoreboard(runs: DataFrame, answers: DataFrame) -> DataFrame:
    """Correct, incorrect, unparsed and failed answers of every run, those without answers included."""
    ok = F.col("generation_status") == "ok"
    parsed = F.col("parse_status") == "parsed"
    sums = answers.groupBy("run_id").agg(
        F.count_if(ok & parsed & (F.col("correctness") == "correct")).alias("correct_rows"), F.count_if(ok & parsed & (F.col("correctness") == "incorrect")).alias("incorrect_rows"),
        F.count_if(ok & (F.col("parse_status") == "unparsed")).alias("unparsed_rows"), F.count_if(F.col("generation_status").isin("error", "empty")).alias("error_rows"), F.count("*").alias("matched_rows"),
    )
    return runs.join(sums, "run_id", "left").fillna(0, ["correct_rows", "incorrect_rows", "unparsed_rows", "error_rows", "matched_rows"])


def import_summary(board: DataFrame, expected: Column, invalid: Column) -> DataFrame:
    out = board.withColumns({"expected_rows": expected, "invalid_rows": invalid, "missing_rows": F.greatest(F.lit(0), expected - F.col("matched_rows"))})
    return out.withColumn("status", F.when((F.col("matched_rows") == expected) & (invalid == 0), "complete").otherwise("partial"))


def answers_at(runs: DataFrame, answers: DataFrame, dataset: str, index: int) -> DataFrame:
    """For each run seen on a dataset its answer at an index; runs without one show as missing."""
    seen = runs.join(answers.filter(F.col("dataset") == dataset).select("run_id").distinct(), "run_id", "left_semi")
    own = answers.filter((F.col("dataset") == dataset) & (F.col("line_index") == index)).select("run_id", "response", "parsed_answer", "gold_answer", "generation_status", "parse_status", "correctness")
    out = seen.join(own, "run_id", "left")
    shown = status(F.col("generation_status"), F.col("parse_status"), F.col("correctness"))
    return out.withColumns({"status": F.coalesce(shown, F.lit("missing")), "response": F.coalesce("response", F.lit("")), "generation_status": F.coalesce("generation_status", F.lit("missing")), "parse_status": F.coalesce("parse_status", F.lit("missing")), "correctness": F.coalesce("correctness", F.lit("unknown"))})


def badcases(answers: DataFrame, run_id: str, kind: str = "all", dataset: str | None = None) -> DataFrame:
    """A run's answers of one kind. unknown tells of correctness only: failed and unread answers are among them."""
    if kind not in STATUSES:
        raise ValueError(f"invalid status: {kind}")
    out = answers.filter(F.col("run_id") == run_id)
    if dataset:
        out = out.filter(F.col("dataset") == dataset)
    if kind in ("correct", "incorrect", "unknown"):
        return out.filter(F.col("correctness") == kind)
    if kind == "unparsed":
        return out.filter((F.col("parse_status") == "unparsed") & (F.col("generation_status") == "ok"))
    return out if kind == "all" else out.filter(F.col("generation_status") == kind)


def next_badcase(index: DataFrame, answers: DataFrame, after: int) -> DataFrame:
    """The first index after one that has no answer, a wrong, an unread or a failed one."""
    out = index.filter(F.col("line_index") > after).join(answers.select("line_index", "generation_status", "parse_status", "correctness"), "line_index", "left")
    bad = F.col("generation_status").isNull() | (F.col("generation_status") != "ok") | (F.col("correctness") == "incorrect") | (F.col("parse_status") == "unparsed")
    return out.filter(bad).agg(F.min("line_index").alias("line_index"))


def replaced(stored: DataFrame, fresh: DataFrame, key: str = "run_id") -> DataFrame:
    """Idempotent import: a run's new answers take the place of all of its old ones."""
    return stored.join(fresh.select(key).distinct(), key, "left_anti").unionByName(fresh)


def without_stale(runs: DataFrame, seen: DataFrame, root: str, had_errors: bool) -> DataFrame:
    """Runs under a root that a scan without errors didn't see go."""
    return runs if had_errors else runs.filter(~F.col("root_path").startswith(root)).unionByName(runs.filter(F.col("root_path").startswith(root)).join(seen.select("run_id").distinct(), "run_id", "left_semi"))


def page(df: DataFrame, order: list[Column], offset: int, limit: int, most: int = 200) -> DataFrame:
    """One page in a total order; the limit is clamped."""
    return df.orderBy(*order).offset(max(0, offset)).limit(max(1, min(limit, most)))


def template_summary(df: DataFrame, by: list[str], answer: str, index: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("members"), F.count_distinct(answer).alias("answers"), F.min(index).alias("first_index"), F.max(index).alias("last_index"))


def top_answers(df: DataFrame, by: list[str], answer: str, most: int = 12) -> DataFrame:
    """The most frequent answers of each group, ties by value."""
    counts = df.groupBy(*by, answer).agg(F.count("*").alias("count"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("count"), answer))).filter(F.col("rank") <= most)
