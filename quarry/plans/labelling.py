"""Labelling by a model behind a client that is passed in: one call a template, resumed from what was written before."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import calls, cluster, prompts, resolve
from ..sources import files
from ..sources.readers import strict_json


@dataclass(frozen=True)
class Labels:
    """Where a dataset's labels, its template cache and its errors are."""

    rows: str

    @property
    def templates(self) -> str:
        return self.rows.removesuffix("/") + ".templates"

    @property
    def errors(self) -> str:
        return self.rows.removesuffix("/") + ".errors"


def rows_of(raw: DataFrame) -> DataFrame:
    """What ``planned`` takes from raw lines (line_number, raw): question and answer by the names that records use, and why a
    line can't be labelled."""
    read = raw.withColumns({"_bad": strict_json(F.col("raw")), "_m": F.from_json("raw", "map<string,string>")})
    names = ("input", "question", "query", "context", "context_text", "output", "response", "answer", "sample_id", "id")
    wide = read.select("line_number", "_bad", *(F.col("_m")[n].alias(n) for n in names))
    question, answer = text.question_answer(list(names))
    reason = F.coalesce(F.col("_bad"), F.when(text.strip(F.coalesce(question, F.lit(""))) == "", "missing question"), F.when(text.strip(F.coalesce(answer, F.lit(""))) == "", "missing answer"))
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    return wide.select("line_number", F.coalesce(filled("sample_id"), filled("id")).alias("record_id"), question.alias("question"), answer.alias("answer"), reason.alias("reason"))


CACHE = "template_id string, quality string, difficulty string, reason string, member_count long, model string, prompt_version string, written long"
ROW = "record_id string, line_number long, input_hash string, template_id string, quality string, difficulty string, reason string, model string, prompt_version string"


def stored(df: DataFrame, path: str, shape: str) -> DataFrame:
    """What was written to a folder, or nothing."""
    spark = df.sparkSession
    return spark.read.schema(shape).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], shape)


def planned(rows: DataFrame, to: Labels, model: str, limit: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members left to label, templates left to ask for, and one row of counts.

    rows: line_number, record_id (or null), question, answer and reason (why a line is invalid, or null). A limit takes the
    first lines by number, as an input of that length would. Lines whose label of the same text is there are skipped.
    """
    taken = rows.orderBy("line_number").limit(limit) if limit else rows
    t = taken.filter("reason IS NULL").withColumn("t", text.template(F.col("question"), F.col("answer")))
    record = F.coalesce(F.nullif("record_id", F.lit("")), F.concat(F.lit("line:"), F.col("line_number").cast("string")))
    members = t.select(record.alias("record_id"), "line_number", "t.*")
    same = (F.col("model") == model) & (F.col("prompt_version") == prompts.PROMPT_VERSION)
    done = stored(rows, to.rows, ROW).filter(same)
    left = members.join(done.select("record_id", "line_number", "input_hash").distinct(), ["record_id", "line_number", "input_hash"], "left_anti")
    cache = stored(rows, to.templates, CACHE).filter(same)
    shown = ["question_template", "answer_structure", "representative_answer_template"]
    groups = cluster.census(left, F.col("template_id"), [F.col("line_number")], shown)
    asked = cluster.missing(groups, cache, ["template_id"])
    counts = cluster.compression(groups, cache).select(F.col("rows").alias("pending_rows"), F.col("templates").alias("unique_templates"), F.col("cached").alias("cached_templates"), F.col("pending").alias("api_requests_needed"), F.col("ratio").alias("template_compression_ratio"))
    seen = taken.agg(F.count("*").alias("input_rows"), F.count("reason").alias("invalid_rows"))
    stats = seen.crossJoin(counts).withColumn("resume_skipped_rows", F.col("input_rows") - F.col("invalid_rows") - F.col("pending_rows"))  # one row each
    return left, asked, stats


def label(rows: DataFrame, client: calls.Client, to: Labels, model: str, limit: int = 0, dry_run: bool = False, **options) -> dict:
    """Asks for each template without a label once, appends what was said to the cache and the errors, and labels all
    members of every template that has a label. options: those of ``calls.answered``, or, with a width or a journal, those of ``calls.asked`` (the client is then one of
    single payloads). Returns counts."""
    spark = rows.sparkSession
    left, asked, stats = planned(rows, to, model, limit)
    result = stats.first().asDict()
    if dry_run:
        return result
    invalid = (rows.orderBy("line_number").limit(limit) if limit else rows).filter("reason IS NOT NULL")
    invalid.select(F.lit(None).cast("string").alias("template_id"), "line_number", F.lit(None).cast("long").alias("member_count"), F.col("reason").alias("error")).write.mode("append").parquet(to.errors)
    asked = asked.withColumn("payload", prompts.quality_payload(model))
    ask = calls.asked if {"width", "journal"} & set(options) else calls.answered
    replies = ask(asked, client, "template_id", "payload", **options)
    run = f"{to.templates}.replies-{len(files.listed(spark, to.templates))}-{result['input_rows']}"
    files.delete(spark, run)
    replies.join(asked.select("template_id", "member_count"), "template_id").withColumn("v", resolve.parsed_quality(F.col("reply"))).write.parquet(run)  # a call is made once
    said = spark.read.parquet(run)
    tags = {"model": F.lit(model), "prompt_version": F.lit(prompts.PROMPT_VERSION), "written": F.lit(time.time_ns())}
    good = said.filter("v IS NOT NULL").select("template_id", "v.quality", "v.difficulty", "v.reason", "member_count").withColumns(tags)
    good.write.mode("append").parquet(to.templates)
    bad = said.filter("v IS NULL").select("template_id", F.lit(None).cast("long").alias("line_number"), "member_count", F.coalesce("error", F.lit("invalid reply")).alias("error"))
    bad.write.mode("append").parquet(to.errors)
    names = ["quality", "difficulty", "reason", "model", "prompt_version"]
    cache = stored(rows, to.templates, CACHE).withColumn("written", F.coalesce("written", F.lit(0)))
    known = cluster.latest_cached(cache, "template_id", model, prompts.PROMPT_VERSION, "written").select("template_id", *names)
    labelled = cluster.expanded(left.select("record_id", "line_number", "input_hash", "template_id"), known)
    labelled.write.mode("append").parquet(to.rows)
    made = said.agg(F.count("*").alias("a"), F.count_if(F.col("v").isNull()).alias("f")).first()
    files.delete(spark, run)
    after = planned(rows, to, model, limit)[2].first().asDict()
    result |= {"api_requests": made.a, "failed_templates": made.f, "labels_written": result["pending_rows"] - after["pending_rows"]}
    return result | {"output": to.rows, "template_cache": to.templates, "errors": to.errors}


class BadRequest(ValueError):
    """A service refuses a request as such (HTTP 400)."""


def lenient(client: calls.Client, most: int = 1024) -> calls.Client:
    """A client that sends a refused request once more, without a response format and with fewer tokens: some services
    know no response format, or have less room than was asked for."""

    def once(payload: str):
        try:
            reply = client([payload])[0]
        except BadRequest as e:
            reply = e
        if not isinstance(reply, BadRequest):
            return reply
        plain = {k: v for k, v in json.loads(payload).items() if k != "response_format"}
        plain["max_tokens"] = min(plain.get("max_tokens", most), most)
        try:
            again = client([json.dumps(plain, ensure_ascii=False)])[0]
        except Exception as e:  # noqa: BLE001  told with the first refusal
            again = e
        return RuntimeError(f"{again} (first: {reply})") if isinstance(again, Exception) else again

    return lambda payloads: [once(p) for p in payloads]


TRANSLATION = "key string, model string, source string, translated string"


def translated(df: DataFrame, texts: Column, client: calls.Client, model: str, cache: str, **options) -> DataFrame:
    """df with ``translations`` (a map of the same keys) and ``cached``, by one call for each different map of texts that the
    cache lacks. Blank texts are left out; a row without any text has no translations, and so has one whose call failed."""
    spark = df.sparkSession
    keyed = df.withColumns({"_key": prompts.translation_key(model, texts), "_source": prompts.translation_source(texts), "_payload": prompts.translation_payload(model, texts)})
    had = stored(df, cache, TRANSLATION).select("key").distinct()
    wanted = keyed.filter("_source <> '{}'").groupBy(F.col("_key").alias("key")).agg(F.any_value("_source").alias("source"), F.any_value("_payload").alias("payload"))
    replies = calls.answered(cluster.missing(wanted, had, ["key"]), lenient(client), "key", "payload", **options)
    kind = "map<string,string>"
    said = text.read_map(F.col("reply"))
    new = replies.filter("error IS NULL").withColumn("m", said).filter("m IS NOT NULL").join(wanted.select("key", "source"), "key")
    own = F.map_from_entries(F.transform(F.map_keys(F.from_json("source", kind)), lambda k: F.struct(k, F.coalesce(F.col("m")[k], F.lit("")))))
    earlier = f"{cache}.before"
    files.delete(spark, earlier)
    had.write.parquet(earlier)
    new.select("key", F.lit(model).alias("model"), "source", F.to_json(own).alias("translated")).write.mode("append").parquet(cache)
    known = stored(df, cache, TRANSLATION).groupBy("key").agg(F.any_value("translated").alias("translated"))
    old = spark.read.parquet(earlier).select("key", F.lit(True).alias("cached"))
    told = known.join(old, "key", "left").select(F.col("key").alias("_key"), F.from_json("translated", kind).alias("translations"), F.coalesce("cached", F.lit(False)).alias("cached"))
    return keyed.join(told, "_key", "left").drop("_key", "_source", "_payload")
