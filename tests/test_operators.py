"""Operators against fixtures and plain Python."""

from __future__ import annotations

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F
from quarry.functions import rules, series, text
from quarry.operators import calls, cluster, convert, evaluate, merge, reports, resolve, review, selection
from quarry.plans import pipelines, queries
from quarry.sources import readers
from quarry.streaming import fold, latest

NUM = r"[-+]?(?:(?:\d+(?:\.\d*)?)|(?:\.\d+))(?:[eE][-+]?\d+)?"


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


def samples(seed, n):
    rng = random.Random(seed)
    bits = ["1", "-2.5", "3e4", ".5", "[", "]", ",", ";", " ", "\n", " ", "h12", "x-7", "<ts><ts/>", "<TS>", "http://a.b/1?c", "abc", "é", "7a", "<answer>B</answer>", "(C)", "1,2,3,4", " "]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_text_agrees_with_python(spark):
    values = samples(1, 400)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    x = F.col("x")
    got = df.select("i", text.compact(x).alias("c"), text.fold_series(x).alias("f"), text.mask_scalars(text.compact(x)).alias("m"), text.cluster_template(x).alias("t")).orderBy("i").collect()
    for v, r in zip(values, got, strict=True):
        compact = re.sub(r"\s+", " ", v).strip()
        assert r.c == compact
        assert r.m == re.sub(r"(?<![\w.])" + NUM + r"(?![\w.])", "<num>", compact)
        t = re.sub(r"https?://\S+", "<url>", v.lower().replace("<ts><ts/>", " <ts> "))
        assert r.t == re.sub(r"\s+", " ", re.sub(r"(?<![a-z])[-+]?\d+(?:\.\d+)?(?:e[-+]?\d+)?", "<num>", t)).strip()
        f = re.sub(r"<ts>\s*(?:<ts\s*/>)?|<ts\s*/>", "<ts>", v, flags=re.I)
        for _ in range(3):
            f = re.sub(r"\[(?:\s*" + NUM + r"\s*,){3,}\s*" + NUM + r"\s*\]", "<ts>", f)
            f = re.sub(r"(?<![\w.])" + NUM + r"(?:\s*[,;|]\s*" + NUM + r"){3,}(?![\w.])", "<ts>", f)
            f = re.sub(r"\[(?:\s*<ts>\s*,?)+\]", "<ts>", f, flags=re.I)
        assert r.f == re.sub(r"\s+", " ", f).strip()


def test_long_series_fold(spark):
    assert one(spark, text.fold_series, "a [" + ", ".join(map(str, range(20000))) + "] b") == "a <ts> b"


def test_view_template_and_ids(spark):
    assert one(spark, text.view_template, "Forecast the next 32 points from <ts><ts/> at 125 Hz.") == "forecast the next <num> points from <ts> at <num> hz."
    t = spark.range(1).select(text.template(F.lit('Say "é" 5?'), F.lit("7")).alias("t")).first().t
    key = json.dumps({"answer_structure": "scalar", "question_template": 'Say "é" <num>?'}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert (t.template_id, t.input_hash) == (hashlib.sha256(key.encode()).hexdigest()[:24], hashlib.sha256(key.encode()).hexdigest())
    assert one(spark, text.answer_class, "x <answer> Up </answer>") == "Up"
    assert one(spark, lambda x: text.issues(x, F.lit("the graph"), F.lit("unverified")), "the correct answer is B") == ["answer_leakage", "visual_grounding_mismatch", "unverified_reasoning"]


@pytest.mark.parametrize(("prompt", "label"), queries.PROMPTS)
def test_rules(spark, prompt, label):
    d = one(spark, lambda x: rules.decide(F.lit("any"), F.lit(None).cast("string"), x), prompt)
    assert (d.primary_label or "NONE") == label


def test_rule_details(spark):
    d = one(spark, lambda x: rules.decide(F.lit("time_mqa"), F.lit("Imputation"), x), "fill")
    assert (d.primary_label, d.closest_label, d.taxonomy_fit, d.status, d.method) == (None, "TSF", "out_of_scope", "review", "metadata+rules")
    d = one(spark, lambda x: rules.decide(F.lit("any"), F.lit(""), x), "1. Find the outlier.\n2. Forecast the next value.")
    assert (d.primary_label, d.secondary_labels, d.taxonomy_fit, d.status) == ("TSF", ["AD"], "mixed", "review")
    assert d.evidence == ["TSF: asks for future numerical values", "AD: detects/localizes abnormal observations"]
    assert one(spark, lambda x: rules.decide(F.lit("any"), F.lit(""), x), None).taxonomy_fit == "out_of_scope"


def test_conversion(spark):
    rows = [
        ("q [1,2,3,4,5,6,7,8] and [8,7,6,5,4,3,2,1]", "a", "[1,2,3,4]", None),
        ("q", "a", "[[1,2,3,4],[10,20,30,40]]", "{'unit': 'm'}"),
        ("Impute [1, 2, X, 4, 5, 6, 7, 8].", "a", "[0]", None),
        ("q", "a", "nonsense", None),
        ("q", "a", "[true, 1]", None),
        ("q", "", "[1]", None),
    ]
    df = spark.createDataFrame(rows, "Question string, answer string, input_ts string, meta_info string")
    s = [r.sample for r in convert.converted(df, "primary").collect()]
    assert [len(x.timeseries or []) for x in s] == [3, 2, 3, 0, 0, 1]
    assert s[2].timeseries[1:] == [[1.0, 2.0, 0.0, 4.0, 5.0, 6.0, 7.0, 8.0], [1.0, 1.0, 0.0, 1.0, 1.0, 1.0, 1.0, 1.0]]
    assert s[1].input == "Context information: unit: m\n\nInput time series: channel 1: <ts><ts/>; channel 2: <ts><ts/>.\n\nq"
    assert [x.reason for x in s] == [None, None, None, "unreadable array", "boolean value in time series", "empty output answer"]
    rows = [(str([[i, -i] for i in range(8)]) + " x", None, None, None), (None, "<QUE> see [1,2,3,4] <ANS> up </END>", None, None), (None, None, '"question": "it\'s [1,2,3,4]", "answer": "b"', None), (None, None, '"question": "say "hi" [1,2,3,4]", "answer": "c"', None), ("q [time series points]", None, None, "[1,2]")]
    df = spark.createDataFrame([(*r, "a" if i in (0, 4) else None) for i, r in enumerate(rows)], "question string, text string, QA_list string, series string, answer string")
    s = [r.sample for r in convert.converted(df, "embedded").collect()]
    assert [[len(c) for c in x.timeseries or []] for x in s] == [[8, 8], [4], [4], [4], [2]]
    assert [x.output for x in s] == ["a", "up", "b", "c", "a"]
    assert s[4].input == "q <ts><ts/>"


def test_file_filters(spark):
    paths = spark.createDataFrame([("x/Classification/a.csv",), ("d/test.parquet",), ("d/train.parquet",)], "p string")
    assert [tuple(r) for r in paths.select(convert.is_contaminated_file(F.col("p")), convert.is_training_file(F.col("p"))).collect()] == [(True, True), (False, False), (False, True)]
    assert one(spark, convert.is_contaminated_row, "Nature_sunspot")


def test_convert_files(spark, tmp_path):
    data = tmp_path / "train.jsonl"
    data.write_text("\n".join(json.dumps(x) for x in [{"dataset": "Nature_sunspot", "question": "q [1,2,3,4]", "answer": "a"}, {"dataset": "d", "question": "q [1,2,3,4]", "answer": "a"}, {"dataset": "d", "question": "q [1,2,3,4]", "answer": "a"}]))
    m = pipelines.convert_files(spark, [str(tmp_path)], "embedded", str(tmp_path / "out"))
    assert (m["rows_seen"], m["rows_filtered_contamination"], m["rows_written"]) == (3, 1, 1)
    assert sorted(spark.read.json(str(tmp_path / "out/samples")).columns) == ["input", "output", "timeseries"]


def test_downsample():
    values = [float((i * 37) % 101) for i in range(500)]
    out = series.downsample(values, 20)
    assert len(out) == 20
    assert (out[0], out[-1]) == (values[0], values[-1])
    assert series.downsample(values, 1000) == values
    assert set(out) <= set(values)


def test_lines_and_quarantine(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    good = {"input": "x", "timeseries": [[1.0]], "output": "y"}
    path.write_text(json.dumps(good) + "\n{broken json\n\n" + json.dumps(good) + " x\n" + json.dumps(good | {"more": 1}) + "\n" + json.dumps(good) + "\n")
    valid, bad = readers.validated(spark, str(path))
    assert sorted(r.source_index for r in valid.collect()) == [0, 5]
    assert sorted((r.source_index, r.reason) for r in bad.collect()) == [(1, "JSONDecodeError"), (3, "JSONDecodeError"), (4, "unexpected keys")]
    assert valid.filter("source_index = 0").first().source_sha256 == hashlib.sha256(json.dumps(good).encode()).hexdigest()


def test_prepare_and_buckets(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join(json.dumps({"input": f"Locate the anomalous segment {i}.", "timeseries": [[1.0]], "output": "y"}) for i in range(5)))
    pipelines.prepare(spark, [readers.Source("any", str(path))], str(tmp_path / "out"))
    clusters = spark.read.parquet(str(tmp_path / "out/clusters")).collect()
    assert [(c.member_count, c.provisional.primary_label) for c in clusters] == [(5, "AD")]
    rows = spark.read.parquet(str(tmp_path / "out/provisional")).withColumn("final", F.struct(F.lit("accepted").alias("status"), F.col("provisional.primary_label").alias("primary_label"), F.lit(0.9).alias("confidence"), F.lit("exact").alias("taxonomy_fit")))
    report = pipelines.materialize_buckets(rows, str(tmp_path / "buckets"), 2, seed=17).first()
    assert (report.candidates, report.selected, report.capped, report.largest) == (5, 2, 1, 5)
    chosen = {r.sample_id for r in spark.read.json(str(tmp_path / "buckets")).collect()}
    assert chosen == set(sorted((r.sample_id for r in rows.collect()), key=lambda i: hashlib.sha256(f"17\0{i}".encode()).hexdigest())[:2])


def test_votes(spark):
    reply = '```json\n{"primary_label": "AD", "secondary_labels": ["TR", "AD"], "taxonomy_fit": "exact", "confidence": 0.9, "rationale": "r"}\n```'
    v = one(spark, resolve.parsed_vote, reply)
    assert (v.primary_label, v.secondary_labels, v.confidence) == ("AD", ["TR"], 0.9)
    assert one(spark, resolve.parsed_vote, '{"primary_label": "ZZ", "taxonomy_fit": "exact", "confidence": 0.9}') is None
    assert one(spark, resolve.parsed_quality, '{"quality":"good","difficulty":"easy","reason":" a  b "}').reason == "a b"
    sheet = spark.createDataFrame([("a", "AD", "TR; AD", "exact"), ("b", "AD", "", ""), ("c", "AD", None, "out_of_scope")], "cluster_id string, human_primary_label string, human_secondary_labels string, human_taxonomy_fit string")
    assert sorted((r.cluster_id, r.primary_label, r.secondary_labels) for r in resolve.human_labels(sheet).collect()) == [("a", "AD", ["TR"]), ("c", "AD", [])]
    votes = spark.createDataFrame([("x", 1, None, [], "out_of_scope", 0.5), ("x", 2, "PR", ["AD"], "exact", 0.6), ("x", 3, None, ["TR"], "closest", 0.7), ("x", 4, "PR", ["AD"], "exact", 0.6)], "cluster_id string, seen int, primary_label string, secondary_labels array<string>, taxonomy_fit string, confidence double")
    t = resolve.tally(votes).first()
    assert (t.votes, t.winner.primary_label, t.winner.agree, t.winner.secondary_labels, t.winner.taxonomy_fit, t.winner.confidence) == (4, None, 2, ["TR"], "out_of_scope", 0.6)
    c = resolve.coverage(spark.createDataFrame([("x",), ("y",)], "cluster_id string"), votes).first()
    assert (c.missing, c.unexpected, c.duplicates) == (1, 0, 1)


def test_merge_rules(spark):
    with pytest.raises(Exception, match="unmatched row"):
        merge.zipped(spark.range(3).withColumnRenamed("id", "k"), spark.range(2).withColumnRenamed("id", "k"), ["k"], "audit").count()
    q = spark.createDataFrame([("s", 1, "good"), ("s", 1, "weak")], "source string, line_number int, quality string")
    with pytest.raises(Exception, match="conflicting"):
        merge.with_quality(q.select("source", "line_number"), q, ["source", "line_number"]).collect()
    label = "struct<primary_label:string,proposed_primary_label:string,status:string,confidence:double,taxonomy_fit:string,proposed_confidence:double,proposed_taxonomy_fit:string>"
    df = spark.createDataFrame([(("AD", None, "accepted", 0.9, "exact", None, None), None), ((None, "TR", "human_review", None, None, 0.5, "closest"), None), ((None, None, "excluded", None, "out_of_scope", None, None), ("PR", None, "review", 0.4, "mixed", None, None)), ((None, None, None, None, "out_of_scope", None, None), None), (None, None)], f"f {label}, p {label}")
    got = [(r.a.ability_bucket, r.a.ability_label_source, r.a.ability_status) for r in df.select(merge.ability(F.col("f"), F.col("p")).alias("a")).collect()]
    assert got == [("AD", "final", "accepted"), ("TR", "final_proposed", "human_review"), ("PR", "provisional", "excluded"), ("UNMAPPED", "unmapped", "out_of_scope"), ("UNMAPPED", "unmapped", "unmapped")]


def test_answers(spark):
    gold = spark.createDataFrame([("d", i, "<answer>A</answer>") for i in range(4)], "dataset string, idx long, output string")
    rows = [("r", "d", "0", "A", None, None, None, "f", 0), ("r", "d", "0", "B", None, None, None, "g", 0), ("r", "d", "1", "answer: b", None, None, None, "f", 1), ("r", "d", "2", "", None, None, None, "f", 2), ("r", "d", "9", "A", None, None, None, "f", 3), ("r", "d", "true", "A", None, None, None, "f", 4)]
    df = spark.createDataFrame(rows, "run_id string, dataset string, idx string, response string, raw_response string, answer string, error string, file string, item int")
    good, bad = evaluate.scored(df, gold)
    assert sorted((r.idx, r.type) for r in bad.collect()) == [("9", "index_out_of_range"), ("true", "invalid_index")]
    done = evaluate.deduplicated(good)
    got = {r.line_index: (r.generation_status, r.parse_status, r.correctness) for r in done.collect()}
    assert got == {0: ("error", "parsed", "unknown"), 1: ("ok", "parsed", "incorrect"), 2: ("empty", "unparsed", "unknown")}
    index = gold.select(F.col("idx").alias("line_index"))
    assert evaluate.next_badcase(index, done, 1).first().line_index == 2
    assert evaluate.next_badcase(index, done, 2).first().line_index == 3
    runs = spark.createDataFrame([("r",), ("z",)], "run_id string")
    assert [r.status for r in evaluate.answers_at(runs, done, "d", 3).collect()] == ["missing"]
    assert evaluate.replaced(done, done).count() == done.count()
    with pytest.raises(ValueError, match="invalid status"):
        evaluate.badcases(done, "r", "odd")


def test_review_history(spark, tmp_path):
    path = str(tmp_path / "events")
    schema = "dataset string, line_index long, revision long, verdict string"
    spark.createDataFrame([("d", 1, 1, "good"), ("d", 1, 2, None), ("d", 2, 1, "bad")], schema).write.parquet(path)
    events = spark.read.schema(schema).parquet(path)
    assert [(r.line_index, r.verdict) for r in review.current(events, ["dataset", "line_index"], deleted=F.col("verdict").isNull()).collect()] == [(2, "bad")]
    change = spark.createDataFrame([("d", 1, "good")], "dataset string, line_index long, verdict string")
    review.append(events, path, change, ["dataset", "line_index"], F.lit(2))
    events = spark.read.schema(schema).parquet(path)
    assert events.agg(F.max("revision")).first()[0] == 3
    with pytest.raises(review.Conflict):
        review.append(events, path, change, ["dataset", "line_index"], F.lit(2))
    q = fold(spark.readStream.schema(schema).parquet(path), ["dataset", "line_index"], str(tmp_path / "state"), str(tmp_path / "check"))
    q.awaitTermination()
    assert sorted((r.line_index, r.revision, r.verdict) for r in latest(spark, str(tmp_path / "state")).collect()) == [(1, 3, "good"), (2, 1, "bad")]


def test_calls(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2"), ("c", "3")], "template_id string, payload string")
    cache = spark.createDataFrame([("c",)], "template_id string")
    out = calls.resumed(df, cache, calls.offline, "template_id", "payload")
    assert sorted(r.template_id for r in out.collect()) == ["a", "b"]

    def broken(payloads):
        raise OSError("down")

    failed = calls.answered(df.filter("template_id = 'b'"), broken, "template_id", "payload", retries=0)
    assert [(r.reply, r.error) for r in failed.collect()] == [(None, "down")]
    calls.write_logs(out.union(failed), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert (spark.read.parquet(str(tmp_path / "good")).count(), spark.read.parquet(str(tmp_path / "bad")).count()) == (2, 1)


def test_payload():
    plain = {"model": "m", "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}], "max_tokens": 9}
    assert calls.payload("m", "s", "u", 9) == {**plain, "temperature": 0}
    assert calls.payload("m", "s", "u", 9, effort="high", json_mode=True) == {**plain, "response_format": {"type": "json_object"}, "thinking": {"type": "enabled"}, "reasoning_effort": "high"}
    assert calls.payload("m", "s", "u", 9, "disabled") == {**plain, "temperature": 0, "thinking": {"type": "disabled"}}
    with pytest.raises(ValueError, match="effort"):
        calls.payload("m", "s", "u", 9, "disabled", "high")


def test_latest_cache_line(spark):
    cache = spark.createDataFrame([("t", "m", "v", 1, "x"), ("t", "m", "v", 2, "y"), ("t", "n", "v", 3, "z")], "template_id string, model string, prompt_version string, line int, quality string")
    assert [r.quality for r in cluster.latest_cached(cache, "template_id", "m", "v", "line").collect()] == ["y"]
    assert selection.capped(cache, ["template_id"], "line", 0).count() == 3


def test_replies_with_other_text_are_no_votes(spark):
    good = '{"primary_label": "AD", "taxonomy_fit": "exact", "confidence": "0.9"}'
    for reply, confidence in ((good, 0.9), (f"Sure: ```json\n{good}\n```", 0.9), (good + " and {x}", None), (good + good, None), (good.replace('"0.9"', '"much"'), None), (good.replace('"0.9"', "1.5"), None)):
        vote = spark.range(1).select(resolve.parsed_vote(F.lit(reply)).alias("v")).first().v
        assert (vote and vote.confidence) == confidence, reply


def test_json_lines_are_strict(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n{"a": 2, "b": "x"}\n')
    assert sorted(r.a for r in readers.read(spark, str(tmp_path / "a.jsonl")).collect()) == [1, 2]
    for k, line in enumerate(("[1]", "{broken", '{"a": 1} x', "3")):
        (tmp_path / f"b{k}.jsonl").write_text('{"a": 1}\n' + line + "\n")
        with pytest.raises(Exception):  # noqa: B017, PT011  Spark's or the reader's own
            readers.read(spark, str(tmp_path / f"b{k}.jsonl")).collect()


def test_several_authoritative_votes_fail(spark):
    empty = spark.createDataFrame([], "cluster_id string, primary_label string, secondary_labels array<string>, taxonomy_fit string")
    rows = spark.createDataFrame([("c", "what")], "cluster_id string, input string").select("cluster_id", rules.decide(F.lit(""), F.lit(""), F.col("input")).alias("provisional"))
    vote = spark.createDataFrame([("c", 1, "AD", [], "exact", 0.9)], "cluster_id string, seen int, primary_label string, secondary_labels array<string>, taxonomy_fit string, confidence double")
    once = resolve.resolve(rows, empty, vote.drop("seen"), resolve.tally(vote))
    assert once.first().final.method == "authoritative_model"
    with pytest.raises(Exception, match="one a cluster"):
        resolve.resolve(rows, empty, vote.union(vote).drop("seen"), resolve.tally(vote)).collect()
    told = resolve.read_votes(spark.createDataFrame([("c", '{"primary_label": "AD", "taxonomy_fit": "exact"}', 1)], "cluster_id string, vote string, seen int"))
    assert told.first().primary_label == "AD"
    with pytest.raises(Exception, match="invalid vote"):
        resolve.read_votes(spark.createDataFrame([("c", "{}", 1)], "cluster_id string, vote string, seen int")).collect()
    with pytest.raises(Exception, match="invalid human"):
        resolve.human_records(spark.createDataFrame([("c", "no such")], "cluster_id string, primary_label string")).collect()


def test_distribution_counts_listed_labels_only(spark):
    df = spark.createDataFrame([("g", "A", True), ("g", "other", True), ("g", "A", False), ("h", "other", True)], "g string, l string, ok boolean")
    got = {(r.dataset_group, r.label): (r["count"], r.percent) for r in reports.distribution(df, F.col("g"), F.col("l"), F.col("ok"), ["A", "B"]).collect()}
    assert got == {("g", "A"): (1, 100.0), ("g", "B"): (0, 0.0), ("h", "A"): (0, 0.0), ("h", "B"): (0, 0.0)}


def test_context_order_of_the_adapters(spark):
    df = spark.createDataFrame([("q [1,2,3,4]", "a", "meta", "ctx", "[1,2,3,4]")], "question string, answer string, meta_info string, context string, input_ts string")
    assert convert.converted(df, "embedded").first().sample.input.startswith("Context information: ctx")
    assert convert.converted(df, "primary").first().sample.input.startswith("Context information: meta")


def test_numbering_in_blocks(spark):
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("source"), (F.col("id") * 7).alias("source_index"))
    got = sorted((r.source, r.source_index, r.k) for r in merge.numbered(rows, "k", 50).collect())
    seen = {}
    for source, _, k in got:
        seen[source] = seen.get(source, 0) + 1
        assert k == seen[source]


def test_choice_reads_once(spark):
    """Each pattern stands once in the plan, and letters are those of a plain reading of all patterns in order."""
    said = ["", " ", "A", " b \nmore", "(C)", "Final answer: D.", "final answer： e)", "x\n f) y", "<ANSWER> g </answer>", "<answer>H</answer> A.", "answer=c", "'Answer' : 'd", '{"answer": "b"}', '{"answer": ""}', "{'answer': 'the e'}", "{'answer': 'x'} A.",
            '{"answer": "zz", "more": "A."}', "```json\n{'answer': 'E'}\n```", "```\nA\n```", "```python A```", "no idea", "{", "{}\nA)", "a:b", "an\u017fwer: a", "<an\u017fwer>b</an\u017fwer>", "\u2003B\x1c", '{"answer": null}', '{"answer": ["g"]}', "1. A\n2. B\nA) x", None]
    rows = spark.createDataFrame([(x,) for x in said], "said string")
    x = F.regexp_replace(text.strip(F.col("said")), text.FENCE, "")
    none = lambda c: F.nullif(c, F.lit(""))
    inner = F.coalesce(none(F.get_json_object(x, "$.answer")), F.regexp_extract(x, r"(?U)['\"]answer['\"]\s*:\s*['\"]([^'\"]*)['\"]", 1))
    plain = F.when(x != "", F.coalesce(F.when(x.rlike(r"(?Us)^\{.*\}$"), F.upper(none(F.regexp_extract(inner, r"(?i)[A-G]", 0)))), *(F.upper(none(F.regexp_extract(x, p, 1))) for p, _ in text.CHOICE_PATTERNS)))
    out = rows.select("said", text.choice(F.col("said")).alias("letter"), plain.alias("plain"))
    assert [r for r in out.collect() if r.letter != r.plain] == []
    assert len({r.letter for r in out.collect()}) == 8
    plan = rows.select(text.choice(F.col("said")).alias("letter"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("</answer>") == 1 and plan.count("json|python") == 1
