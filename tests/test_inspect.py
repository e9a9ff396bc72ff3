"""Catalogue, record view, settings, drivers with files, and what they check."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from quarry.operators import review, selection
from quarry.plans import inspect, pipelines
from quarry.sources import readers, sinks


def test_settings(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s.json")
    assert inspect.load_settings(spark, path) == {}
    inspect.save_setting(spark, path, "root", "/a")
    inspect.save_setting(spark, path, "other", 1)
    saved = inspect.load_settings(spark, path)
    assert saved == {"root": "/a", "other": 1}
    assert inspect.setting("root", "QUARRY_TEST_ROOT", saved, {"root": "/c"}) == ("/a", "settings")
    assert inspect.setting("root", "QUARRY_TEST_ROOT", {"root": " "}, {"root": "/c"}) == ("/c", "config")
    monkeypatch.setenv("QUARRY_TEST_ROOT", "/e")
    assert inspect.setting("root", "QUARRY_TEST_ROOT", saved, {}) == ("/e", "environment")
    assert [inspect.status_of(e) for e in (review.Conflict(), inspect.Forbidden(), KeyError(), IndexError(), ValueError(), OSError(), FileNotFoundError())] == [409, 403, 404, 416, 400, 500, 404]


def test_catalogue_and_record(spark):
    index = spark.createDataFrame([("a", i, f"q{i % 2}", "<answer>B</answer>" if i else "C", [[1.0, 2.0]], f"t{i % 2}") for i in range(4)], "dataset string, line_index long, input string, output string, timeseries array<array<double>>, template_id string")
    runs = spark.createDataFrame([("r1", "m1", "cot", 5, "x"), ("r2", "m2", "cot", 7, "y"), ("r3", "m3", "cot", 7, "a")], "run_id string, model_name string, prompt_mode string, imported_at long, display_name string")
    answers = spark.createDataFrame([("r1", "a", 0, "It is C", "It is C", "C", "C", "ok", "parsed", "correct"), ("r1", "a", 2, "Or A", "Or A", "A", "B", "ok", "parsed", "incorrect"), ("r2", "a", 1, "", "", None, "B", "empty", "unparsed", "unknown")], "run_id string, dataset string, line_index long, response string, raw_response string, parsed_answer string, gold_answer string, generation_status string, parse_status string, correctness string")
    state = spark.createDataFrame([("a", 0, 3, "good")], "dataset string, line_index long, revision int, verdict string")
    datasets = spark.createDataFrame([("a", "chatts", "train", None), ("b", "chatts", "train", "evaluation_only"), ("c", "other", "train", None), ("d", "chatts", "test", None)], "name string, schema string, split string, training_role string")
    assert [r.name for r in inspect.is_training(datasets).collect()] == ["a"]
    got = {r.name: r for r in inspect.catalogue(datasets, index, spark.createDataFrame([("a", 2)], "dataset string, templates int"), answers, state).collect()}
    assert (got["a"].rows, got["a"].templates, got["a"].runs, got["a"].good, got["a"].bad, got["a"].compression) == (4, 2, 2, 1, 0, 2.0)
    assert (got["b"].rows, got["b"].templates, got["b"].runs) == (0, None, 0)
    assert [r.run_id for r in inspect.runs_in_order(runs).collect()] == ["r3", "r2", "r1"]
    assert inspect.datasets_of_runs(answers).first().runs == 2
    view = inspect.record_view(index, "a", 0, runs, answers, state)
    assert view["template"] == {"members": 2, "answers": 2, "first_index": 0, "last_index": 2, "top_answers": [{"answer": "B", "count": 1}, {"answer": "C", "count": 1}]}
    assert view["review"]["verdict"] == "good" and view["series"][0]["mean"] == 1.5
    assert [(r["run_id"], r["status"]) for r in view["responses"]] == [("r1", "correct"), ("r2", "missing")]
    with pytest.raises(IndexError):
        inspect.record_view(index, "a", 9, runs, answers, state)
    with pytest.raises(KeyError):
        inspect.record_view(index, "z", 0, runs, answers, state)
    assert [(r.line_index, r.model_name) for r in inspect.badcases(answers, runs, "r1", "incorrect", words="OR a").collect()] == [(2, "m1")]
    assert inspect.badcases(answers, runs, "r1", words="zzz").count() == 0
    more = inspect.with_fields(index, [T.StructField("audit", T.StringType()), T.StructField("input", T.StringType())])
    assert more.columns == [*index.columns, "audit"]


def test_audit_goes_with_every_line(spark, tmp_path):
    def put(name, rows):
        (tmp_path / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in rows) + "\n")

    put("d.jsonl", [{"input": "Locate the anomaly.", "timeseries": [[1]], "output": "x"}, "", "{broken", {"input": "Say something.", "timeseries": [[1]], "output": "x"}])
    put("a.jsonl", [{"sample_index": i, "task": "t"} for i in (0, 2, 3)])
    put("reg.json", [json.dumps({"sources": [{"name": "s", "path": "d.jsonl", "audit": "a.jsonl"}]})])
    sources = readers.registry(str(tmp_path / "reg.json"), spark)
    pipelines.prepare(spark, sources, str(tmp_path / "o"))
    assert [r.task for r in spark.read.parquet(str(tmp_path / "o/provisional")).collect()] == ["t", "t"]
    told = json.loads((tmp_path / "o/manifest.json").read_text())["counters"]
    assert {"kind": "invalid", "value": "s", "rows": 1} in told
    pipelines.prepare(spark, sources, str(tmp_path / "o1"), limit=1)
    assert spark.read.parquet(str(tmp_path / "o1/provisional")).count() == 1
    for k, places in enumerate(((0, 2), (0, 2, 3, 4), (0, 1, 3))):
        put("a.jsonl", [{"sample_index": i, "task": "t"} for i in places])
        with pytest.raises(Exception, match="audit of s"):
            pipelines.prepare(spark, sources, str(tmp_path / f"p{k}"))


def final_rows(spark):
    rows = [("s", i, "train", f"c{i % 2}", f"i{i}", ("AD" if i % 3 else "PR", "exact", 0.9, "accepted")) for i in range(40)]
    return spark.createDataFrame(rows, "source string, source_index long, split string, cluster_id string, sample_id string, final struct<primary_label:string,taxonomy_fit:string,confidence:double,status:string>")


def test_buckets_keep_order_and_identity(spark, tmp_path):
    rows = final_rows(spark)
    samples = rows.select("source", "source_index", F.col("source_index").alias("input"))
    report = pipelines.materialize_buckets(rows, str(tmp_path / "b"), samples=samples)
    assert report.first().selected == 40
    for label in ("AD", "PR"):
        parts = sorted((tmp_path / f"b/primary_label={label}").glob("part-*"))
        got = [json.loads(x)["input"] for p in parts for x in p.read_text().splitlines()]
        assert got == sorted(got) and len(got) == sum(("AD" if i % 3 else "PR") == label for i in range(40))
    with pytest.raises(Exception, match="unmatched row"):
        pipelines.materialize_buckets(rows, str(tmp_path / "b2"), samples=samples.filter("source_index > 0")).collect()
    assert pipelines.materialize_buckets(rows, str(tmp_path / "b3"), most=3).first().selected == 6
    ranked = selection.ranked(rows.withColumn("label", F.col("final.primary_label")), ["cluster_id"], "sample_id")
    by = {r.label: r for r in selection.cap_report_by(ranked, ["cluster_id"], 3, "label").collect()}
    assert sum(r.selected for r in by.values()) == 6 and by["AD"].candidates == 26


def test_reports_and_versions(spark, tmp_path):
    rows = final_rows(spark)
    told = pipelines.distribution_report(rows, {"s": "first"}, ["AD", "PR"], str(tmp_path / "r"), ("train",))
    assert {(d["label"], d["count"]) for d in told["distribution"]} == {("AD", 26), ("PR", 14)}
    assert told["statuses"] == [{"dataset_group": "first", "status": "accepted", "count": 40, "percent": 100.0}] and told["sources"] == {"first": ["s"]}
    assert "# Statuses" in (tmp_path / "r/distribution.md").read_text()
    (tmp_path / "in").write_text("1")
    made = []

    def make():
        made.append(1)
        return spark.range(len(made))

    for _ in range(2):
        assert pipelines.versioned(spark, str(tmp_path / "v"), [str(tmp_path / "in")], make).count() == 1
    for k in (2, 3, 4):
        (tmp_path / "in").write_text("1" * k)
        assert pipelines.versioned(spark, str(tmp_path / "v"), [str(tmp_path / "in")], make).count() == k
    assert sorted(p.name for p in (tmp_path / "v").iterdir() if p.name.startswith("v")) == ["v3", "v4"]


def test_tombstones(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.createDataFrame([("a", 1, 1, "good")], "dataset string, line_index long, revision int, verdict string").write.parquet(path)
    key = spark.createDataFrame([("a", 1)], "dataset string, line_index long")
    names = ["dataset", "line_index"]
    read = lambda: spark.read.parquet(path)
    with pytest.raises(review.Conflict):
        review.delete(read(), path, key, names, F.lit(5))
    review.delete(read(), path, key, names, F.lit(1))
    assert review.current(read(), names, deleted=F.col("verdict").isNull()).count() == 0
    with pytest.raises(KeyError):
        review.delete(read(), path, key, names, F.lit(2))


def test_benchmark_places(spark, tmp_path):
    for name in ("b/perception/perception.jsonl", "b/other/causal_reasoning.jsonl"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("{}\n")
    tasks = {"perception": ("perception/perception.jsonl", "P"), "causal_reasoning": ("reasoning/causal_reasoning.jsonl", "R"), "none": ("x/none.jsonl", "R")}
    got = readers.benchmark_files(spark, [str(tmp_path / "no"), str(tmp_path / "b")], tasks)
    assert {k: (v[0].rsplit("/", 2)[1], v[1]) for k, v in got.items()} == {"perception": ("perception", "P"), "causal_reasoning": ("other", "R")}
    assert readers.benchmark_files(spark, [str(tmp_path / "no")], tasks) == {}


def test_distributions(spark, tmp_path):
    (tmp_path / "c.csv").write_text("source,quality,difficulty,count\na,good,easy,2\na,weak,easy,1\n")
    got = {(r.dimension, r.value): r["count"] for r in sinks.load_distributions(spark, str(tmp_path / "c.csv")).collect()}
    assert got == {("quality", "good"): 2, ("quality", "weak"): 1, ("difficulty", "easy"): 3}
