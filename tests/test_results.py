"""Result files, their import, and byte places of records."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from quarry.operators import evaluate
from quarry.sources import files, offsets, results


@pytest.fixture
def gold(spark):
    rows = [("bench_perception", i, x) for i, x in enumerate(["A", "<answer>B</answer>", "C", "D"])] + [("bench_causal_reasoning", 0, "A")]
    return spark.createDataFrame(rows, "dataset string, idx long, output string")


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")


def test_layouts(spark, tmp_path):
    put(tmp_path / "a.json", [{"idx": 0, "x": {"k": [1, "é"]}}, 3, {"idx": 1}])
    put(tmp_path / "b.json", {"results": [{"idx": 5}]})
    put(tmp_path / "c.json", {"responses": [{"idx": 6}], "results": []})
    put(tmp_path / "d.json", {"idx": 7})
    put(tmp_path / "e.jsonl", '{"idx": 8}\n\n {"idx": 9}\n')
    put(tmp_path / "f.jsonl", '{"idx": 8}\n[1]\n')
    put(tmp_path / "g.jsonl", '{"idx": 8}\n{broken\n')
    put(tmp_path / "h.json", "  \n")
    out = results.result_rows(spark, [str(tmp_path)]).collect()
    got = sorted((r.file.rsplit("/", 1)[1], r.item, r.raw) for r in out if r.error is None)
    assert got == [("a.json", 0, '{"idx":0,"x":{"k":[1,"é"]}}'), ("a.json", 2, '{"idx":1}'), ("b.json", 0, '{"idx":5}'), ("c.json", 0, '{"idx":6}'), ("d.json", 0, '{"idx":7}'), ("e.jsonl", 0, '{"idx":8}'), ("e.jsonl", 2, '{"idx":9}')]
    assert sorted(r.file.rsplit("/", 1)[1] for r in out if r.error) == ["f.jsonl", "g.jsonl"]
    lines = results.result_lines(spark, [str(tmp_path / "e.jsonl"), str(tmp_path / "g.jsonl")]).collect()
    assert sorted((r.item, r.raw is None) for r in lines) == [(0, False), (0, False), (1, True), (2, False)]


def test_import(spark, tmp_path, gold):
    root = tmp_path / "r"
    put(root / "m1/perception/generated_answer.json", [{"idx": 0, "response": "A"}, {"index": "1", "completion": "Final answer: C."}, {"idx": 2, "response": ""}, {"idx": 9, "response": "A"}, {"idx": True, "response": "A"}, {"idx": -1}, {"idx": 3.0}])
    put(root / "m1/perception/generated_answer_2.jsonl", '{"idx": 0, "response": "A"}\n{"idx": 1, "response": "other"}\n{"idx": 3, "response": "no letter", "num_tokens": 7}\n{"sample_idx": 3, "prompt_mode": "cot", "raw_response": "INPUT_SKIPPED: long"}\n')
    put(root / "m1/causal_reasoning/generated_answer.jsonl", '{"idx": 0, "answer": "A", "response": "x"}\n')
    put(root / "m1/inductive_reasoning/generated_answer.jsonl", '{"idx": 0, "response": "A"}\n')
    put(root / "m2_x/perception/generated_answer.jsonl", "{broken\n")
    put(root / "no/task/generated_answer.json", [])
    put(root / "m1/perception/notes.json", [])
    got = results.import_results(spark, str(root), gold, str(tmp_path / "w"))
    assert [x.rsplit("/", 3)[1] for x in got.ignored] == ["no"]
    runs = {(r.model_name, r.prompt_mode): r for r in got.runs.collect()}
    assert set(runs) == {("m1", "unknown"), ("m1", "cot")}
    r = runs["m1", "unknown"]
    assert (r.expected_rows, r.matched_rows, r.missing_rows, r.correct_rows, r.incorrect_rows, r.unparsed_rows, r.error_rows, r.status, r.files) == (5, 5, 0, 2, 0, 1, 2, "partial", 4)
    answers = {(a.dataset, a.line_index): a for a in got.answers.filter(f"run_id = '{r.run_id}'").collect()}
    assert answers["bench_perception", 0].correctness == "correct"
    assert (answers["bench_perception", 1].generation_status, answers["bench_perception", 1].error) == ("error", "conflicting duplicate answers")
    assert answers["bench_perception", 3].num_tokens == 7
    kinds = sorted(d.type for d in got.diagnostics.filter("model_name = 'm1'").collect())
    assert kinds == ["dataset_missing", "duplicate_index", "duplicate_index_conflict", "index_out_of_range", "invalid_index", "invalid_index", "invalid_index"]
    assert [d.type for d in got.diagnostics.filter("model_name <> 'm1'").collect()] == ["dataset_missing"] or [d.type for d in got.diagnostics.filter("root_path LIKE '%m2_x%'").collect()] == ["file_error"]
    again = results.import_results(spark, str(root), gold, str(tmp_path / "w2"))
    assert sorted(x.run_id for x in again.runs.collect()) == sorted(x.run_id for x in runs.values())
    assert evaluate.replaced(got.answers, again.answers).count() == got.answers.count()
    found = results.result_files(spark, str(root))
    assert len(results.source_signature(found)) == 64
    with pytest.raises(FileNotFoundError):
        results.import_results(spark, str(tmp_path / "r/no/task"), gold.limit(0), str(tmp_path / "w3")) if not (tmp_path / "r/no/task/generated_answer.json").unlink() else None


def test_many_rows_of_one_file(spark, tmp_path, monkeypatch):
    """Rows of a file are no array that each of them is copied with: 60 000 rows took over 6 GB."""
    text = "".join(f'{{"idx": {i}, "response": "A"}}\n' for i in range(60_000))
    put(tmp_path / "a.json", text)
    put(tmp_path / "b.json", text + "{broken\n")
    out = results.result_rows(spark, [str(tmp_path)])
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = out.groupBy(F.substring_index("file", "/", -1).alias("f"), F.col("error").isNull().alias("ok")).agg(F.count("*").alias("n"), F.min("item").alias("a"), F.max("item").alias("b")).collect()
    assert sorted((r.f, r.ok, r.n, r.a, r.b) for r in got) == [("a.json", True, 60_000, 0, 59_999), ("b.json", False, 1, None, None)]
    monkeypatch.setattr(results, "HEAD", 64)
    told = {"c.json": ('{"idx": 0}\n{"idx": 1}\n', "lines"), "d.json": ('{"results": [{"idx": 0}]}\n \n', "whole"), "e.json": ('{\n"idx": 0}\n', "whole"), "f.json": (' [{"idx": 0}]', "array"), "g.jsonl": ('{broken\n', "lines"), "h.json": ('{"idx": "' + "x" * 99 + '"}', "whole")}
    for name, (content, kind) in told.items():
        put(tmp_path / name, content)
        assert results.layout(spark, str(tmp_path / name)) == kind, name


def test_large_lines_by_any_name(spark, tmp_path, gold, monkeypatch):
    """Files above the limit give what they give below it."""
    rows = '{"idx": 0, "response": "A"}\n{"idx": 1, "response": "C"}\n{"idx": 7, "response": "C"}\n'
    put(tmp_path / "r/m1/perception/generated_answer.json", rows)
    small = results.import_results(spark, str(tmp_path / "r"), gold, str(tmp_path / "w")).runs.drop("files").collect()
    monkeypatch.setattr(results, "WHOLE", 10)
    monkeypatch.setattr(results, "result_rows", None)
    assert results.import_results(spark, str(tmp_path / "r"), gold, str(tmp_path / "w2")).runs.drop("files").collect() == small


def test_line_places(spark, tmp_path):
    rows = [{"k": i, "t": "é" * (i % 7)} for i in range(300)]
    raw = b"\n".join([json.dumps(x, ensure_ascii=False).encode() + (b"\r" if x["k"] % 5 == 0 else b"") for x in rows[:150]] + [b"", b"  "] + [json.dumps(x).encode() for x in rows[150:]]) + b"\n"
    for name, data in (("a.jsonl", raw), ("b.jsonl", b"\xef\xbb\xbf" + raw), ("c.jsonl", raw[:-1]), ("d.jsonl", b"\xef\xbb\xbf" + raw[:-1])):
        (tmp_path / name).write_bytes(data)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        try:
            index = offsets.line_index(spark, str(tmp_path / name))
            got = index.orderBy("line_index").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [json.loads(data[r.byte_offset : r.byte_offset + r.byte_length]) for r in got] == rows, name
        assert [r.line_index for r in got] == list(range(300))
        assert offsets.record_at(index, got[0].file, 7) == rows[7]
    with pytest.raises(IndexError):
        offsets.record_at(index, got[0].file, 300)


def test_array_places(spark, tmp_path):
    rows = [{"a": "x,]}\\\" [", "b": [1, {"c": 2}]}, 3, "s,\"", None, {}, [1, 2]]
    for indent in (None, 2):
        data = json.dumps(rows, indent=indent).encode()
        assert [json.loads(data[a : a + n]) for a, n in offsets.array_places(data)] == rows
    assert offsets.array_places(b" [ ] ") == []
    with pytest.raises(ValueError):
        offsets.array_places(b'{"a": [1]}')
    (tmp_path / "a.json").write_bytes(data)
    index = offsets.array_index(spark, str(tmp_path / "a.json"))
    file = index.first().file
    assert offsets.record_at(index, file, 0) == rows[0]
    assert offsets.record_at(index, file, 1) is None


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "x/y.txt")
    files.write_text(spark, path, ["é", "a"])
    files.write_text(spark, path, "bé")
    assert files.read_text(spark, path) == "bé"
    assert files.read_bytes(spark, path, 1, 2) == "é".encode()
    assert files.listed(spark, str(tmp_path / "x")) == [".y.txt.crc", "y.txt"] or files.listed(spark, str(tmp_path / "x")) == ["y.txt"]
    assert files.signature(spark, path).startswith(path + ":3:")
    with pytest.raises(ZeroDivisionError):
        files.write_text(spark, path, (1 / 0 for _ in range(1)))
    assert files.read_text(spark, path) == "bé"
    files.delete(spark, path)
    assert not files.exists(spark, path) and files.is_dir(spark, str(tmp_path))
