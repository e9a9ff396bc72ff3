"""The command line from raw files to buckets, and configurations."""

from __future__ import annotations

import json

import pytest
from quarry.__main__ import run
from quarry.sources import config, results


def say(capsys, spark, *argv):
    capsys.readouterr()
    code = run(spark, [str(a) for a in argv])
    text = capsys.readouterr().out
    return code, json.loads(text) if text.strip() else None


def test_from_files_to_buckets(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    rows = [{"question": f"{q} Look at [1, 2, 3, {i}].", "answer": f"a{i}", "task": "t"} for i, q in enumerate(["Locate the anomalous segment.", "Say something."] * 3)]
    (raw / "train.jsonl").write_text("\n".join(map(json.dumps, rows)))
    (raw / "more.csv").write_text('question,answer\n"Describe the trend of [4, 5, 6, 7].",up\n')
    (raw / "list.json").write_text(json.dumps({"train": [{"prompt": "Which noise level has [1, 1, 1, 2]?", "label": "low"}]}))
    code, told = say(capsys, spark, "convert", raw, "--adapter", "embedded", "--out", tmp_path / "c")
    assert (code, told["rows_seen"], told["rows_written"]) == (0, 8, 8)
    lines = sorted(x for f in (tmp_path / "c" / "samples").glob("*.json") for x in f.read_text().splitlines())
    (tmp_path / "s.jsonl").write_text("\n".join(lines))
    (tmp_path / "sources.json").write_text(json.dumps({"sources": [{"name": "s", "path": "s.jsonl"}]}))
    assert say(capsys, spark, "prepare", tmp_path / "sources.json", "--out", tmp_path / "p") == (0, None)
    assert say(capsys, spark, "sheet", tmp_path / "p" / "clusters", "--out", tmp_path / "sheet")[0] == 0
    (sheet,) = [f.read_text() for f in (tmp_path / "sheet").glob("*.csv") if f.stat().st_size]
    head, *body = sheet.splitlines()
    assert "human_rationale" in head and body
    cluster = body[0].split(",")[0].strip('"')
    (tmp_path / "human.csv").write_text(f"cluster_id,human_primary_label,human_secondary_labels,human_taxonomy_fit\n{cluster},TR,,exact\n")
    code, told = say(capsys, spark, "resolve", tmp_path / "p", "--out", tmp_path / "f", "--human", tmp_path / "human.csv")
    assert told["counts"]["TR"] >= 1 and told["counts"]["AD"] == 3
    code, told = say(capsys, spark, "buckets", tmp_path / "f" / "final", "--out", tmp_path / "b", "--cap", 1)
    assert told[0]["selected"] <= told[0]["candidates"]


def test_places_by_command(spark, tmp_path, capsys):
    (tmp_path / "a.json").write_text(json.dumps([{"k": i} for i in range(9)]))
    say(capsys, spark, "lines", tmp_path / "a.json", "--out", tmp_path / "i", "--layout", "array")
    assert say(capsys, spark, "record", tmp_path / "i", f"file:{tmp_path}/a.json", 4) == (0, {"record": {"k": 4}})


@pytest.fixture
def written(tmp_path):
    (tmp_path / "cfg").mkdir()
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "a.jsonl").write_text("{}")
    (tmp_path / "data" / "sources.json").write_text(json.dumps({"sources": [{"name": "a", "path": "a.jsonl", "audit": "a.audit"}]}))
    label = {"datasets": [{"name": "a", "input": "../data/a.jsonl", "output": "labels/a.jsonl", "note": 1}], "service": {"model": "m", "concurrency": 8}}
    (tmp_path / "cfg" / "label.json").write_text(json.dumps(label))
    merge = {"data_root": "../data", "data_registry": "../data/sources.json", "quality_config": "label.json", "taxonomy": {"manifests": ["m.json"], "labels": [{"provisional": "p", "final": "f"}]}, "output": {"root": "out", "resume": False}}
    (tmp_path / "cfg" / "merge.json").write_text(json.dumps(merge))
    return tmp_path, label, merge


def test_configurations(spark, written, capsys):
    home, label, merge = written
    got = config.merge(spark, str(home / "cfg" / "merge.json"))
    assert got.sources["a"].path == f"{home}/data/a.jsonl" and got.sources["a"].audit == f"{home}/data/a.audit"
    assert got.labelling.datasets["a"].output == f"{home}/cfg/labels/a.jsonl" and got.labelling.datasets["a"].rest == {"note": 1}
    assert (got.root, got.output["resume"], got.output["strict_quality"]) == (f"{home}/cfg/out", False, True)
    code, told = say(capsys, spark, "check", home / "cfg" / "merge.json")
    assert code == 1 and sorted(told) == ["a", "taxonomy"] and len(told["a"]) == 2 and len(told["taxonomy"]) == 3
    assert say(capsys, spark, "labels", home / "cfg" / "label.json")[1]["settings"]["model"] == "m"


@pytest.mark.parametrize(("change", "message"), [({"taxonomy": {}}, "taxonomy requires"), ({"output": {}}, "output.root"), ({"data_root": None}, "missing `data_root`")])
def test_wrong_merges(spark, written, change, message):
    home, _, merge = written
    value = {k: v for k, v in (merge | change).items() if v is not None}
    (home / "cfg" / "merge.json").write_text(json.dumps(value))
    with pytest.raises(ValueError, match=message):
        config.merge(spark, str(home / "cfg" / "merge.json"))


def test_wrong_labellings(spark, written):
    home, label, _ = written
    for value, message in (({"datasets": label["datasets"] * 2, "service": label["service"]}, "duplicate"), ({"datasets": label["datasets"]}, "needs datasets"), (label | {"service": {}}, "needs datasets|model"), (label | {"service": {"x": 1}}, "model is required")):
        (home / "cfg" / "label.json").write_text(json.dumps(value))
        with pytest.raises(ValueError, match=message):
            config.labelling(spark, str(home / "cfg" / "label.json"))
    (home / "cfg" / "x.yaml").write_text("datasets: []\nservice: {model: m}\n")
    assert config.labelling(spark, str(home / "cfg" / "x.yaml")).settings == {"model": "m"}


def test_large_arrays_of_results(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"idx": 0, "t": "],["}, 3, {"idx": 1}]))
    (tmp_path / "b.json").write_text('[{"idx": 2}, {broken}, {"idx": 4}]')
    got = sorted((r.file[-6:], r.item, r.raw, r.error) for r in results.result_elements(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")]).collect())
    assert got == [("a.json", 0, '{"idx": 0, "t": "],["}', None), ("a.json", 2, '{"idx": 1}', None), ("b.json", 0, '{"idx": 2}', None), ("b.json", 1, None, "JSONDecodeError"), ("b.json", 2, '{"idx": 4}', None)]
    assert results.is_array(spark, str(tmp_path / "a.json"))
