from __future__ import annotations

import json

import pytest
from quarry.sources import readers, sinks


def test_export_and_pair(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, None)], "i int, t string").orderBy("i")
    sinks.write_export(df, str(tmp_path / "a.jsonl"))
    assert [json.loads(x) for x in (tmp_path / "a.jsonl").read_text(encoding="utf-8").splitlines()] == [{"i": 1, "t": "é"}, {"i": 2}]
    sinks.write_export(df, str(tmp_path / "a.csv"), "csv")
    assert (tmp_path / "a.csv").read_bytes().startswith(b"\xef\xbb\xbfi,t\r\n")
    sinks.write_pair(df, ["t"], ["i"], str(tmp_path / "pair"))
    assert spark.read.json(str(tmp_path / "pair/audit")).count() == 2


def test_cells_are_checked(spark, tmp_path):
    def load(text):
        (tmp_path / "c.csv").write_text("source,quality,count\n" + text)
        return sinks.load_cells(spark, str(tmp_path / "c.csv"), "source", {"quality": ["good", "weak"]}).collect()

    assert sorted(tuple(r) for r in load("a,good,1\na,weak,2\n")) == [("a", "good", 1), ("a", "weak", 2)]
    for text, what in (("a,good,-1\n", "non-negative"), ("a,odd,1\n", "unknown level"), ("a,good,1\na,good,1\n", "duplicate")):
        with pytest.raises(Exception, match=what):
            load(text)


def test_discovery_and_formats(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/b.JSON").write_text('{"rows": [{"q": "1"}, {"q": "2"}]}')
    (tmp_path / "a.csv").write_text('q,r\n"x\ny",2\n')
    (tmp_path / "no.txt").write_text("x")
    found = readers.discover(spark, [str(tmp_path), str(tmp_path / "a.csv")])
    assert [f.rsplit("/", 1)[1] for f in found] == ["a.csv", "b.JSON"]
    assert readers.read(spark, str(tmp_path / "a.csv")).first().q == "x\ny"
    assert readers.read(spark, str(tmp_path / "d/b.JSON")).count() == 2
    with pytest.raises(FileNotFoundError):
        readers.discover(spark, [str(tmp_path / "no.txt")])
    (tmp_path / "reg.json").write_text(json.dumps({"sources": [{"name": "x", "path": "a.csv"}, {"name": "x", "path": "a.csv"}]}))
    with pytest.raises(ValueError, match="unique"):
        readers.registry(str(tmp_path / "reg.json"))
