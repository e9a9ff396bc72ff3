"""The data source of records: lines and arrays over chunk borders, against sequential readers."""

from __future__ import annotations

import hashlib
import json
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from quarry.sources import offsets, records

VALUES = st.recursive(st.none() | st.integers() | st.text(alphabet=st.sampled_from('a"\\[]{},\n é{'), max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet='a"\\,[', max_size=3), x, max_size=3), max_leaves=8)


def by_chunks(data: bytes, chunk: int) -> list[tuple[int, bytes]]:
    ranges = [(a, min(len(data), a + chunk)) for a in range(0, len(data), chunk)]
    entries = records.composed([records.scanned(data[a:b]) for a, b in ranges])
    return [x for (a, b), e in zip(ranges, entries, strict=True) for x in records.elements_in(lambda p, q: data[p:q], a, b, len(data), e)]


@settings(max_examples=300, deadline=None)
@given(st.lists(VALUES, max_size=6), st.integers(1, 40), st.sampled_from(["", " ", "\n  "]), st.sampled_from([None, 1]), st.sampled_from(["", " ", " [1, 2]"]))
def test_elements_of_chunks_are_those_of_the_whole(values, chunk, space, indent, after):
    data = (space + json.dumps(values, indent=indent, ensure_ascii=False) + after).encode()
    found = by_chunks(data, chunk)
    assert [json.loads(x) for _, x in found] == values
    assert [(o, len(x)) for o, x in found] == offsets.array_places(data)
    assert all(data[o : o + len(x)] == x for o, x in found)


@pytest.mark.parametrize("text", ["[1, 2", '["a', "[", "[]", "[ ]x", "", "[1,,2,]", '[{"a": "\\\\\\""}, "\\\\"]', "[[1,2],[3]]"])
def test_odd_arrays_as_the_sequential_scanner(text):
    data = text.encode()
    for chunk in range(1, len(data) + 2):
        assert [(o, len(x)) for o, x in by_chunks(data, chunk)] == offsets.array_places(data)


def test_an_object_is_no_array():
    with pytest.raises(ValueError, match="not an array"):
        by_chunks(b'{"a": [1]}', 100)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \t\ré"), max_size=8), max_size=8), st.integers(1, 20), st.booleans(), st.booleans())
def test_lines_of_chunks_are_those_of_the_whole(texts, chunk, mark, last):
    data = (records.BOM if mark else b"") + "\n".join(texts).encode() + (b"\n" if last else b"")
    found = [x for a in range(0, len(data), chunk) if chunk > 3 or not mark for x in records.lines_in(lambda p, q: data[p:q], a, min(len(data), a + chunk), len(data))]
    if chunk > 3 or not mark:
        body = data[3:] if mark else data
        want, at = [], 3 if mark else 0
        for line in body.split(b"\n"):
            if line.strip(b" \t\r"):
                want.append((at, line))
            at += len(line) + 1
        assert found == want


def test_source_gives_places_digests_and_numbers(spark, tmp_path):
    rng = random.Random(4)
    rows = [json.dumps({"id": i, "text": "x" * rng.randrange(0, 300) + "é\n"}, ensure_ascii=False) for i in range(400)]
    (tmp_path / "d").mkdir()
    data = ("\n".join(rows[:100]) + "\n\n" + "\r\n".join(rows[100:])).encode()
    (tmp_path / "d" / "a.jsonl").write_bytes(data)
    (tmp_path / "d" / "b.jsonl").write_text("")
    (tmp_path / "d" / "_SUCCESS").write_text("no")
    path = str(tmp_path / "d")
    out = records.records(spark, path, chunk=7000, columns=("sha256", "raw"))
    got = sorted(out.collect(), key=lambda r: r.line_index)
    assert [r.line_index for r in got] == list(range(400))
    for r in got:
        assert bytes(r.raw) == data[r.byte_offset : r.byte_offset + r.byte_length]
        assert r.sha256 == hashlib.sha256(bytes(r.raw)).hexdigest()
    plain = offsets.line_index(spark, path).collect()
    key = lambda r: (r.file, r.line_index, r.byte_offset, r.byte_length)
    assert sorted(map(key, plain)) == sorted(map(key, got))
    back = records.raw_at(out.drop("raw", "sha256")).collect()
    assert {r.line_index: bytes(r.raw) for r in back} == {r.line_index: bytes(r.raw) for r in got}


def test_only_asked_columns_are_read(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("{}\n{}\n")
    spark.dataSource.register(records.RecordSource)
    df = spark.read.format("quarry_records").schema("byte_offset long").load(str(tmp_path / "a.jsonl"))
    assert [tuple(r) for r in df.orderBy("byte_offset").collect()] == [(0,), (3,)]
    with pytest.raises(Exception, match="entries"):
        (tmp_path / "a.json").write_text(json.dumps(list(range(100))))
        spark.read.format("quarry_records").options(layout="array", chunk="10").load(str(tmp_path / "a.json")).count()


def test_an_array_of_many_chunks(spark, tmp_path):
    rng = random.Random(1)
    values = [{"i": i, "t": ['"', "\\", "],[" * rng.randrange(0, 50), {"x": None}]} for i in range(500)]
    place = tmp_path / "a.json"
    place.write_text(json.dumps(values, indent=2))
    out = records.records(spark, str(place), "array", chunk=5777, columns=("raw",))
    assert out.select("line_index").distinct().count() == 500
    assert [json.loads(bytes(r.raw)) for r in sorted(out.collect(), key=lambda r: r.line_index)] == values
    assert sorted((r.line_index, r.byte_offset, r.byte_length) for r in offsets.array_index(spark, str(place)).collect()) == sorted((r.line_index, r.byte_offset, r.byte_length) for r in out.collect())


def test_stores_that_arrow_does_not_know():
    assert not records.reaches("viewfs://store/x")
    assert records.reaches("/tmp/x") and records.reaches("file:///tmp/x") and records.reaches("file:/tmp/x")


def test_read_by_place_in_bounded_batches(spark, tmp_path, monkeypatch):
    """A batch of places doesn't become a batch of all their records."""
    lines_ = [f"{i}:" + "x" * (i % 50) for i in range(400)]
    (tmp_path / "a.txt").write_text("\n".join(lines_) + "\n")
    monkeypatch.setattr(records, "BATCH", 500)
    held = records.records(spark, str(tmp_path / "a.txt")).unionByName(spark.createDataFrame([(None, 0, 0, 1)], "file string, line_index long, byte_offset long, byte_length long"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(x.as_py() or b"") for x in b.column("raw"))])], names=["n"])

    assert sum(r.line_index * (bytes(r.raw or b"").decode() == lines_[r.line_index]) for r in records.raw_at(held).collect()) == sum(range(400))
    got = [r.n for r in records.raw_at(held).mapInArrow(sizes, "n long").collect()]
    assert sum(got) == sum(map(len, lines_))
    # What one worker hands on in bounded batches may come to the next one joined: each read is looked at by itself.
    made = []
    real = pa.array
    monkeypatch.setattr(records.pa, "array", lambda x, *a, **k: made.append(len(x)) or real(x, *a, **k))
    frame = held.select("file", "byte_offset", "byte_length")

    class Seen:
        def mapInArrow(self, run, schema):  # noqa: N802
            rows = [r for r in frame.orderBy("byte_offset").collect()]
            batch = pa.RecordBatch.from_pylist([r.asDict() for r in rows], frame.toArrow().schema)
            return list(run([batch]))

    class Places:
        columns, schema = frame.columns, frame.schema

        def repartitionByRange(self, *_):  # noqa: N802
            return self

        def sortWithinPartitions(self, *_):  # noqa: N802
            return Seen()

    out = records.raw_at(Places())
    assert len(out) > 10 and sum(b.num_rows for b in out) == 401
    assert max(sum(len(x.as_py() or b"") for x in b.column("raw")) for b in out) < 500 + 60
