"""Lookups read one file of an index; what is attached stands at the same place."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from quarry.sources import offsets, places


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("places")
    for name in ("a", "b"):
        (home / f"{name}.jsonl").write_text("".join(json.dumps({"id": f"{name}{i}"}) + "\n" * (1 + i % 2) for i in range(500)))
        (home / f"{name}.audit.jsonl").write_text("".join(json.dumps({"of": f"{name}{i}", "task": i % 3}) + "\n" for i in range(500)))
    index = offsets.line_index(spark, [str(home / "a.jsonl"), str(home / "b.jsonl")])
    audit = offsets.line_index(spark, [str(home / "a.audit.jsonl"), str(home / "b.audit.jsonl")]).withColumn("of", F.regexp_replace("file", "audit[.]", ""))
    whole = places.attached(index, {"audit": audit})
    places.write(whole, str(home / "index"), rows=128)
    return home, index, audit


def test_a_lookup_reads_one_file(spark, written):
    home, index, _ = written
    file = index.filter(F.col("file").endswith("b.jsonl")).first().file
    found = places.lookup(spark, str(home / "index"), file, 321)
    assert len(found.inputFiles()) == 1 and len(list((home / "index" / "places").glob("*.parquet"))) >= 8
    plan = found._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(file), IsNotNull(line_index), EqualTo(file" in plan
    assert found.count() == 1
    for k in (0, 127, 128, 321, 499):
        assert places.record_at(spark, str(home / "index"), file, k) == {"record": {"id": f"b{k}"}, "audit": {"of": f"b{k}", "task": k % 3}}
    with pytest.raises(IndexError):
        places.record_at(spark, str(home / "index"), file, 500)
    with pytest.raises(IndexError):
        places.record_at(spark, str(home / "index"), "file:/none", 0)


def test_all_places_are_found(spark, written):
    home, index, _ = written
    held = spark.read.parquet(str(home / "index" / "places"))
    assert held.select("file", "line_index", "byte_offset").exceptAll(index.select("file", "line_index", "byte_offset")).isEmpty() and held.count() == 1000


def test_what_stands_alone_fails_or_is_null(spark, written):
    home, index, audit = written
    short = audit.filter("line_index <> 7")
    with pytest.raises(Exception, match="unmatched row"):
        places.attached(index, {"audit": short}).count()
    assert places.attached(index, {"audit": short}, strict=False).filter("audit IS NULL").count() == 2


def test_an_empty_index(spark, written, tmp_path):
    home, index, _ = written
    places.write(index.limit(0), str(tmp_path / "i"))
    with pytest.raises(IndexError):
        places.record_at(spark, str(tmp_path / "i"), "x", 0)
