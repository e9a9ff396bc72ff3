"""Merges that redo only what has changed, stored labels that are not dealt anew, ranks within hot groups."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from quarry.operators import merge
from quarry.operators.review import Conflict
from quarry.plans import merging
from quarry.sources import commits

from tests.test_merging import inputs


def three(spark):
    parts = [[df.withColumn("source", F.lit(f"set {k}/x")) for df in inputs(spark)] for k in "abc"]
    return [a.unionByName(b).unionByName(c) for a, b, c in zip(*parts, strict=True)]


def tables(place):
    return {name: sorted(x for f in (place / name).glob("*.csv") for x in f.read_text().splitlines()) for name in ("ability_quality_difficulty", "source_ability_quality_difficulty", "coverage_by_source", "ability_summary")}


def test_only_changed_sources_are_rewritten(spark, tmp_path):
    samples, taxonomy, quality = three(spark)
    names = ["set a/x", "set b/x", "set c/x"]
    out = str(tmp_path / "o")
    run = lambda sig, s=samples: merging.merge_changed(s, taxonomy, quality, sig, out, ["input", "output"])
    first = run({n: "1" for n in names})
    assert (first["rewritten"], first["kept"], first["removed"], first["commit"]) == (names, [], [], 0)
    held = {f: f.stat().st_mtime_ns for f in (tmp_path / "o" / "annotated").rglob("*.json")}
    again = run({n: "1" for n in names})
    assert (again["rewritten"], again["kept"], again["commit"], again["summary"]) == ([], names, 0, first["summary"])
    changed = samples.withColumn("output", F.when((F.col("source") == "set b/x") & (F.col("source_index") == 4), "B").otherwise(F.col("output"))).filter("NOT (source = 'set b/x' AND source_index = 4)")
    fewer = quality.filter("NOT (source = 'set b/x' AND line_number = 5)")
    one = merging.merge_changed(changed, taxonomy, fewer, {n: "2" if n == "set b/x" else "1" for n in names}, out, ["input", "output"])
    assert (one["rewritten"], one["kept"], one["commit"]) == (["set b/x"], ["set a/x", "set c/x"], 1)
    now = {f: f.stat().st_mtime_ns for f in (tmp_path / "o" / "annotated").rglob("*.json")}
    assert len({f.parent for f in held if now.get(f) != held[f]}) == 1  # the other sources' files are as they were
    whole = merging.annotated(changed, taxonomy, fewer)
    assert merging.write_reports(whole, str(tmp_path / "full")) == one["summary"]
    assert tables(tmp_path / "full") == tables(tmp_path / "o" / "reports" / "000001")
    told = lambda df: sorted(json.dumps(r.asDict(True), sort_keys=True, default=str) for r in df.select("source", "source_index", "output", "annotation").collect())
    assert told(merging.merged_rows(spark, out)) == told(whole)
    assert merging.merged_rows(spark, out, "set b/x").count() == 4 and merging.merged_rows(spark, out, "set b/x", at=0).count() == 5
    assert len({f.split("/_part")[0] for f in merging.merged_rows(spark, out, "set a/x").inputFiles()}) == 1
    less = merging.merge_changed(changed, taxonomy, fewer, {n: "1" for n in names if n != "set b/x"}, out, ["input", "output"])
    assert (less["rewritten"], less["removed"]) == ([], ["set b/x"])
    assert [s["source"] for s in less["summary"]["sources"]] == ["set a/x", "set c/x"]
    with pytest.raises(KeyError):
        merging.merged_rows(spark, out, "set b/x")


def test_two_mergers_of_one_source(spark, tmp_path, monkeypatch):
    samples, taxonomy, quality = three(spark)
    out, seen = str(tmp_path / "o"), []
    plain = commits.Log.commit

    def late(self, make, what=""):
        if not seen:  # another one is done before this one commits
            seen.append(1)
            merging.merge_changed(samples, taxonomy, quality, {"set a/x": "other"}, out, ["input", "output"])
        return plain(self, make, what)

    monkeypatch.setattr(commits.Log, "commit", late)
    with pytest.raises(Conflict, match="set a/x"):
        merging.merge_changed(samples, taxonomy, quality, {"set a/x": "mine"}, out, ["input", "output"])
    assert merging.merge_changed(samples, taxonomy, quality, {"set a/x": "other", "set b/x": "1"}, out, ["input", "output"])["rewritten"] == ["set b/x"]


def test_no_rows_of_a_source(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        merging.merge_changed(*three(spark), {"nowhere": "1"}, str(tmp_path / "o"), ["input", "output"])


def test_signatures(spark, tmp_path):
    (tmp_path / "a").write_text("1")
    one = merging.source_signature(spark, [str(tmp_path / "a")], True)
    assert one == merging.source_signature(spark, [str(tmp_path / "a")], True) != merging.source_signature(spark, [str(tmp_path / "a")], False)
    (tmp_path / "a").write_text("12")
    assert one != merging.source_signature(spark, [str(tmp_path / "a")], True)


def test_stored_labels_are_not_dealt_anew(spark, tmp_path):
    samples, taxonomy, quality = three(spark)
    path = str(tmp_path / "labels")
    merging.store_labels(taxonomy, "labels_one", path, 4)
    labels = merging.stored_labels(spark, "labels_two", path)  # as another session has them
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = merging.annotated(samples, labels, quality)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    final = plan.split("Initial Plan")[0]
    lines = final.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
    for i, x in enumerate(lines):
        if "labels_two" in x and "FileScan" in x and "provisional" in x:  # the labels themselves
            above, level = [], depth(x)
            for y in reversed(lines[:i]):
                if depth(y) < level:
                    above.append(y.strip(" :+-"))
                    level = depth(y)
                    if "Join" in y:
                        break
            assert not [y for y in above if "Exchange" in y], above
            break
    else:
        raise AssertionError("no scan of labels")
    told = lambda df: sorted((r.source, r.source_index, str(r.annotation)) for r in df.collect())
    assert told(out) == told(merging.annotated(samples, taxonomy, quality))
    assert [r.source_index for r in merging.labels_of(labels, "set a/x").collect()] == [0, 2, 7, 9]
    with pytest.raises(Exception, match="a place twice"):
        merging.store_labels(taxonomy.union(taxonomy), "labels_three", str(tmp_path / "l3"), 2)


def test_ranks_of_one_hot_digest_are_dealt_over_tasks(spark):
    """A digest with nearly all rows: the same pairs as one after another, in blocks that no task has alone."""
    n = 200_000
    rows = spark.range(n).select(F.lit("s").alias("source"), (F.col("id") * 3).alias("source_index"), F.when(F.col("id") % 1000 == 0, F.col("id").cast("string")).otherwise("hot").alias("digest"))
    labels = spark.range(n).select(F.lit("s").alias("source"), (F.col("id") * 3 + 1).alias("source_index"), F.when(F.col("id") % 500 == 0, F.col("id").cast("string")).otherwise("hot").alias("digest"))
    got = merge.matched(rows, labels)
    assert got.count() == n
    hot = got.filter("digest = 'hot'").orderBy("source_index").select("source_index", "label_index").collect()
    want = [3 * i + 1 for i in range(n) if i % 500]
    assert [r.label_index for r in hot] == want + [None] * (len(hot) - len(want))
    few = got.filter("digest <> 'hot'").collect()
    assert {(r.source_index, r.label_index) for r in few} == {(3 * i, 3 * i + 1) for i in range(0, n, 1000)}
    assert {r.join_method for r in few} == {"taxonomy_digest_recovery"}


def test_ranks_by_null_groups(spark):
    df = spark.createDataFrame([(None, 5), (None, 1), ("a", 9), ("a", 2), ("a", 70_000)], "source string, source_index long")
    assert sorted((r.source or "", r.source_index, r.k) for r in merge.numbered(df, "k", block=4).collect()) == [("", 1, 1), ("", 5, 2), ("a", 2, 1), ("a", 9, 2), ("a", 70_000, 3)]
