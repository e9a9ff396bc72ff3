"""Sheets that people fill in: refused where they are wrong, the last row of a cluster counts."""

from __future__ import annotations

import pytest
from quarry.operators import resolve
from quarry.plans import labelling
from quarry.sources import readers

HEAD = "cluster_id,human_primary_label,human_secondary_labels,human_taxonomy_fit,human_rationale,reviewer\n"


def sheet(spark, tmp_path, text):
    (tmp_path / "h.csv").write_text(HEAD + text, encoding="utf-8")
    return readers.read_csv(spark, str(tmp_path / "h.csv"))


def test_a_sheet(spark, tmp_path):
    rows = sheet(spark, tmp_path, 'todo,,,,,\ndone,AD,TR,exact,"because, yes",me\nout,,,out_of_scope,,\nkept,PR,"TR; PR|AD",out_of_scope,,\nnone,None,,closest,,\ntwice,AD,,exact,first,a\ntwice,PR,NU,compatible,second,b\n')
    got = {r.cluster_id: tuple(r)[1:] for r in resolve.human_labels(rows).collect()}
    assert got == {
        "done": ("AD", ["TR"], "exact", "because, yes", "me"),
        "out": (None, [], "out_of_scope", "", ""),
        "kept": ("PR", ["AD", "TR"], "out_of_scope", "", ""),
        "none": (None, [], "closest", "", ""),
        "twice": ("PR", ["NU"], "compatible", "second", "b"),
    }


@pytest.mark.parametrize(("row", "message"), [("a,AD,,bogus,,", "taxonomy_fit: bogus"), ("a,XX,,exact,,", "primary_label: XX"), ("a,AD,TR foo,exact,,", "secondary_labels: TR foo")])
def test_wrong_sheets_fail(spark, tmp_path, row, message):
    with pytest.raises(Exception, match=message):
        resolve.human_labels(sheet(spark, tmp_path, row + "\n")).collect()


def test_records(spark):
    rows = spark.createDataFrame([("a", "AD", None, None, 1), ("a", "PR", ["TR"], "closest", 2), ("b", None, None, None, 3)], "cluster_id string, primary_label string, secondary_labels array<string>, taxonomy_fit string, line int")
    got = {r.cluster_id: tuple(r)[1:] for r in resolve.human_records(rows, rows["line"]).collect()}
    assert got == {"a": ("PR", ["TR"], "closest"), "b": (None, [], "exact")}


def test_the_last_written_label_counts(spark, tmp_path):
    """A template's labels of two runs: the later one counts, whatever the alphabet says."""
    import json

    rows = spark.createDataFrame([("r1", 1, "q 1", "a", None)], "record_id string, line_number long, question string, answer string, reason string")
    to = labelling.Labels(str(tmp_path / "rows"))
    say = lambda q: lambda payloads: [json.dumps({"quality": q, "difficulty": "easy", "reason": "r"}) for _ in payloads]
    labelling.label(rows, say("weak"), to, "m")
    first = spark.read.parquet(to.templates)
    first.withColumn("quality", first.quality).withColumn("written", first.written + 1).replace("weak", "excellent", "quality").write.mode("append").parquet(to.templates)
    more = spark.createDataFrame([("r2", 2, "q 2", "a", None)], rows.schema)
    labelling.label(more, say("never asked"), to, "m")
    assert {r.record_id: r.quality for r in spark.read.parquet(to.rows).collect()} == {"r1": "weak", "r2": "excellent"}
