"""The pipeline against brute-force versions of its stages."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
import pytest  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from quarry.llm import decontam, queries, shared  # noqa: E402

from tests.llm import test_jaccard, test_suffix  # noqa: E402

SF = "/root/testdata/sf0.001"


def less_whole_characters(text, mask):
    """The characters of which not all bytes are masked."""
    out, at = [], 0
    for c in text.decode():
        n = len(c.encode())
        if not all(mask[at : at + n]):
            out.append(c)
        at += n
    return "".join(out)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "best-fit packing"]
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(out := str(tmp_path / str(k)))
        docs = spark.read.parquet(out)
        kept.append(docs)
        if k < 4:
            assert docs.columns == columns
            assert docs.count() == docs.select("doc_id").distinct().count()
    first, second, third, fourth, last = kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stayed = {r.doc_id for r in first.collect()}
    assert sum((d in stayed) == (q == 1) for d, q in labels.items()) / len(labels) > 0.93
    rows = [(r.doc_id, r.text) for r in first.collect()]
    assert {r.doc_id for r in second.collect()} == {c for _, _, c in test_jaccard.brute(rows)}
    rows = {r.doc_id: (r.text or "").encode() for r in second.collect()}
    masks = dict(zip(rows, test_suffix.brute(list(rows.values()), 200), strict=True))
    want = {d: less_whole_characters(t, masks[d]) for d, t in rows.items()}
    got = {r.doc_id: r.text for r in third.collect()}
    assert got == {d: t for d, t in want.items() if not any(masks[d]) or t.strip(" ")}
    assert all(r.n_chars == len(r.text) for r in third.collect())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d, hits in zip(got, decontam.search(decontam.Index(items), list(got.values())), strict=True) if not hits}
    assert {r.doc_id for r in fourth.collect()} == clean
    assert not any(decontam.normal(x) in decontam.normal(r.text) for _, x in items for r in fourth.collect())
    assert {r.doc_id for r in last.collect()} == clean


def test_run(spark):
    waiting = queries.op3_ann(spark, SF)  # of another query, not read yet
    before = list(shared._made)
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path("/").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert before and all(system.exists(path(x)) for x in before)  # other queries' tables stay
    assert all(system.exists(path(x)) for x in shared._made)
    assert waiting.count() == 5 * spark.read.parquet(f"{SF}/embeddings.parquet").filter("vec_id % 50 = 0").count()


def test_tables_of_a_run(spark):
    one = shared.materialize(spark.range(3))
    with shared.Run() as run:
        two, three = shared.materialize(spark.range(4)), shared.materialize(spark.range(5))
        run.clean(spark, but=three)
        assert len(run.made) == 1
    assert (one.count(), three.count()) == (3, 5)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        two.count()


def test_odd_tables(spark, tmp_path):
    """Null keys and texts, repeated rows, extra columns with clashing names, and no rows at all."""
    said = "The committee met again on Tuesday to discuss the plan, and most of its members agreed that more time was needed for the work. "
    rows = [(None, said + "a", "en", "s", 1, 5), (1, None, "en", "s", None, 5), (2, "", None, None, 0, 5), (3, said * 400, "en", "s", 9, 5), (4, said + "b c d e f", "en", "s", 9, 5), (4, said + "b c d e f", "en", "s", 9, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node int")
    df = df.withColumns({"id": F.lit(1), "h": F.lit("x"), "rank": F.lit(2), "kept": F.lit("k"), "matches": F.lit(0), "row": F.lit(1), "_range": F.lit(3)})
    for which, docs in (("odd", df), ("empty", df.limit(0))):
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF).write.parquet(out := str(tmp_path / f"{which}{k}"))
            docs = spark.read.parquet(out)
            if k < 4:
                assert docs.columns == columns
        assert (docs.count() == 0) == (which == "empty")
