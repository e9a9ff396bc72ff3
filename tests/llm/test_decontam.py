from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from quarry.llm import decontam, queries

SF = "/root/testdata/sf0.001"


def distance(pattern: bytes, text: bytes) -> int:
    """Least edits from pattern to any stretch of text: the plain table."""
    row = [0] * (len(text) + 1)
    for c in pattern:
        new = [row[0] + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng: random.Random, text: str, n: int) -> str:
    out = list(text)
    for _ in range(n):
        i, what = rng.randrange(len(out)), rng.randrange(3)
        if what == 0:
            out[i] = rng.choice("qxz")
        elif what == 1:
            del out[i]
        else:
            out.insert(i, rng.choice("qxz"))
    return "".join(out)


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("aeioustnr") for _ in range(rng.randint(2, 8))) for _ in range(n))


def brute(items, text):
    found = set()
    data = decontam.normal(text or "")
    for index in [decontam.Index(items)]:
        cover = {}
        for s in index.segments:
            if distance(s.data, data) <= s.edits:
                cover.setdefault(s.item, set()).update(range(s.start, s.start + len(s.data)))
        found |= {index.items[i][0] for i, c in cover.items() if len(c) / index.items[i][1] >= decontam.COVER}
    found |= {i for i, x in items if 0 < len(decontam.normal(x)) < decontam.Q and b" " + decontam.normal(x) + b" " in b" " + data + b" "}
    return found


def test_against_every_alignment():
    rng = random.Random(3)
    items = [(i, words(rng, rng.choice([2, 6, 15, 30, 60]))) for i in range(12)] + [(90, ""), (91, "tiny"), (94, "so  it-is"), (95, "é"), (92, "A same one, twice told here"), (93, "a SAME one twice told, here!")]
    texts: list[str | None] = [None, "", "...", words(rng, 300), "x" * 500, "tiny", "x tiny one y", "tinyx so it is", "soit is", "a é, b", "word " * 300]
    for _, x in items:
        for n in (0, 2, 6, 12, 25):
            texts.append(words(rng, rng.randint(0, 20)) + " " + edited(rng, x, n if len(x) > n else 0) + "\n" + words(rng, 5))
        texts.append(words(rng, 4) + " " + x[: len(x) * 2 // 3])
    index = decontam.Index(items)
    got = decontam.search(index, texts)
    assert any(got)
    for text, hits in zip(texts, got, strict=True):
        assert {h[0] for h in hits} == brute(items, text)


def test_spans_hold_the_item():
    item = "The Quick, brown fox -- jumps over the lazy dog and then some more words follow it to the end of the line"
    text = "Ünter İ uns: “the QUICK brown fox jumps over the lazy dog and then some more words follow it to the end of the line”, they said."
    (hits,) = decontam.search(decontam.Index([(7, item)]), [text])
    ((name, start, length, edits),) = hits
    assert (name, edits) == (7, 0)
    assert text[start : start + length] == text[text.index("the QUICK") : text.index("”")]


@pytest.mark.parametrize("block", [1 << 22, 300])
def test_table(spark, block, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", block)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id: {m.item for m in r.m} for r in docs.select("doc_id", decontam.matches(F.col("text"), spark.read.parquet(f"{SF}/benchmark.parquet")).alias("m")).collect()}
    if block == 300:  # in many passes
        bench = spark.read.parquet(f"{SF}/benchmark.parquet").limit(9)
        own = {r.item_id for r in bench.collect()}
        some = decontam.matched(docs, bench).collect()
        assert {r.doc_id: {m.item for m in r.matches} for r in some} == {d: m & own for d, m in got.items()}
        assert {r.doc_id for r in decontam.decontaminate(docs, bench).collect()} == {d for d, m in got.items() if not m & own}
    whole = {r.doc_id: {i for i, x in items if decontam.normal(x) in decontam.normal(r.text)} for r in docs.collect()}
    assert sum(map(bool, whole.values())) > 0
    assert got == whole


def test_odd_tables(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.createDataFrame([(1, None, 3), (None, "", 3), (2, bench.first().text, 3), (2, bench.first().text, 3)], "doc_id long, text string, matches int")
    assert sorted((r.doc_id or 0) for r in decontam.decontaminate(docs, bench).collect()) == [0, 1]
    assert decontam.decontaminate(docs, bench.limit(0)).count() == 4
    assert decontam.decontaminate(docs, bench.select(F.lit(None).cast("long").alias("item_id"), F.lit(None).cast("string").alias("text"))).count() == 4
    assert decontam.decontaminate(docs.limit(0), bench).count() == 0


def test_query(spark):
    out = queries.op10_decontamination(spark, SF)
    assert out.count() == 200
    assert out.filter("contaminated").count() > 0


def test_items_of_other_types(spark):
    docs = spark.createDataFrame([(1, "a short one and a longer item of the benchmark here")], "doc_id long, text string")
    for kind in ("decimal(10,2)", "binary", "smallint", "date", "string"):
        bench = spark.range(1).select(F.lit("2020-01-01" if kind == "date" else "7").cast("string").cast(kind).alias("item_id"), F.lit("a longer item of the benchmark").alias("text"))
        (row,) = decontam.matched(docs, bench).collect()
        assert [m.item for m in row.matches] == [bench.first().item_id]
    with pytest.raises(ValueError):
        decontam.matched(docs.withColumn("matches", F.lit(1)), bench)
