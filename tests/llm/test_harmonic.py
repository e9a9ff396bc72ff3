"""Harmonic packing: an exact cover with the library's ids, no overlap, little padding at any size."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from quarry.llm import harmonic
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def padded(sizes, capacity):
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in sizes)


def frame(spark, which):
    rows = [(1, "a b", 1), (1, "a b", 1), (2, None, 2), (3, "", 2), (None, "no key", 3), (4, "long " * 30_000, 4), (5, "İ 𝔘 <|endoftext|> don't", 5)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, task int").withColumns({"rank": F.lit(1), "number": F.lit("x"), "key": F.lit(2)})
    return {"odd": odd, "sf": spark.read.parquet(f"{SF}/documents.parquet").repartition(5), "empty": odd.limit(0)}[which]


@pytest.mark.parametrize("which", ["odd", "sf", "empty"])
def test_pack(spark, which):
    df = frame(spark, which)
    out = harmonic.pack(df, WORDS, 4096).collect()
    lib = Tokenizer.from_file(WORDS)
    lib.encode_special_tokens = True
    whole = Counter()
    for r in df.collect():
        ids = np.array([*lib.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        first = harmonic.cuts(4096)
        for start, length in harmonic.pieces(len(ids), 4096, first):
            whole[r.doc_id, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == whole
    held = defaultdict(list)
    for r in out:
        held[r.sequence_id].append((r.offset, r.length))
    sizes = []
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        sizes.append(at)
    assert not held or sorted(held) == list(range(len(held)))
    tokens = sum(r.length for r in out)
    assert padded(sizes, 4096) <= 0.004 * tokens + 4096
    if which == "sf":
        assert len(out) < 4 * df.count()


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=20), st.sampled_from([64, 60, 63]))
def test_plans_place_each_piece_once(totals, capacity):
    totals = {capacity // k: n for k, n in totals.items() if capacity // k}
    plan = harmonic.Plan(totals, capacity)
    held = defaultdict(list)
    for length, n in totals.items():
        sequence, offset = plan.places(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            held[s].append((o, length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(held) == list(range(plan.sequences))


@pytest.mark.parametrize("capacity", [1, 2, 7, 64, 4096])
def test_cuts_cover_every_rest_and_are_classes(capacity):
    first, known = harmonic.cuts(capacity), set(harmonic.classes(capacity))
    for n in range(1, 3 * capacity):
        parts = list(harmonic.pieces(n, capacity, first))
        assert [s for s, _ in parts] == np.cumsum([0, *(x for _, x in parts)])[:-1].tolist() and sum(x for _, x in parts) == n
        assert all(x in known for _, x in parts)
    if capacity == 4096:
        waste = [(capacity - capacity // x * x) / capacity for x in known]
        assert max(waste) < 0.016


def test_cuts_are_the_cheapest():
    """Against all ways to cut, at a small capacity."""
    capacity = 24
    lengths = [x for x in harmonic.classes(capacity) if x < capacity]
    price = {x: (capacity - capacity // x * x) / (capacity // x) + harmonic.CUT for x in lengths}
    best = [0.0]
    for n in range(1, capacity):
        best.append(min(price[x] + best[n - x] for x in lengths if x <= n))
    first = harmonic.cuts(capacity)
    for n in range(1, capacity):
        assert sum(price[x] for _, x in harmonic.pieces(n, capacity, first)) == pytest.approx(best[n])
