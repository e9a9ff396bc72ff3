"""Aligned tokens against a plain version with the libraries, one text at a time."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from quarry.llm import crosstok
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a  b", "a \n b", "x\n\ny", " it's", "İstanbul ΣΑΣ ς", "a\x1cb c", "don't 'S 1234", "<|endoftext|> x", "a\tb", "trail ", "𝔘 😀 漢字かな", "ÀÉ,ß.ÿ×÷x²½ª.", None, "a▁b c", "▁", "   x", "\n", "a \nb", "a b  c", "<unk> <s> </s>", "a\x00b \x00 c", "﻿x y", "a     b      ", "a" * 105, "　x 　 y", "word " * 70 + "\n" + " x" * 40]


def brute(texts):
    """What the contract says, text by text."""
    lib = Tokenizer.from_file(PATHS[0])
    lib.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    both = crosstok.pair(*PATHS)
    found = []
    for x in texts:
        a, b = (lib.encode(" " + x, add_special_tokens=False).ids, pieces.encode(x)) if x else ([], [])
        spelt = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
        if not x or any(b"".join(s) != (" " + x).encode() for s in spelt):
            found.append(None)
            continue
        ends = [[sum(map(len, s[: i + 1])) for i in range(len(s))] for s in spelt]
        groups, low, links = [], 0, Counter()
        for end in sorted(set(ends[0]) & set(ends[1])):
            own = [[i for i, e in zip(ids, at, strict=True) if low < e <= end] for ids, at in zip((a, b), ends, strict=True)]
            groups.append("|".join(",".join(map(str, o)) for o in own))
            links.update((p, q) for p in own[0] for q in own[1])
            low = end
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(p for f in found if f for p in f[3])
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            links = f[3]
            out.append((*f[:3], sum(links.values()), sum(n for p, n in links.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in links.items()), f[4]))
    return out


@pytest.fixture(scope="module")
def texts(spark):
    return ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text) < 5000][:120]


@pytest.mark.parametrize(("words", "chunk", "store"), [(crosstok.SLICE, crosstok.CHUNK, crosstok.REMEMBERED), (40, 500, 100)])
def test_every_text_against_brute_force(spark, texts, monkeypatch, words, chunk, store):
    monkeypatch.setattr(crosstok, "SLICE", words)
    monkeypatch.setattr(crosstok, "CHUNK", chunk)
    monkeypatch.setattr(crosstok, "REMEMBERED", store)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = {r.doc_id: tuple(r)[1:] for r in crosstok.align(df, *PATHS).collect()}
    want = brute(texts)
    assert sorted(rows) == list(range(len(texts)))
    for i, x in enumerate(texts):
        assert rows[i] == want[i], x


def test_small_slices_in_one_process(texts, monkeypatch):
    """Documents over several slices, and long texts cut where both vocabularies begin anew."""
    both, want = crosstok.pair(*PATHS), brute(texts)
    for words, together in ((7, 1 << 19), (7, 20), (50, 64)):
        monkeypatch.setattr(crosstok, "SLICE", words)
        monkeypatch.setattr(crosstok, "TOGETHER", together)
        both.forget()
        got = {int(r): [out.column(c)[k].as_py() for c in out.schema.names] for rows, out in crosstok.aligned(texts, both) for k, r in enumerate(rows)}
        assert sorted(got) == list(range(len(texts)))
        for i in range(len(texts)):
            assert (*got[i][:4], got[i][4]) == (*want[i][:4], want[i][6])
            assert sum(got[i][6]) == want[i][3] and len(set(got[i][5])) == len(got[i][5])


def test_odd_tables(spark):
    rows = [(None, "a b c", "x"), (1, "a b c", "x"), (1, "a b c", "x"), (2, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk string").withColumns({"pairs": F.lit(1), "key": F.lit(2), "n": F.lit(3)})
    out = crosstok.align(df, *PATHS).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_a, r.count_sum) for r in out) == [(False, 1, 3, 9), (False, 1, 3, 9), (False, 2, 0, 0), (True, 0, 3, 9)]
    assert crosstok.align(df.limit(0), *PATHS).count() == 0
    with pytest.raises(ValueError, match="rename"):
        crosstok.align(df.withColumnRenamed("doc_id", "n_a"), *PATHS, key="n_a")
