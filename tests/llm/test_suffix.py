from __future__ import annotations

import hashlib
import random

import pytest
from quarry.llm import queries, suffix

SF = "/root/testdata/sf0.001"


def brute(texts, least):
    """Masks of the bytes that a repeated string of ``least`` bytes covers."""
    seen = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - least + 1):
            seen.setdefault(t[p : p + least], []).append((i, p))
    masks = [bytearray(len(t)) for t in texts]
    for found in seen.values():
        if len(found) > 1:
            for i, p in found:
                masks[i][p : p + least] = b"\1" * least
    return masks


def corpus(seed):
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    common, other = say(260), say(230)
    rows = [None, "", "short", "a" * 199, "b" * 201, "ab" * 400, "xyz" * 300, "xyz" * 90, say(5000)]
    rows += [say(rng.randint(0, 120)) + common + say(rng.randint(0, 120)) for _ in range(40)]
    rows += [other[rng.randint(0, 40) :] + say(30) for _ in range(12)] + [common + other, say(50) + common + common[100:] + other]
    base = say(900)
    for _ in range(30):
        k = rng.randrange(900)
        rows.append(base[:k] + "!" + base[k + rng.randint(0, 3) :])
    rows += [base] * 5 + [base[:450]] * 2
    return [(i, x) for i, x in enumerate(rows)]


def compare(df, out, least):
    rows = sorted(((-1 if r.doc_id is None else r.doc_id), (r.text or "").encode()) for r in df.collect())
    masks = brute([t for _, t in rows], least)
    want = sorted((d, bytes(c for c, m in zip(t, mask, strict=True) if not m), sum(mask)) for (d, t), mask in zip(rows, masks, strict=True))
    got = sorted(((-1 if r.doc_id is None else r.doc_id), bytes(r.kept), sum(s.length for s in r.removed)) for r in out.collect())
    assert got == want


@pytest.mark.parametrize("hot", [False, True])
def test_against_all_windows(spark, hot, monkeypatch):
    if hot:  # dealt grams, and windows told by counts
        monkeypatch.setattr(suffix, "FREQUENT", 4)
        monkeypatch.setattr(suffix, "DEALT", 3)
        monkeypatch.setattr(suffix, "SORTED", 5)
    df = spark.createDataFrame(corpus(1), "doc_id long, text string")
    compare(df, suffix.deduplicate(df), 200)


def test_odd_rows(spark):
    rows = [(None, "z" * 250, 1, 2, 3), (4, "q" * 210, 1, 2, 3), (4, "q" * 210, 1, 2, 3), (5, None, 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int, gram int, start int")
    out = suffix.deduplicate(df)
    assert out.columns == [*df.columns, "kept", "removed"]
    compare(df, out, 200)
    assert suffix.deduplicate(df.limit(0)).count() == 0
    left = suffix.rewritten(df.withColumnRenamed("gram", "kept"))
    assert left.columns == ["doc_id", "text", "id", "kept", "start"]
    assert [(r.doc_id, r.text) for r in left.collect()] == [(5, None)]


def test_repeats_are_maximal():
    rng = random.Random(4)
    for _ in range(30):
        texts = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(4)]
        least = rng.randint(2, 6)
        raw = [t.encode() for t in texts]
        got = {}
        for length, found in suffix.maximal_repeats(raw, [max(0, len(t) - least + 1) for t in raw], least):
            i, p = found[0]
            got[raw[i][p : p + length]] = sorted(found)
        want = {}
        for i, t in enumerate(raw):
            for p in range(len(t)):
                for n in range(least, len(t) - p + 1):
                    want.setdefault(t[p : p + n], []).append((i, p))
        want = {s: sorted(o) for s, o in want.items() if len(o) > 1}

        def diverse(s, where, side, raw=raw):
            at = [p - 1 if side < 0 else p + len(s) for _, p in where]
            return len({raw[i][q] if 0 <= q < len(raw[i]) else (i, q) for (i, _), q in zip(where, at, strict=True)}) > 1

        want = {s: o for s, o in want.items() if diverse(s, o, -1) and diverse(s, o, 1)}
        assert got == want


def test_query(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    masks = dict(zip(docs, brute(list(docs.values()), 200), strict=True))
    out = queries.op2_suffix(spark, SF).collect()
    assert len(out) == len(docs)
    for r in out:
        m = bytes(masks[r.doc_id])
        kept = bytes(c for c, x in zip(docs[r.doc_id], m, strict=True) if not x)
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(m), sum(m), sum(x and not y for x, y in zip(m, b"\0" + m, strict=False)))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_different_texts_of_one_hash_stay_apart(spark, monkeypatch):
    """With a first hash that can't tell texts apart, the second does."""
    hashes = suffix.F.xxhash64
    monkeypatch.setattr(suffix.F, "xxhash64", lambda *c: hashes(*c) if len(c) > 1 else suffix.F.length(c[0]).cast("long"))
    df = spark.createDataFrame([(1, "a" * 250), (2, "b" * 250), (3, "c" + "d" * 249), (4, "c" + "d" * 249), (5, "e" * 300)], "doc_id long, text string")
    own, copies = suffix.identified(df, suffix.F.col("text"), 200)
    assert [r.c for r in copies.collect()] == [2]
    assert df.select(own.alias("i")).distinct().count() == 4


def test_only_whole_characters_go(spark):
    """Equal bytes that begin or end within a character: é and ê share their first byte, é and ũ their last."""
    middle = "x" * 205
    df = spark.createDataFrame([(1, f"aé{middle}éb"), (2, f"cũ{middle}êd"), (3, "clean")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in suffix.rewritten(df).collect()}
    assert got == {1: "aééb", 2: "cũêd", 3: "clean"}
    kept = {r.doc_id: bytes(r.kept) for r in suffix.deduplicate(df).collect()}
    assert kept[1] == "aé".encode()[:2] + "é".encode()[1:] + b"b"


@pytest.mark.parametrize("most", [20_000, 2])
def test_groups_hold_all_occurrences(spark, most, monkeypatch):
    monkeypatch.setattr(suffix, "SORTED", most)
    rows = corpus(2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffix.groups(df).collect()
    raw = {d: (t or "").encode() for d, t in rows}
    found = {}
    for r in out:
        found.setdefault((r.group, r.length), set()).add((r.doc_id, r.start))
    masks = {d: bytearray(len(t)) for d, t in raw.items()}
    for (_, n), where in found.items():
        (said,) = {raw[d][p : p + n] for d, p in where}
        assert len(said) == n >= 200 and len(where) > 1
        every = {(d, p) for d, t in raw.items() for p in range(len(t) - n + 1) if t[p : p + n] == said}
        assert where == every
        for d, p in where:
            masks[d][p : p + n] = b"\1" * n
    want = brute(list(raw.values()), 200)
    copied = [list(raw.values()).count(t) > 1 for t in raw.values()]
    for d, w, c in zip(raw, want, copied, strict=True):
        assert bytes(masks[d]) == bytes(w), (d, c)
