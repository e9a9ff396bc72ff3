from __future__ import annotations

import random
import re

import pytest
from quarry.llm import jaccard, queries
from quarry.llm.components import components

SF = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    """doc_id: set size and component, over all pairs that share a shingle."""
    sets, lists = [], {}
    for i, (_, text) in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0d]+", lowered(text))
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.append(s)
        for x in s:
            lists.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for x in s for j in lists[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * len(s | sets[j]):
                root[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    known = [-1 if d is None else d for d, _ in rows]
    return sorted((known[i], len(sets[i]), least.get(find(i), -1) if sets[i] else known[i]) for i in range(len(rows)))


def told(out):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in out.collect())


def near(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(60)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    common = say(55)
    rows = [None, "", " \t\n", "one", "One", "one two three four", "ONE two\tthree\nfour", "a b c d e", "a b c d e f", "a b c d e f g h i", "b c d e f g h i j", "x " * 400, "x " * 9]
    for n in (6, 8, 9, 10, 12, 20, 60, 200):
        base = say(n)
        rows += [base, base.upper(), base + " more", base + " more words here"] + [near(rng, base, k % 4) for k in range(8)]
    base = say(120)
    rows += [near(rng, base, k % 5) for k in range(80)]  # a large group of near copies
    rows += [say(rng.randint(5, 40)) + " " + common + " " + say(rng.randint(0, 40)) for _ in range(60)]  # one common passage
    rows += [common, common + " z", "q " + common]
    return [(i * 7 % 1009, x) for i, x in enumerate(rows)]


@pytest.mark.parametrize("few", [False, True])
def test_against_all_pairs(spark, few, monkeypatch):
    if few:  # small limits: dealt buckets, many leaders
        monkeypatch.setattr(jaccard, "FREQUENT", 3)
        monkeypatch.setattr(jaccard, "DEALT", 4)
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert told(jaccard.join(df)) == brute(rows)


def test_odd_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, None), (None, "k l m n o p q"), (8, "")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, node string")
    assert told(jaccard.join(df)) == brute(rows)
    assert told(jaccard.join(df.limit(0))) == []
    kept = jaccard.keep_one(df.filter("doc_id IS NOT NULL"))
    assert sorted(r.doc_id for r in kept.collect()) == [5, 8]
    assert kept.columns == df.columns


def test_texts_that_share_a_key(spark):
    a, b, c = ("a b c d e f g h i j k l m n o p q r", "k l m n o p q r s", "t u v w x y z")
    rows = [(5, a, "x"), (5, b, "y"), (5, c, "x"), (5, b, "x"), (3, a + " s", "x"), (7, b, "a"), (8, "", "x"), (8, "", "x"), (None, c, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, said string")
    kept = jaccard.keep_one(df)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(3, a + " s", "x"), (5, b, "x"), (5, c, "x"), (8, "", "x"), (None, c, "x")], key=str)
    assert kept.dtypes == df.dtypes


def test_boundary_and_prefix():
    assert [jaccard.prefix_size(n) for n in (1, 4, 5, 6, 10, 600)] == [1, 1, 2, 2, 3, 121]
    assert jaccard.boundary(1) <= jaccard.boundary(10) <= jaccard.boundary(1000)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(20), 100 + rng.randrange(20)) for _ in range(12)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        root[find(a)] = find(b)
    for a in got:
        for b in got:
            assert (got[a] == got[b]) == (find(a) == find(b))


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert told(queries.op6_jaccard(spark, SF)) == brute(rows)


def test_overlaps_in_chunks():
    import numpy as np

    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 90)).astype(np.uint64)) for _ in range(23)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for most in (1, 50, 200, 10**6):
        assert jaccard.overlaps(sets, most).tolist() == want


def test_rows_without_a_key_take_linear_time(spark):
    """Each text is found by its key and itself: texts without a key don't meet all others without one."""
    import time

    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    bases = [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(2000)]
    rows = [x for b in bases for x in (b, b + " more")]
    took = []
    for keys in (True, False):
        df = spark.createDataFrame([(i if keys else None, x) for i, x in enumerate(rows)], "doc_id long, text string").repartition(8)
        begun = time.time()
        out = jaccard.join(df).collect()
        took.append(time.time() - begun)
        assert len(out) == 4000 and {r.n_shingles for r in out} == {56, 57}
        assert not keys or all(r.component_id == r.doc_id - r.doc_id % 2 for r in out)
    assert took[1] < 1.5 * took[0] + 5
