from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from quarry.llm import ann, queries


def brute(rows, k=5):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % 50 == 0:
            like = sorted((-float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))), j) for j, w in ok if j != i)
            out[i] = [(j, -s) for s, j in like[:k]]
    return out


def told(out):
    found = {}
    for r in sorted(out.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    out = told(queries.op3_ann(spark, f"/root/testdata/{sf}"))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    want = brute(rows)
    assert set(out) == set(want)
    assert np.mean([len({j for j, _ in out[i]} & {j for j, _ in want[i]}) / len(want[i]) for i in want]) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for i, found in out.items():
        for j, s in found:
            a, b = vectors[i], vectors[j]
            assert abs(s - float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))) < 1e-12
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_odd_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(4, 3)).tolist()
    rows = [(0, base[0]), (50, base[0]), (100, base[1]), *((i, base[0]) for i in range(1, 12)), (13, base[2]), (13, base[2]), (14, None), (150, None), (200, [0.0, 0.0, 0.0]), (15, [1.0, None, 2.0]), (16, [float("nan"), 1.0, 1.0]), (250, [float("inf"), 1.0, 1.0]), (None, base[3]), (300, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, h int")
    out = told(ann.nearest(df, F.col("vec_id") % 50 == 0, "vec_id", "embedding"))
    want = brute([x for x in dict.fromkeys((i, None if v is None else tuple(v)) for i, v in rows) if x[1] is None or len(x[1]) == 3])
    assert {i: [j for j, _ in x] for i, x in out.items()} == {i: [j for j, _ in x] for i, x in want.items()}
    assert told(ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0, "vec_id", "embedding")) == {}
    few = df.filter("vec_id IN (0, 100, 13)")
    assert {i: [j for j, _ in x] for i, x in told(ann.nearest(few, F.col("vec_id") % 50 == 0, "vec_id", "embedding")).items()} == {i: [j for j, _ in x] for i, x in brute([x for x in rows if x[0] in (0, 100)] + [(13, base[2])]).items()}


def test_many_vectors_are_hashed_too(spark):
    x = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()], float)
    index = ann.fit(x, 1 << 28)
    u = ann.unit(x)
    like = u[:100] @ u.T
    like[np.arange(100), np.arange(100)] = -2
    assert len(index.planes) == ann.TABLES and index.width == ann.WIDTH and index.planes.shape[2] > 8
    assert ann.recall(index, u, u[:100], np.argsort(-like, 1)[:, :5]) >= 0.95
    assert max(np.unique(index.cells(u, t)[0], return_counts=True)[1].max() for t in range(ann.TABLES)) < len(u) / 10


def test_blocks_of_queries(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    want = told(queries.op3_ann(spark, sf))
    monkeypatch.setattr(ann, "ASKED", 3)
    monkeypatch.setattr(ann, "MERGED", 50)
    got = told(queries.op3_ann(spark, sf))
    assert {i: [j for j, _ in x] for i, x in got.items()} == {i: [j for j, _ in x] for i, x in want.items()}


def test_perturbations_come_in_order():
    m = 5
    sets = ann.perturbations(m, 60)
    cost = [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(1, 2 * m + 1)]
    totals = [sum(cost[j - 1] for j in s) for s in sets]
    assert all(a <= b + 1e-12 for a, b in zip(totals, totals[1:], strict=False))
    assert len(set(sets)) == len(sets) == 60
    assert all(2 * m + 1 - j not in s for s in sets for j in s)


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 20, 32))
    return (centres[rng.integers(0, len(centres), n)] + 0.25 * rng.normal(size=(n, 32))).astype(np.float32)


def test_clustered_vectors_are_told_by_few_visits(spark):
    x = clustered(4000).astype(float)
    index = ann.fit(x, 1 << 20)
    assert ann.visited(index, x) < 0.1
    u = ann.unit(x)
    like = u[:100] @ u.T
    like[np.arange(100), np.arange(100)] = -2
    assert ann.recall(index, u, u[:100], np.argsort(-like, 1)[:, :5]) >= 0.95


@pytest.mark.parametrize(("dealt", "held"), [(1 << 17, 1 << 15), (7, 2)])
def test_string_keys_and_dealt_buckets(spark, dealt, held, monkeypatch):
    monkeypatch.setattr(ann, "DEALT", dealt)
    monkeypatch.setattr(ann, "HELD", held)
    x = clustered(400, 1)
    df = spark.createDataFrame([(f"v{i:03}", v.tolist()) for i, v in enumerate(x)], "vec_id string, embedding array<float>")
    out = ann.nearest(df, F.col("vec_id").endswith("0"), "vec_id", "embedding", 3).collect()
    rows = x.astype(float)
    good = 0
    for i in range(0, 400, 10):
        like = sorted((-float(rows[i] @ w / (np.linalg.norm(rows[i]) * np.linalg.norm(w))), f"v{j:03}") for j, w in enumerate(rows) if j != i)[:3]
        good += len({v for _, v in like} & {r.vec_id for r in out if r.query_id == f"v{i:03}"})
    assert good >= 0.9 * 120
    assert len(out) == len({(r.query_id, r.vec_id) for r in out}) == 120


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_the_query_visits_by_perturbed_buckets(spark, sf):
    """The registered query's own index: several projections and probes, by which the neighbours are found."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    x = ann.unit(np.array([v for _, v in rows], float))
    index = ann.fit(x[: ann.SAMPLE], len(x))
    assert index.planes.shape[2] >= 8 and len(index.order) >= 8
    asked = np.array([i for i, (k, _) in enumerate(rows) if k % 50 == 0])
    seen = np.zeros((len(asked), len(x)), bool)
    first = np.zeros_like(seen)
    for t in range(len(index.planes)):
        own, visits = index.cells(x, t)[0], index.probes(x[asked], t)
        for i in range(len(asked)):
            seen[i] |= np.isin(own, visits[i])
            first[i] |= own == visits[i, 0]
    like = x[asked] @ x.T
    like[np.arange(len(asked)), asked] = -2
    true = np.argsort(-like, 1)[:, :5]
    recall, own = np.take_along_axis(seen, true, 1).mean(), np.take_along_axis(first, true, 1).mean()
    print(sf, "projections", index.planes.shape[2], "probes", len(index.order), "recall", recall, "visited", seen.mean(), "by own buckets alone", own)
    assert recall >= 0.9 and seen.mean() < 0.9 and own < recall - 0.3  # it is the perturbed buckets that find them


def test_multiples_tie(spark):
    """Vectors that are twice or half another one have the same cosine, whatever block they are compared in."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    rows = [(i, (base[i % 40] * 2.0 ** (i // 40 - 2)).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    for q, found in told(ann.nearest(df, F.col("vec_id") % 50 == 0, "vec_id", "embedding", 5)).items():
        assert [j for j, _ in found[:4]] == [j for j in range(q % 40, 200, 40) if j != q]
        assert len({s for _, s in found[:4]}) == 1
