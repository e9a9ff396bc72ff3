"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing.

Unit vectors are hashed in several tables: in each, M Gaussian projections are shifted, cut into cells of one width and
read as a bucket. For unit vectors the nearest by cosine are the nearest by distance, which such buckets keep together.
A query visits its own bucket and then perturbed ones (some projections moved a cell down or up), in order of estimated
success: sums of squared expected distances to the cells' edges decide the order of perturbation sets, and each query
applies them to its own projections sorted by distance. Queries and vectors meet by bucket in one shuffle. There every
vector of a visited bucket is compared with the query in double precision, and the tables' candidates are merged.

Equal vectors are one class that keeps its smallest ids, as many as a result can need; so many copies cost no more than
one, and no result is lost. Buckets are streamed: the queries of one are held, its vectors pass in chunks, and a chunk
is compared with a block of queries at a time. A bucket of more than DEALT vectors or HELD queries is dealt over several
tasks, each of which holds one part of its queries and sees one part of its vectors. What travels to the buckets are the
vectors themselves (in the element type of the column), once a table, and not pairs of ids: where neighbours are hard to
tell from others, candidates are far more than vectors.

The numbers of projections and probes are fitted on a sample of at most SAMPLE vectors (those of smallest hash): of those
that find AIM of the sample's true neighbours, for at most PILOT of its vectors, the ones that cost least, by the share of
vectors visited, the number of vectors and the number of probes. Where PROBES probes don't find as many, there are fewer
projections, so larger buckets. All vectors are indexed. ``visited`` tells the share of vectors that queries visit.

Defined results: vectors that are null, of length zero, of another dimension than most, or that hold a null or a
non-finite component take no part, as queries or candidates; a query has fewer than k neighbours only if fewer are
found; ties go to the smaller id; a null id takes no part; repeated rows of one id count once; an empty table gives an
empty result; columns that aren't named are ignored. Ids may be of any type that has an order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, partitions

TABLES, WIDTH = 12, 2.2
#: Probes a table at most, and the cost of a probe in vectors compared.
PROBES, PROBE = 800, 8
SAMPLE, PILOT, AIM = 4096, 200, 0.975
#: Projections a table at least; what two ways to sum a cosine may differ by.
LEAST, SLACK = 8, 1e-12
CHUNK, MERGED = 1024, 400_000
#: Vectors and queries of a bucket in one task.
DEALT, HELD = 1 << 17, 1 << 15
ASKED = 4096  # queries compared with a chunk at once


def perturbations(m: int, most: int) -> list[tuple[int, ...]]:
    """Sets of places (1 to 2m, by distance to the edge) in order of expected success; the first is empty."""
    cost = [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(1, 2 * m + 1)]
    out: list[tuple[int, ...]] = [()]
    heap: list[tuple[float, tuple[int, ...]]] = [(cost[0], (1,))]
    while heap and len(out) < most:
        total, chosen = heapq.heappop(heap)
        j = chosen[-1]
        if j < 2 * m:
            heapq.heappush(heap, (total - cost[j - 1] + cost[j], (*chosen[:-1], j + 1)))
            heapq.heappush(heap, (total + cost[j], (*chosen, j + 1)))
        if all(2 * m + 1 - i not in chosen for i in chosen):  # a projection moves one way only
            out.append(chosen)
    return out


@dataclass
class Index:
    """The hash functions: planes (table, dimension, M), shifts (table, M), signs (table, M) and the probes' order."""

    planes: np.ndarray
    shifts: np.ndarray
    signs: np.ndarray
    width: float
    order: list[tuple[int, ...]]

    @classmethod
    def make(cls, dimension: int, m: int, width: float = WIDTH, tables: int = TABLES, probes: int = 25, seed: int = 1) -> Index:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(size=(tables, dimension, m)), rng.uniform(0, width, (tables, m)), rng.integers(1, 2**62, (tables, m)) | 1, width, perturbations(m, probes))

    def cells(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each unit vector in table t, and the place in each cell."""
        f = (x @ self.planes[t] + self.shifts[t]) / self.width
        h = np.floor(f)
        return (h.astype(np.int64) * self.signs[t]).sum(1) * len(self.planes) + t, f - h

    def probes(self, x: np.ndarray, t: int) -> np.ndarray:
        """Buckets to visit in table t, best first: one row a vector."""
        own, inside = self.cells(x, t)
        order = np.argsort(np.concatenate([inside, 1 - inside], 1), 1, kind="stable")
        move = np.concatenate([-self.signs[t], self.signs[t]])[order] * len(self.planes)
        return np.stack([own + move[:, [j - 1 for j in chosen]].sum(1) if chosen else own for chosen in self.order], 1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(sample: np.ndarray, n: int, k: int = 5) -> Index:
    """An index for n vectors whose probes find AIM of the true neighbours in the sample, at the least cost. It has LEAST
    projections or more at any n, so that buckets are small and the order of probes does the finding; fewer only where even
    the most probes miss the aim with these."""
    x = unit(sample)
    asked = x[: min(PILOT, len(x))]
    like = asked @ x.T
    like[np.arange(len(asked)), np.arange(len(asked))] = -2
    true = np.argsort(-like, 1)[:, : min(k, len(x) - 1)]
    if not true.size:
        return Index.make(x.shape[1], 8, probes=1)
    middle = 8 + max(0, round((np.log2(max(2, n)) - 16) / 2))
    best: tuple[float, Index] | None = None
    for m in range(middle + 8, 0, -2):
        if m < LEAST and best is not None:
            break
        index = Index.make(x.shape[1], m, probes=PROBES)
        rank = np.sort(_needed(index, x, asked, true), axis=None)[int(np.ceil(AIM * true.size)) - 1]
        if rank >= len(index.order):
            continue  # too many projections: even the most probes miss the aim
        index.order = index.order[: int(rank) + 1]
        cost = _seen(index, x, asked).mean() * n + PROBE * len(index.order) * len(index.planes)
        if best is None or cost < best[0]:
            best = (cost, index)
        elif m < middle:
            break
    return best[1] if best is not None else Index.make(x.shape[1], 1, probes=PROBES)


def _needed(index: Index, x: np.ndarray, asked: np.ndarray, true: np.ndarray) -> np.ndarray:
    """For each true neighbour the rank of the first probe that visits it in some table (the number of probes, if none)."""
    out = np.full(true.shape, len(index.order))
    for t in range(len(index.planes)):
        own, visits = index.cells(x, t)[0], index.probes(asked, t)
        same = own[true][:, :, None] == visits[:, None, :]
        out = np.minimum(out, np.where(same.any(2), same.argmax(2), len(index.order)))
    return out


def _seen(index: Index, x: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Which vectors (columns) each query (row) visits."""
    seen = np.zeros((len(asked), len(x)), bool)
    for t in range(len(index.planes)):
        own, visited = index.cells(x, t)[0], index.probes(asked, t)
        for i in range(len(asked)):
            seen[i] |= np.isin(own, visited[i])
    return seen


def recall(index: Index, x: np.ndarray, asked: np.ndarray, true: np.ndarray) -> float:
    """The share of the true neighbours (places in x) that the index's probes visit."""
    return float(np.take_along_axis(_seen(index, x, asked), true, 1).mean())


def visited(index: Index, sample: np.ndarray) -> float:
    """The share of a sample's vectors that its first PILOT ones visit."""
    x = unit(sample)
    return float(_seen(index, x, x[: min(PILOT, len(x))]).mean())


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda v: v != 0)


def nearest(df: DataFrame, is_query: Column, key: str, vector: str, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), key, score: the k nearest found of each query, without itself."""
    single = df.schema[vector].dataType.simpleString() == "array<float>"
    real = np.dtype(np.float32 if single else np.float64)
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("v"), is_query.alias("q")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return df.select(F.col(key).alias("query_id"), F.lit(0).alias("rank"), F.col(key), F.lit(0.0).alias("score")).limit(0)
    dimension, n = sizes[0]["d"], sizes[0]["n"]
    rows = rows.filter(F.size("v") == dimension).withColumn("h", F.xxhash64("v"))
    sample = np.array([r["v"] for r in rows.select("h", "v").orderBy("h").limit(SAMPLE).select("v").distinct().toPandas().to_dict("records")], np.float64)
    index = fit(sample, n, k)
    # A class keeps k + 1 ids: all that results can need, a query's own left out.
    ranked = rows.select("h", "id", "v").dropDuplicates(["h", "id"]).withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("id"))).filter(F.col("r") <= k + 1)
    classes = materialize(ranked.groupBy("h").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.any_value("v").alias("v")))
    queries = rows.filter("q").select("h", "id").distinct()
    asked = classes.join(queries.select("h").distinct(), "h", "left_semi").select("h", "v")

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)

    def spread(role: int, batches: Iterable[pa.RecordBatch], told: bool = True) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK):
                part = batch.slice(a, CHUNK)
                x = matrix(part.column("v"))
                u = unit(x.astype(np.float64))
                h = part.column("h").to_numpy()
                for t in range(len(index.planes)):
                    buckets = index.probes(u, t) if role == 0 else index.cells(u, t)[0][:, None]
                    wide = buckets.shape[1]
                    if not told:
                        yield pa.RecordBatch.from_arrays([pa.array(buckets.ravel()), pa.array(np.full(wide * len(x), role, np.int32))], names=["bucket", "role"])
                        continue
                    raw = pa.array([v.tobytes() for v in x], pa.binary()).take(pa.array(np.repeat(np.arange(len(x)), wide)))
                    yield pa.RecordBatch.from_arrays([pa.array(buckets.ravel()), pa.array(np.full(wide * len(x), role, np.int32)), pa.array(np.repeat(h, wide)), raw], names=["bucket", "role", "h", "v"])

    def visits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return spread(0, batches)

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return spread(1, batches)

    schema = "bucket long, role int, h long, v binary"
    vectors = classes.select("h", "v")
    # Buckets that one task can't take; there are none unless vectors crowd.
    counted = asked.mapInArrow(lambda b: spread(0, b, False), "bucket long, role int").union(vectors.mapInArrow(lambda b: spread(1, b, False), "bucket long, role int"))
    sizes = counted.groupBy("bucket").agg(F.count_if(F.col("role") == 1).alias("nv"), F.count_if(F.col("role") == 0).alias("nq"))
    hot = materialize(sizes.filter((F.col("nq") > 0) & ((F.col("nv") > DEALT) | (F.col("nq") > HELD))).select("bucket", F.ceil(F.col("nv") / DEALT).cast("int").alias("sv"), F.ceil(F.col("nq") / HELD).cast("int").alias("sq")), few=True)
    asks, places_ = asked.mapInArrow(visits, schema), vectors.mapInArrow(places, schema)
    if hot.isEmpty():
        both = asks.union(places_).withColumn("salt", F.lit(0))
    else:
        dealt = lambda name: F.pmod(F.xxhash64("h", F.lit(3)), F.coalesce(name, F.lit(1))).cast("int")
        every = lambda name: F.explode(F.sequence(F.lit(0), F.coalesce(name, F.lit(1)) - 1))
        width = F.coalesce("sv", F.lit(1))
        asks = asks.join(hot, "bucket", "left").withColumn("k", every("sv")).withColumn("salt", dealt("sq") * width + F.col("k"))
        places_ = places_.join(hot, "bucket", "left").withColumn("k", every("sq")).withColumn("salt", F.col("k") * width + dealt("sv"))
        both = asks.union(places_).select("bucket", "salt", "role", "h", "v")
    both = both.repartition(partitions(df.sparkSession), "bucket", "salt").sortWithinPartitions("bucket", "salt", "role", "h")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, who, what = None, [], []  # the open bucket's queries
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            b, salt, role, h = (batch.column(c).to_numpy() for c in ("bucket", "salt", "role", "h"))
            if not len(b):
                continue
            v = np.frombuffer(b"".join(batch.column("v").to_pylist()), real).reshape(-1, dimension).astype(np.float64)
            edges = np.flatnonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (salt[1:] != salt[:-1]) | (role[1:] != role[:-1]), [True]]))
            for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if (b[a], salt[a]) != bucket:
                    bucket, who, what = (b[a], salt[a]), [], []
                if role[a] == 0:
                    who.append(h[a:z])
                    what.append(v[a:z])
                elif who:
                    asked, q = np.concatenate(who), np.concatenate(what)
                    for s in range(a, z, CHUNK):
                        x, ids = v[s : min(z, s + CHUNK)], h[s : min(z, s + CHUNK)]
                        top = min(k + 1, len(ids))
                        for f in range(0, len(q), ASKED):
                            part = q[f : f + ASKED]
                            sides = np.sqrt((part * part).sum(1)), np.sqrt((x * x).sum(1))
                            like = (part @ x.T) / (sides[0][:, None] * sides[1][None, :])
                            best = np.argpartition(-like, top - 1, 1)[:, :top]
                            # Others that tie with the last one kept may hold smaller ids.
                            floor = np.take_along_axis(like, best, 1).min(1)
                            i, j = np.nonzero(like >= floor[:, None] - SLACK)
                            # A product of matrices sums in an order of its own; a kept pair's sum is the same in any task.
                            held.append((asked[f + i], ids[j], (part[i] * x[j]).sum(1) / (sides[0][i] * sides[1][j])))
                            size += len(i)
                            if size > MERGED:
                                held = [_best(held, k)]
                                size = len(held[0][0])
                                if size > MERGED // 2:
                                    yield _rows(held[0])
                                    held, size = [], 0
        if held:
            yield _rows(_best(held, k))

    def _rows(x: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in x], names=["q", "h", "score"])

    found = both.mapInArrow(compare, "q long, h long, score double").groupBy("q", "h").agg(F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    listed = found.join(classes.select("h", "ids"), "h").select("q", "score", F.explode("ids").alias("id")).withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).select(F.col("q").alias("h"), "score", F.col("id").alias("other"))
    each = queries.join(listed, "h").filter("id <> other").withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "other")).cast("int")).filter(F.col("rank") <= k)
    return each.select(F.col("id").alias("query_id"), "rank", F.col("other").alias(key), "score")


def _best(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query, the candidates that are among its k + 1 best or tie with the last of them."""
    q, h, s = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((h, -s, q))
    q, h, s = q[order], h[order], s[order]
    _, first = np.unique(np.stack([q, h], 1), axis=0, return_index=True)
    kept = np.sort(first)
    q, h, s = q[kept], h[kept], s[kept]
    start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    count = np.diff([*start, len(q)])
    last = np.repeat(s[start + np.minimum(count, k + 1) - 1], count)
    good = s >= last
    return q[good], h[good], s[good]
