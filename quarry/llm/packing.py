"""Best-fit packing by linear grouping.

The sizes of all pieces are whole numbers up to the capacity, so the packing is planned on their histogram, which is
no larger for 100 TB:

1. Large sizes are cut into groups of equal cardinality and rounded up to each group's largest.
2. Configurations, multisets of few rounded sizes that fit a sequence, are optimised: the linear programme that covers
   all groups with as few sequences as it can is solved by column generation (a knapsack prices new configurations),
   and each configuration is used as often as the whole part of its share says.
3. Actual documents take the slots, largest first; the last slot takes the best-fitting document that is left.
4. What is left, the small sizes above all, goes best-fit in descending order into the gaps and then into new sequences.

The plan is made for each number of groups in GROUPS, and once by step 4 alone, and the one of fewest sequences is
kept (of equal ones, one by groups), so it is never worse than best-fit decreasing.

The plan is a list of runs: of the pieces of one size, ranks r to r + n go to sequences s to s + n at one offset. Pieces
are ranked by size without gathering any size in one task, and each finds its run by a search in the plan, whose size
depends on the capacity alone.

Defined results: null and empty texts are a document of the end id alone; very long texts are cut into whole pieces,
the first one shorter; repeated rows are documents of their own; equal sizes are taken in order of key and piece; an
empty table gives an empty result; columns that aren't named are ignored, whatever their names; the key's own name
must not be one of the result's.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import bound_batches, materialize, tidy, with_ranks
from .tokens import ByteTokenizer, tokenizer

#: Numbers of groups of large sizes to plan with, and the size from which a piece is large, as a share of the capacity.
GROUPS, LARGE = (16, 32, 48), 1 / 8
#: Columns of the result beside the key.
RESULT = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")
#: Rounds of column generation at most; each improves the programme's value, and any round's solution is a valid one.
ROUNDS = 2000


@dataclass
class Plan:
    """Runs: (size, first rank, number, first sequence, offset)."""

    capacity: int
    sequences: int = 0
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)


def group(histogram: dict[int, int], capacity: int, groups: int) -> list[tuple[int, int]]:
    """(rounded size, cardinality) of groups of large sizes, of as equal cardinality as whole sizes allow, ascending."""
    large = sorted(s for s, n in histogram.items() if capacity * LARGE < s < capacity and n > 0)
    per = -(-sum(histogram[s] for s in large) // groups)
    out, held = [], 0
    for s in large:
        held += histogram[s]
        if held >= per or s == large[-1]:
            out.append((s, held))
            held = 0
    return out


def knapsack(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits: its value, and how often each size is in it."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.array(sizes)
    for room in range(int(order.min()), capacity + 1):
        fits = order <= room
        gain = np.where(fits, best[np.maximum(room - order, 0)] + values, -1.0)
        i = int(gain.argmax())
        if gain[i] > best[room - 1]:
            best[room], last[room] = gain[i], i
        else:
            best[room], last[room] = best[room - 1], -1
    taken, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            taken[last[room]] += 1
            room -= sizes[last[room]]
    return float(best[capacity]), taken


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used (a real number) in a cover of all counts by fewest sequences.

    The revised simplex method: the basis begins with configurations of one size each; while the knapsack at the
    present prices finds a configuration worth more than a sequence, it enters and the one that runs out first leaves.
    """
    k = len(sizes)
    if not k:
        return []
    basis = np.diag([float(capacity // s) for s in sizes])
    demand = np.array(counts, float)
    for _ in range(ROUNDS):
        inverse = np.linalg.inv(basis)
        value, enter = knapsack(sizes, np.maximum(inverse.sum(0), 0.0), capacity)
        if value <= 1 + 1e-9:
            break
        share, use = inverse @ enter, inverse @ demand
        ratio = np.where(share > 1e-12, np.maximum(use, 0.0) / np.where(share > 1e-12, share, 1.0), np.inf)
        basis[:, int(ratio.argmin())] = enter
    use = np.linalg.solve(basis, demand)
    return [(basis[:, i].astype(np.int64), float(use[i])) for i in range(k) if use[i] > 1e-9]


class _Filling:
    """A plan under way: how many pieces of each size are left, and the sequences with a gap of each size, as ranges."""

    def __init__(self, histogram: dict[int, int], capacity: int) -> None:
        self.plan, self.gaps = Plan(capacity), {}
        self.left, self.used = np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)
        for s, n in histogram.items():
            self.left[s] = n

    def put(self, size: int, number: int, first: int, offset: int) -> None:
        self.plan.runs.append((size, int(self.used[size]), number, first, offset))
        self.used[size] += number
        self.left[size] -= number

    def leave(self, gap: int, first: int, number: int) -> None:
        if gap and number:
            self.gaps.setdefault(gap, []).append((first, number))

    def slots(self, groups: list[tuple[int, int]]) -> list[int]:
        """Actual sizes for a configuration's slots, given as ranges of sizes: the largest that is left in each, but
        for the last two, of which one is chosen such that what fits best of all beside it fills the sequence best."""
        free, room, chosen = self.left.copy(), self.plan.capacity, []
        for low, high in groups[:-2]:
            own = low + np.flatnonzero(free[low : min(high, room) + 1])
            if len(own):
                chosen.append(int(own[-1]))
                free[chosen[-1]] -= 1
                room -= chosen[-1]
        best = np.maximum.accumulate(np.where(free > 0, np.arange(len(free)), 0))  # the largest size up to each
        if len(groups) > 1:
            low, high = groups[-2]
            own = low + np.flatnonzero(free[low : min(high, room) + 1])
            if len(own):
                mate = best[room - own]
                mate = np.where((mate == own) & (free[own] < 2), best[np.maximum(own - 1, 0)], mate)
                k = int((len(own) - 1) - (own + mate)[::-1].argmax())  # of equally good ones the largest
                return [*chosen, int(own[k]), *([int(mate[k])] if mate[k] else [])]
        return [*chosen, int(best[room])] if best[room] else chosen

    def fill(self, chosen: list[int], most: int) -> int:
        """Puts pieces of these sizes into new sequences, at most so many; returns how many it were."""
        number = min(most, *(int(self.left[s]) // chosen.count(s) for s in chosen))
        at = 0
        for s in chosen:
            self.put(s, number, self.plan.sequences, at)
            at += s
        self.leave(self.plan.capacity - at, self.plan.sequences, number)
        self.plan.sequences += number
        return number

    def best_fit(self) -> Plan:
        """Puts all that is left, in descending order, each into the smallest gap that holds it."""
        for size in np.flatnonzero(self.left)[::-1].tolist():
            while todo := int(self.left[size]):
                gap = min((g for g in self.gaps if g >= size), default=None)
                if gap is None:
                    per = self.plan.capacity // size
                    self.fill([size] * min(per, todo), max(1, todo // per))
                    continue
                first, number = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap]
                take = min(number, todo)
                self.put(size, take, first, self.plan.capacity - gap)
                self.leave(gap - size, first, take)
                self.leave(gap, first + take, number - take)
        return self.plan


def plan_grouped(histogram: dict[int, int], capacity: int, groups: int) -> Plan:
    """Steps 1 to 4 with so many groups; 0: step 4 alone."""
    out = _Filling(histogram, capacity)
    found = group(histogram, capacity, groups) if groups else []
    rounded = [s for s, _ in found]
    ranges = [(low + 1, high) for low, high in zip([int(capacity * LARGE), *rounded], rounded, strict=False)]
    for taken, use in sorted(configurations(rounded, [n for _, n in found], capacity), key=lambda x: -x[1]):
        wanted = [ranges[i] for i in range(len(taken)) for _ in range(int(taken[i]))][::-1]  # largest first
        most = capacity - sum(high for _, high in wanted)  # the gap that the rounded sizes leave
        todo = int(use)
        while todo and (chosen := out.slots(wanted)) and capacity - sum(chosen) <= most:
            todo -= out.fill(chosen, todo)
    return out.best_fit()


def plan(histogram: dict[int, int], capacity: int, groups: tuple[int, ...] = GROUPS) -> Plan:
    """Packs pieces of these sizes (1 to capacity)."""
    return min((plan_grouped(histogram, capacity, g) for g in (*groups, 0)), key=lambda p: p.sequences)


def pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens: all of capacity but the first."""
    first = n % capacity or capacity
    return [(0, min(n, first)), *((s, capacity) for s in range(first, n, capacity))]


def cut(df: DataFrame, vocabulary: str, capacity: int, end: int, key: str, text: str) -> DataFrame:
    """key, piece, start, length, ids_crc32, written to the shared folder: every text is tokenized once."""
    bound_batches(df.sparkSession)
    kind = df.schema[key].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(ByteTokenizer, vocabulary)
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            rows, out = array("q"), array("q")  # the row of each piece, and its place, start, length and checksum
            for i, x in enumerate(batch.column(1)):
                ids = tok.encode(x.as_py() or "") + tail
                for k, (start, length) in enumerate(pieces(len(ids) // 4, capacity)):
                    rows.append(i)
                    out.extend((k, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])))
            k, start, length, crc = np.array(out, np.int64).reshape(-1, 4).T
            columns = [pa.array(k.astype(np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in (start, length, crc))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.array(rows, np.int64))), *columns], names=["key", "piece", "start", "length", "ids_crc32"])

    schema = T.StructType([T.StructField("key", kind), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))])
    return materialize(df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(tidy(run), schema))


def pack(df: DataFrame, vocabulary: str, capacity: int = 1024, end: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id, offset."""
    if key in RESULT:
        raise ValueError(f"rename the key column first: {key} is a column of the result")
    parts = cut(df, vocabulary, capacity, end, key, text)
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    made = plan(histogram, capacity)
    runs = sorted(made.runs)
    size, rank, _, first, offset = (np.array(x, np.int64) for x in (zip(*runs, strict=True) if runs else [[]] * 5))
    ranked = with_ranks(parts, ["length"], ["key", "piece", "start"], "rank")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = size << 44 | rank
        for batch in batches:
            asked = batch.column("rank").to_numpy()
            i = np.searchsorted(order, batch.column("length").to_numpy() << 44 | asked, "right") - 1
            columns = [*(batch.column(c) for c in ("key", *RESULT[:4])), pa.array(first[i] + asked - rank[i]), pa.array(offset[i])]
            yield pa.RecordBatch.from_arrays(columns, names=["key", *RESULT])

    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(tidy(run), schema).withColumnRenamed("key", key)
