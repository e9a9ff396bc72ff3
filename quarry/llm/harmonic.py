"""Harmonic packing: documents cut into lengths of reciprocal classes, each class with a fixed number of pieces a sequence.

The classes are the whole parts of capacity / 1, capacity / 2, capacity / 3 and so on; below the square root of the
capacity they are all lengths there are. A sequence of the class of length L holds capacity // L pieces of it, so its
padding is known beforehand (under 1.6 % of 4096 for any class, none at a power of two), and so is the place of each
piece once its number in its class is known: no worker looks at another worker's pieces.

1. Each text is tokenized once and cut: pieces of the whole capacity, and the rest by a table of cuts that has the fewest
   padding tokens, counting each further piece as CUT of them (a dynamic programme over the rests, made once).
2. Pieces are numbered within their task and class as they are made. What is summed up is one row a task and class; its
   running sums turn these numbers into gapless ones of the class. Pieces themselves meet no others.
3. A class's pieces fill whole sequences, by division. Fewer than a sequence's number are left of each class: at most
   capacity // L of it, whatever the input. They are put together from the longest to the shortest, into sequences of
   the capacity while there is enough, then of powers of two, which aren't padded; the last may have padding.

Defined results: null and empty texts are a document of the end id alone; very long texts are cut into pieces of the
capacity and a rest; repeated rows and null keys are documents of their own; an empty table gives an empty result;
columns that aren't named are ignored, whatever their names; the key's own name must not be one of the result's.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import bound_batches, materialize, tidy
from .tokens import WordTokenizer, tokenizer

#: Padding tokens that one more piece is worth.
CUT = 1.0
#: Columns of the result beside the key.
RESULT = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def classes(capacity: int) -> list[int]:
    """The lengths of the classes, descending."""
    return sorted({capacity // k for k in range(1, capacity + 1)}, reverse=True)


def cuts(capacity: int, cut: float = CUT) -> np.ndarray:
    """For each rest below the capacity (from 1) the length of its first piece, in the cheapest way to cut it."""
    lengths = np.array(classes(capacity)[1:], np.int64)
    price = (capacity - capacity // lengths * lengths) / (capacity // lengths) + cut
    cost, first = np.zeros(capacity), np.zeros(capacity, np.int64)
    for rest in range(1, capacity):
        fits = lengths <= rest
        each = price[fits] + cost[rest - lengths[fits]]
        k = int(each.argmin())  # of equally cheap ones the longest
        cost[rest], first[rest] = each[k], lengths[fits][k]
    return first


def pieces(n: int, capacity: int, first: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of n tokens, from the longest on."""
    start = 0
    while n - start >= capacity:
        yield start, capacity
        start += capacity
    while start < n:
        length = int(first[n - start])
        yield start, length
        start += length


def together(left: dict[int, int], capacity: int) -> list[list[int]]:
    """What is left of the classes (length: number) as sequences: lists of lengths."""
    left, out, room = dict(left), [], capacity
    while tokens := sum(length * n for length, n in left.items()):
        room = min(room, 1 << (tokens.bit_length() - 1)) if tokens < capacity else capacity
        while True:
            taken, free = [], room
            for length in sorted(left, reverse=True):
                n = min(left[length], free // length)
                taken += [length] * n
                free -= n * length
            if taken and (not free or room == capacity):
                break
            if room <= 1 or not taken:  # no power of two can be made of them: one padded sequence
                taken = [length for length in sorted(left, reverse=True) for _ in range(left[length])]
                break
            room >>= 1
        for length in taken:
            left[length] -= 1
        out.append(taken)
    return out


class Plan:
    """Where the k-th piece of each class goes: sequence and offset."""

    def __init__(self, totals: dict[int, int], capacity: int) -> None:
        #: Runs of what is left, by class and number: class, first number, sequence, offset.
        self.full, runs, sequence = {}, [], 0
        left: dict[int, int] = {}
        for length, n in sorted(totals.items(), reverse=True):
            per = capacity // length
            self.full[length] = (sequence, n // per * per, per)
            sequence += n // per
            left[length] = n % per
        used = {length: self.full[length][1] for length in left}
        for taken in together(left, capacity):
            at = 0
            for length in taken:
                runs.append((length, used[length], sequence, at))
                used[length] += 1
                at += length
            sequence += 1
        self.sequences = sequence
        self.runs = np.array(sorted(runs), np.int64).reshape(-1, 4)

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = np.array(sorted(self.full), np.int64)
        base, whole, per = np.array([self.full[x] for x in known.tolist()], np.int64).reshape(-1, 3)[np.searchsorted(known, length)].T
        sequence, offset = base + rank // per, rank % per * length
        late = np.flatnonzero(rank >= whole)
        if len(late):
            at = np.searchsorted(self.runs[:, 0] << 40 | self.runs[:, 1], length[late] << 40 | rank[late])
            sequence[late], offset[late] = self.runs[at, 2], self.runs[at, 3]
        return sequence, offset


def cut_texts(df: DataFrame, vocabulary: str, capacity: int, end: int, key: str, text: str, cut: float = CUT) -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens, and each piece's task and number within task and class; written."""
    bound_batches(df.sparkSession)
    names = ["key", *RESULT[:4], "task", "number"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, first, task = tokenizer(WordTokenizer, vocabulary), cuts(capacity, cut), TaskContext.get().partitionId()
        tail = np.array([end], tok.width).tobytes()
        met: dict[int, int] = {}
        for batch in batches:
            rows, out = array("q"), array("q")
            for i, x in enumerate(batch.column(1)):
                ids = np.frombuffer(tok.encode(x.as_py() or "") + tail, tok.width).astype("<u4")
                for start, length in pieces(len(ids), capacity, first):
                    number = met.get(length, 0)
                    met[length] = number + 1
                    rows.append(i)
                    out.extend((start, length, zlib.crc32(ids[start : start + length]), len(ids), number))
            start, length, crc, tokens, number = (pa.array(np.ascontiguousarray(c)) for c in np.array(out, np.int64).reshape(-1, 5).T)
            columns = [batch.column(0).take(pa.array(np.array(rows, np.int64))), start, length, crc, tokens, pa.array(np.full(len(rows), task, np.int32)), number]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    longs = [T.StructField(c, T.LongType()) for c in RESULT[:4]]
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), *longs, T.StructField("task", T.IntegerType()), T.StructField("number", T.LongType())])
    return materialize(df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(tidy(run), schema))


def pack(df: DataFrame, vocabulary: str, capacity: int = 4096, end: int = 2, key: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row a piece. cut: padding tokens that one more
    piece is worth; more makes fewer pieces."""
    if key in RESULT:
        raise ValueError(f"rename the key column first: {key} is a column of the result")
    parts = cut_texts(df, vocabulary, capacity, end, key, text, cut)
    counts = parts.groupBy("task", "length").agg(F.count("*").alias("n"))  # a row a task and class
    plan = Plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)  # a row a class
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    of_task = shifts.groupBy("task").agg(F.map_from_entries(F.collect_list(F.struct("length", "shift"))).alias("shifts"))  # as many entries as classes
    ranked = parts.join(of_task, "task").select("key", *RESULT[:4], (F.col("number") + F.col("shifts")[F.col("length")]).alias("rank"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = plan.places(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, places)], names=["key", *RESULT])

    schema = T.StructType([parts.schema["key"], *(T.StructField(c, T.LongType()) for c in RESULT)])
    return ranked.mapInArrow(tidy(run), schema).withColumnRenamed("key", key)
