"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are normalised to lower-cased words joined by single spaces, as UTF-8 bytes. An item of more
than WINDOW bytes is looked for by overlapping windows. If a stretch of a text is within e edits of a window of m
bytes, the two share at least m - q + 1 - q * e of the window's q-grams, all of them on diagonals (place in the text
less place in the window) at most e apart. So the q-grams of a text that the benchmark has are counted in overlapping
bands of diagonals, bands that reach the count are kept, and each is verified by a banded alignment. An item is in a
text if matched windows cover at least COVER of it.

Items of fewer than q normalised bytes have no q-gram, and their budget allows no edit: a text holds them if it has their
words, whole and one after another.

The benchmark is the stated query set and is taken in blocks of bounded size: the driver holds the items and index of
PASS blocks at a time, which go to the workers with one pass over the texts, without a shuffle; what a pass finds is
written with the texts before the next. A benchmark of one pass (2 MB of items) needs no such table.

Defined results: null and empty texts and texts without words match nothing; null items and items without words are
never found; items of the same text are all reported; very long texts are searched whole; repeated rows are searched
each; an empty benchmark matches nothing; an empty table gives an empty result; items may have any type, null ids too;
a frame that has a column of the result's name is refused.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .shared import bound_batches, materialize, trim

Q = 10
#: Edits as a share of a window, its bytes and step, the share of an item that counts, and q-grams that a short window must share at least.
EDITS, WINDOW, STEP, COVER, LEAST = 0.08, 100, 50, 0.5, 6
#: Bytes of items a block, blocks a pass, and bytes of texts looked at together.
BLOCK, PASS, TOGETHER = 1 << 20, 2, 1 << 18
BAND = 32
TABLE_BITS = 22
WORD = re.compile(r"[^\W_]+")
GAP = 2 * Q
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def normal(text: str) -> bytes:
    return " ".join(WORD.findall(text)).lower().encode("utf-8", "replace")


def grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit code of the Q bytes at each place."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    a = data.astype(np.uint64)
    two = a[:-1] | a[1:] << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    eight = four[:-4] | four[4:] << np.uint64(32)
    return eight[:-2] * _K1 + (two[8:] * _K2 ^ two[8:] >> np.uint64(7))


@dataclass
class Segment:
    item: int  # place in the index's items
    start: int
    data: bytes
    edits: int
    least: int


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[object, str]]) -> None:
        self.items: list[tuple[object, int]] = []
        self.segments: list[Segment] = []
        self.short: defaultdict[bytes, list[Segment]] = defaultdict(list)
        for name, text in items:
            data = normal(text)
            n = len(data)
            if n < Q:
                if n:
                    self.short[data].append(Segment(len(self.items), 0, data, 0, 0))
                    self.items.append((name, n))
                continue
            starts = [0] if n <= WINDOW + STEP // 2 else [*range(0, n - WINDOW, STEP), n - WINDOW]
            for s in starts:
                own = data if len(starts) == 1 else data[s : s + WINDOW]
                m = len(own)
                e = max(0, min(int(EDITS * m), (m - Q + 1 - LEAST) // Q))
                self.segments.append(Segment(len(self.items), s, own, e, m - Q + 1 - Q * e))
            self.items.append((name, n))
        codes = [grams(np.frombuffer(s.data, np.uint8)) for s in self.segments]
        flat = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        segment = np.repeat(np.arange(len(codes)), [len(c) for c in codes]) if codes else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.segment, self.place = segment[order].astype(np.int32), place[order].astype(np.int32)
        self.lengths = sorted({x.count(b" ") + 1 for x in self.short})
        self.codes, self.first = np.unique(flat[order], return_index=True)
        self.count = np.diff([*self.first, len(flat)])
        self._mark()
        self.least = np.array([s.least for s in self.segments], np.int64)
        self.reach = max((len(s.data) + s.edits for s in self.segments), default=0)

    def _mark(self) -> None:
        """A table of the codes' leading bits, which a worker makes anew."""
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.codes >> np.uint64(64 - TABLE_BITS)] = True

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "table"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._mark()

    def exact(self, data: bytes) -> Iterator[tuple[int, int, Segment]]:
        """(start, end, segment) of each short item among the words of a text."""
        if not self.short:
            return
        words = data.split(b" ")
        begins = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
        for n in self.lengths:
            for i in range(len(words) - n + 1):
                for s in self.short.get(b" ".join(words[i : i + n]) if n > 1 else words[i], ()):
                    yield begins[i], begins[i + n] - 1, s

    def bands(self, data: np.ndarray) -> list[tuple[int, int]]:
        """(segment, lowest diagonal) of each band that holds enough q-grams."""
        if not len(self.codes):
            return []
        code = grams(data)
        at = np.flatnonzero(self.table[code >> np.uint64(64 - TABLE_BITS)])
        which = np.minimum(np.searchsorted(self.codes, code[at]), len(self.codes) - 1)
        same = self.codes[which] == code[at]
        at, which = at[same], which[same]
        need = int(self.least.min())
        if need > 1:  # hits that lie too thin for any segment
            if len(at) < need:
                return []
            close = np.flatnonzero(at[need - 1 :] - at[: len(at) - need + 1] <= self.reach)
            mark = np.zeros(len(at) + 1, np.int64)
            np.add.at(mark, close, 1)
            np.add.at(mark, close + need, -1)
            kept = np.cumsum(mark[:-1]) > 0
            at, which = at[kept], which[kept]
        if not len(at):
            return []
        n = self.count[which]
        entry = np.repeat(self.first[which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        segment, diagonal = self.segment[entry].astype(np.int64), np.repeat(at, n) - self.place[entry] + WINDOW * 4
        edits = np.array([s.edits for s in self.segments], np.int64)[segment]
        band = diagonal // BAND
        also = diagonal - band * BAND <= edits
        keys = np.concatenate([segment * (1 << 40) + band, (segment * (1 << 40) + band - 1)[also]])
        found, counts = np.unique(keys, return_counts=True)
        good = found[counts >= self.least[found >> 40]]
        return [(int(k >> 40), int(k & ((1 << 40) - 1)) * BAND - WINDOW * 4) for k in good]


def align(pattern: bytes, text: bytes, low: int, high: int, most: int, end: int | None = None) -> tuple[int, int] | None:
    """(edits, end in text) of the best alignment of pattern that begins on a diagonal from low to high, in a band of
    ``most`` more to each side; None beyond ``most`` edits. With ``end``, low and high are 0 and it begins right there.
    """
    width = high - low + 1 + 2 * most
    far = len(pattern) + most + 1
    base = low - most + (end or 0)  # column k of row i stands for place base + i + k
    padded = np.frombuffer(b"\0" * max(0, -base) + text[max(0, base) : base + len(pattern) + width + 1], np.uint8)
    padded = np.concatenate([padded, np.zeros(max(0, len(pattern) + width + 1 - len(padded)), np.uint8)])
    column = np.arange(width)
    place = base + column
    row = np.where((place >= 0) & (place <= len(text)), 0, far) if end is None else np.where(place == end, 0, far)
    if end is not None:
        row = np.minimum.accumulate(row - column) + column
    for i, c in enumerate(pattern):
        new = row + (padded[i : i + width] != c)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - column) + column
        if row.min() > most:
            return None
    place = base + len(pattern) + column
    row = np.where((place >= 0) & (place <= len(text)), row, far)
    k = int(row.argmin())
    return (int(row[k]), int(place[k])) if row[k] <= most else None


def search(index: Index, texts: list[str | None]) -> list[list[tuple[object, int, int, int]]]:
    """For each text (item, start, length, edits): spans in code points, edits summed over the windows of the span."""
    out: list[list[tuple[object, int, int, int]]] = [[] for _ in texts]
    data, held, size = [], [], 0
    for i, text in enumerate(texts):
        x = normal(text) if text else b""
        if len(x) >= Q or (x and index.short):
            data.append(x)
            held.append((i, size))
            size += len(x) + GAP
        if data and (size >= TOGETHER or i == len(texts) - 1):
            _search(index, texts, data, held, out)
            data, held, size = [], [], 0
    if data:
        _search(index, texts, data, held, out)
    return out


def _search(index: Index, texts: list[str | None], data: list[bytes], held: list[tuple[int, int]], out: list) -> None:
    flat = np.frombuffer((b"\0" * GAP).join(data) + b"\0" * GAP, np.uint8)
    begins = np.array([s for _, s in held])
    found: dict[int, dict[int, list[tuple[int, int, int, Segment]]]] = defaultdict(lambda: defaultdict(list))
    for k, x in enumerate(data):
        for a, b, s in index.exact(x):
            found[k][s.item].append((a, b, 0, s))
    for segment, low in index.bands(flat):
        s = index.segments[segment]
        # A band may reach into two texts that lie next to each other.
        for k in range(max(0, int(np.searchsorted(begins, low, "right")) - 1), len(held)):
            begin = held[k][1]
            if begin > low + BAND + s.edits:
                break
            got = align(s.data, data[k], low - begin, low - begin + BAND + s.edits, s.edits)
            if got:
                edits, end = got
                back = align(s.data[::-1], data[k][::-1], 0, 0, s.edits, len(data[k]) - end)
                start = len(data[k]) - back[1] if back else max(0, end - len(s.data))
                found[k][s.item].append((start, end, edits, s))
    for k, items in found.items():
        i = held[k][0]
        spans = _places(texts[i] or "")
        for item, hits in sorted(items.items()):
            name, n = index.items[item]
            covered = np.zeros(n, bool)
            for *_, s in hits:
                covered[s.start : s.start + len(s.data)] = True
            if covered.mean() < COVER:
                continue
            best: dict[tuple[int, int], int] = {}
            for a, b, e, _ in hits:
                best[a, b] = min(e, best.get((a, b), e))
            merged: list[list[int]] = []
            for (a, b), e in sorted(best.items()):
                if merged and a <= merged[-1][1]:
                    merged[-1] = [merged[-1][0], max(b, merged[-1][1]), merged[-1][2] + e]
                else:
                    merged.append([a, b, e])
            for a, b, e in merged:
                start, stop = spans(a, b)
                out[i].append((name, start, stop - start, e))


def _places(text: str):
    """From bytes of the normalised text to code points of the text."""
    ends, first, last, at = [], [], [], 0
    for m in WORD.finditer(text):
        at += len(m[0].lower().encode("utf-8", "replace")) + 1
        ends.append(at)
        first.append(m.start())
        last.append(m.end())
    edge = np.array(ends)

    def span(a: int, b: int) -> tuple[int, int]:
        i = min(int(np.searchsorted(edge, a, "right")), len(first) - 1)
        j = min(int(np.searchsorted(edge, max(a, b - 1), "right")), len(first) - 1)
        return first[i], last[j]

    return span


def blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int | None = None) -> Iterator[Index]:
    """The benchmark's indexes one after another, each of about block_bytes of items."""
    size = block_bytes or BLOCK
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // size)
    if n > 1:
        rows = rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int"))
        rows = materialize(rows.repartitionByRange("block").sortWithinPartitions("block"))  # so a block is few row groups
    for k in range(n):
        own = (rows.filter(F.col("block") == k) if n > 1 else rows).orderBy("item", "text").collect()
        yield Index([(r["item"], r["text"]) for r in own])


def _row(benchmark: DataFrame, item: str) -> T.ArrayType:
    fields = [T.StructField("item", benchmark.schema[item].dataType), *(T.StructField(c, T.IntegerType()) for c in ("start", "length", "edits"))]
    return T.ArrayType(T.StructType(fields))


def matches(text: Column, benchmark: DataFrame, item: str = "item_id", body: str = "text") -> Column:
    """array<struct<item, start, length, edits>>: where a text holds items, in code points of the text. The driver holds
    the whole benchmark's index; ``matched`` does not."""
    bound_batches(benchmark.sparkSession)
    row = _row(benchmark, item)
    parts = [_finder(index, row)(text) for index in blocks(benchmark, item, body)]
    return F.array_sort(F.concat(*parts)) if parts else F.array().cast(row)


def matched(df: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "matches", item: str = "item_id", body: str = "text") -> DataFrame:
    """df with ``name``: where each text holds items, as ``matches`` has it."""
    if name in df.columns:
        raise ValueError(f"rename this column first: {name}")
    row = _row(benchmark, item)
    out = df
    for k, finders in enumerate(_passes(benchmark, item, body)):
        before = [F.col(name)] if k else []
        if k:
            out = materialize(out, release=True)
        out = out.withColumn(name, F.concat(*before, *(f(F.col(text)) for f in finders)))
    return out.withColumn(name, F.array_sort(name) if name in out.columns else F.array().cast(row))


def _passes(benchmark: DataFrame, item: str, body: str) -> Iterator[list]:
    """UDFs that find the items of PASS blocks at a time."""
    bound_batches(benchmark.sparkSession)
    row, held = _row(benchmark, item), []
    for index in blocks(benchmark, item, body):
        held.append(_finder(index, row))
        if len(held) == PASS:
            yield held
            held = []
    if held:
        yield held


def _finder(index: Index, row: T.ArrayType):
    item = to_arrow_type(row.elementType["item"].dataType)

    @F.arrow_udf(row)
    def found(texts: pa.Array) -> pa.Array:
        hits = search(index, texts.to_pylist())
        trim()
        columns = list(zip(*(x for h in hits for x in h), strict=True)) or [[], [], [], []]
        fields = pa.StructArray.from_arrays([pa.array(columns[0], item), *(pa.array(c, pa.int32()) for c in columns[1:])], names=["item", "start", "length", "edits"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(h) for h in hits])]), pa.int32()), fields)

    return found


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of df whose text holds no item. Each pass reads what the one before it kept."""
    out = df
    for k, finders in enumerate(_passes(benchmark, "item_id", "text")):
        if k:
            out = materialize(out, release=True)
        out = out.filter(F.size(F.concat(*(f(F.col(text)) for f in finders))) == 0)
    return out
