"""Exact substring dedup by the common-prefix intervals of suffix arrays.

A byte is repeated if some string of ``least`` bytes that covers it starts anywhere else in the corpus. Suffixes are
dealt over the cluster so that equal windows of ``least`` bytes always meet, without shuffling all windows: of the
64-byte grams in a window the leftmost of smallest hash is its anchor, a function of the window's bytes alone. The
windows of one anchor lie side by side, at most least - gram + 1 of them; they and the bytes that they reach are a tile,
of less than twice ``least`` bytes. Only anchors whose gram occurs
elsewhere matter, tiles that are equal as a whole are known to repeat, and of the rest one copy of each different tile
goes, with the other tiles of its gram, to one task.

There the windows' suffixes are grouped by their first ``least`` bytes. A group whose members all extend to the left
by the same byte is no maximal repeat and what it covers is covered by the extended one, so only left-diverse groups
are sorted into a suffix array with common-prefix lengths. A scan with a stack yields the tree of its common-prefix
intervals; each left-diverse interval is a maximal repeat with all its occurrences, and each suffix is covered as far
as the deepest interval that holds it.

Hot groups: copies of a whole text take part once a task and are known to repeat; grams that occur often are dealt
over several tasks (a gram that isn't among the AT_MOST most frequent ones has less than 1 / AT_MOST of all rows); grams
with very many different tiles are told window by window, by counts of two 64-bit hashes of each window.

Texts are known by a 64-bit hash; a second one is held against it, and texts that differ in it take it as their id. So
texts are told apart by 128 bits, and tiles by the 128 bits of their gram's and their own hash.

``rewritten`` gives text, so it removes whole characters only: a run that begins or ends within a character leaves that
character as it is. Texts of which nothing but white space is left go. Defined results: null and empty texts and texts under ``least`` bytes have no
repeats; very long texts are treated whole; equal texts and repeated rows of ``least`` bytes are removed whole, all of
them; null keys are kept as they are; an empty table gives an empty result; other columns are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import KeyFilter, bound_batches, materialize, partitions, tidy
from .words import U, mix

LEAST, GRAM = 200, 64
#: A gram is frequent from this count (at most so many, the most frequent first), and its rows a task.
FREQUENT, AT_MOST, DEALT = 2048, 100_000, 4096
#: Different tiles of one gram that are sorted in one task; beyond, windows are counted.
SORTED = 20_000
#: Bytes of texts or tiles looked at together.
TOGETHER = 1 << 18

_BYTE = np.random.default_rng(5).integers(0, 2**64, 256, dtype=np.uint64) | U(1)
_OTHER = np.random.default_rng(6).integers(0, 2**64, 256, dtype=np.uint64) | U(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def window_hashes(data: np.ndarray, k: int, table: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of the k bytes at each place, from hashes of half the size."""
    if len(data) < k:
        return np.zeros(0, np.uint64)
    whole, size = None, 0
    part, n = table[data], 1
    while True:
        if k & n:
            whole = part if whole is None else whole[: len(data) - size - n + 1] * U(pow(_BASE, n, 1 << 64)) + part[size : len(data) - n + 1]
            size += n
        if size == k:
            return mix(whole)
        part = part[: len(part) - n] * U(pow(_BASE, n, 1 << 64)) + part[n:]
        n *= 2


def stretch_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start to its end."""
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(data), U(_BASE))]), dtype=np.uint64)
    back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(data), U(_INVERSE))]), dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power[:-1], dtype=np.uint64)])
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def tiles(texts: list[bytes], least: int = LEAST, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Of all texts: text (its place in the list), start and n (of windows), gram and tile (hashes)."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    none = {c: np.zeros(0, np.int64) for c in ("text", "start", "n", "gram", "tile")}
    if len(data) < least:
        return none
    hashes = window_hashes(data, gram)
    mask = U((1 << 40) - 1)
    low = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)  # ties go to the leftmost
    width, n = least - gram + 1, 1
    while n * 2 <= width:
        low, n = np.minimum(low[:-n], low[n:]), n * 2
    if n < width:
        low = np.minimum(low[: len(low) - (width - n)], low[width - n :])
    full = sizes >= least
    change = np.zeros(len(data) + 2, np.int32)
    np.add.at(change, (ends - sizes)[full], 1)
    np.add.at(change, ends[full] - least + 1, -1)
    at = np.flatnonzero(np.cumsum(change)[: len(low)] > 0)
    if not len(at):
        return none
    anchor = (low[at] & mask).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]))
    start = at[begins]
    count = np.diff([*begins, len(at)])
    text = np.searchsorted(ends, start, "right")
    return {"text": text, "start": start - (ends - sizes)[text], "n": count, "gram": hashes[anchor[begins]].view(np.int64), "tile": stretch_hashes(data, start, start + count - 1 + least).view(np.int64)}


#: Ids shared by different texts that the driver holds at most: at 3e10 texts some 25 are expected.
CLASHES = 10_000


def identified(df: DataFrame, text: Column, least: int) -> tuple[Column, DataFrame]:
    """An id of each text as a Column, and id, c, length of the texts of ``least`` bytes that occur several times."""
    said = F.coalesce(text, F.lit(""))
    first, second = F.xxhash64(said), F.xxhash64(F.lit(1), said)
    sizes = df.select(first.alias("id"), second.alias("second"), F.octet_length(said).alias("size")).filter(F.col("size") >= least)
    told = [F.count("*").alias("c"), F.max("size").alias("length")]
    copies = materialize(sizes.groupBy("id").agg(*told, (F.min("second") != F.max("second")).alias("clash")).filter("c > 1"), few=True)
    clashes = [r["id"] for r in copies.filter("clash").select("id").limit(CLASHES + 1).collect()]
    if len(clashes) > CLASHES:
        raise ValueError("too many different texts share a 64-bit hash")
    if not clashes:
        return first, copies.select("id", "c", "length")
    own = F.when(first.isin(clashes), second).otherwise(first)
    again = sizes.withColumn("id", F.when(F.col("id").isin(clashes), F.col("second")).otherwise(F.col("id")))
    return own, again.groupBy("id").agg(*told).filter("c > 1")


def _tile_rows(df: DataFrame, least: int, counts: dict[int, int] | None) -> DataFrame:
    """gram and, with counts, also salt (-1: not frequent), tile, id, start, n. A task takes equal texts once."""
    often = np.array(sorted(counts or ()), np.int64)
    parts = np.array([-(-counts[g] // DEALT) for g in often.tolist()], np.int64) if counts else np.zeros(0, np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, texts, size = [], [], 0
            last = batch.num_rows - 1
            for i, (h, x) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                if h not in seen:
                    seen.add(h)
                    raw = x.as_buffer()
                    if raw is not None and raw.size >= least:
                        ids.append(h)
                        texts.append(raw.to_pybytes())
                        size += raw.size
                if texts and (size >= TOGETHER or i == last):
                    yield _cut(np.array(ids, np.int64), texts)
                    ids, texts, size = [], [], 0

    def _cut(ids: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
        t = tiles(texts, least)
        if counts is None:
            return pa.RecordBatch.from_arrays([pa.array(t["gram"])], names=["gram"])
        own, start = ids[t["text"]], t["start"]
        salt = np.full(len(own), -1, np.int64)
        if len(often):
            k = np.minimum(np.searchsorted(often, t["gram"]), len(often) - 1)
            hit = often[k] == t["gram"]
            salt[hit] = (mix(own[hit].view(np.uint64) + start[hit].astype(np.uint64)) % parts[k[hit]].astype(np.uint64)).astype(np.int64)
        columns = [t["gram"], salt.astype(np.int32), t["tile"], own, start.astype(np.int32), t["n"].astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "salt", "tile", "id", "start", "n"])

    schema = "gram long" if counts is None else "gram long, salt int, tile long, id long, start int, n int"
    return df.select("id", F.col("text").cast("binary").alias("text")).mapInArrow(tidy(run), schema)


def _frequent(df: DataFrame, least: int) -> dict[int, int]:
    counts = _tile_rows(df, least, None).groupBy("gram").agg(F.count("*").alias("c"))
    top = counts.filter(F.col("c") >= FREQUENT).orderBy(F.desc("c"), "gram").limit(AT_MOST).toPandas()
    return dict(zip(top["gram"].tolist(), top["c"].tolist(), strict=True))


_MET = ("gram", "salt", "tile", "id", "start", "n")


def _met(rows: DataFrame) -> DataFrame:
    """kind, gram, id, start, n: kind 0, tiles that occur elsewhere as a whole; kind 1, one of each different tile of a
    gram that has several. Rows come sorted by gram, salt and tile and are looked at as they stream."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list | None = None  # the last row, whether its tile came before
        seen, pending = 0, None  # different tiles of the open run, and the first of them while it is alone
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {k: batch.column(k).to_numpy() for k in _MET}
            if last is not None:
                c = {k: np.concatenate([np.array([x], v.dtype), v]) for (k, v), x in zip(c.items(), last[:6], strict=True)}
            new = np.ones(len(c["gram"]), bool)
            new[1:] = (c["id"][1:] != c["id"][:-1]) | (c["start"][1:] != c["start"][:-1]) | (c["tile"][1:] != c["tile"][:-1]) | (c["gram"][1:] != c["gram"][:-1])
            c = {k: v[new] for k, v in c.items()}
            size = len(c["gram"])
            run_on = np.zeros(size, bool)
            run_on[1:] = (c["gram"][1:] == c["gram"][:-1]) & (c["salt"][1:] == c["salt"][:-1])
            again = np.zeros(size, bool)
            again[1:] = run_on[1:] & (c["tile"][1:] == c["tile"][:-1])
            cover = again.copy()
            cover[:-1] |= again[1:]
            if last is not None:
                cover[0] |= last[6]
            out = [np.flatnonzero(cover[:-1])]
            # One of each tile; the carried row was looked at before.
            first = ~again
            if last is not None:
                first[0] = False
            run_id = np.cumsum(~run_on) - 1
            per = np.bincount(run_id, first, int(run_id[-1]) + 1).astype(np.int64)
            if last is not None:
                per[0] += seen
            told = first & ((c["salt"] >= 0) | (per[run_id] >= 2))
            extra = []
            if last is not None and pending is not None and per[0] >= 2:
                extra.append(pending)
                pending = None
            if int(run_id[-1]) > 0 or last is None:
                pending = None
            seen = int(per[-1])
            if seen == 1 and c["salt"][-1] < 0 and pending is None:
                own = np.flatnonzero(first & (run_id == run_id[-1]))
                if len(own):
                    pending = [int(c[k][own[0]]) for k in _MET]
            last = [*(int(c[k][-1]) for k in _MET), bool(again[-1] or (size == 1 and cover[-1]))]
            yield _rows(c, out[0], np.flatnonzero(told), extra)
        if last is not None and last[6]:
            yield _rows({k: np.array([x]) for k, x in zip(_MET, last[:6], strict=True)}, np.array([0]), np.zeros(0, np.int64), [])

    def _rows(c: dict[str, np.ndarray], cover: np.ndarray, rep: np.ndarray, extra: list[list]) -> pa.RecordBatch:
        both = np.concatenate([cover, rep]).astype(np.int64)
        kind = np.concatenate([np.zeros(len(cover), np.int32), np.ones(len(rep) + len(extra), np.int32)])
        columns = [np.concatenate([c[k][both].astype(np.int64), np.array([x[_MET.index(k)] for x in extra], np.int64)]) for k in ("gram", "id", "start", "n")]
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())], names=["kind", "gram", "id", "start", "n"])

    dealt = rows.repartition(partitions(rows.sparkSession), "gram", "salt").sortWithinPartitions("gram", "salt", "tile", "id", "start")
    return materialize(dealt.mapInArrow(tidy(run), "kind int, gram long, id long, start int, n int"), release=True)


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of each common-prefix interval of at least ``least``, deepest first; lcp[i] is the common
    prefix of suffixes i - 1 and i of a suffix array."""
    stack = [(0, 0)]  # length, first
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else 0
        first = i - 1
        while stack[-1][0] > now:
            length, first = stack.pop()
            if length >= least:
                yield length, first, i - 1
        if stack[-1][0] < now:
            stack.append((now, first))


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax())


def maximal_repeats(stretches: list[bytes], starts: list[int], least: int = LEAST) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, occurrences as (stretch, place)) of each left-diverse common-prefix interval of the suffixes that begin
    in the first starts[i] places of stretch i. A suffix at place 0 counts as diverse to the left."""
    lengths = np.array([len(x) for x in stretches])
    base = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(stretches), np.uint8)
    hashes = window_hashes(data, least)
    many = np.array(starts)
    owner = np.repeat(np.arange(len(stretches)), many)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    if not len(owner):
        return
    _, group, size = np.unique(hashes[base[owner] + place], return_inverse=True, return_counts=True)
    before = np.where(place > 0, np.concatenate([[-1], group[:-1]]), -1)
    order = np.argsort(group, kind="stable")
    edge = np.concatenate([[0], np.cumsum(size)])[:-1]
    same = (np.minimum.reduceat(before[order], edge) == np.maximum.reduceat(before[order], edge)) & (np.minimum.reduceat(before[order], edge) >= 0)
    for g in np.flatnonzero((size >= 2) & ~same).tolist():
        own = order[edge[g] : edge[g] + size[g]]
        suffixes = sorted((stretches[i][p:], i, p) for i, p in zip(owner[own].tolist(), place[own].tolist(), strict=True))
        lcp = [0, *(_common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:], strict=False))]
        left = [stretches[i][p - 1] if p else -1 - k for k, (_, i, p) in enumerate(suffixes)]
        for length, first, last in intervals(lcp, least):
            if len(set(left[first : last + 1])) > 1:
                yield length, [(i, p) for _, i, p in suffixes[first : last + 1]]


def covered(stretches: list[bytes], starts: list[int], least: int = LEAST) -> list[list[tuple[int, int]]]:
    """Of each stretch, what maximal repeats cover: (place, length), the longest from each place."""
    out: list[dict[int, int]] = [{} for _ in stretches]
    for length, found in maximal_repeats(stretches, starts, least):
        for i, p in found:
            if length > out[i].get(p, 0):
                out[i][p] = length
    return [sorted(x.items()) for x in out]


def _sorted_tiles(texts: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """id, start, length covered by maximal repeats among the tiles of each gram."""
    big = reps.groupBy("gram").agg(F.count("*").alias("c")).filter(F.col("c") > SORTED).select("gram", F.lit(True).alias("big"))
    asked = reps.join(big, "gram", "left").groupBy("id").agg(F.collect_list(F.struct("gram", "start", "n", F.coalesce("big", F.lit(False)).alias("big"))).alias("asked"))
    held = texts.dropDuplicates(["id"]).join(asked, "id").select("id", F.col("text").cast("binary").alias("text"), "asked")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for h, text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                out += [(x["gram"], h, x["start"], x["n"], x["big"], text[x["start"] : x["start"] + x["n"] - 1 + least]) for x in asked]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()), strict=True)], names=["gram", "id", "start", "n", "big", "tile"])

    rows = held.mapInArrow(tidy(cut), "gram long, id long, start int, n int, big boolean, tile binary")
    spans = "id long, start int, length int"

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, gram = 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "id", "start", "n", "tile")), strict=True):
                if row[0] != gram:
                    gram = row[0]
                    if size >= TOGETHER:
                        yield _scanned(held)
                        held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield _scanned(held)

    def _scanned(held: list[tuple]) -> pa.RecordBatch:
        found = covered([x[4] for x in held], [x[3] for x in held], least)
        out = [(x[1], x[2] + p, n) for x, spans in zip(held, found, strict=True) for p, n in spans]
        columns = list(zip(*out, strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], names=["id", "start", "length"])

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[np.ndarray]] = [[], [], [], []]
            for h, s, n, tile in zip(*(batch.column(c).to_pylist() for c in ("id", "start", "n", "tile")), strict=True):
                raw = np.frombuffer(tile, np.uint8)
                found[0].append(window_hashes(raw, least).view(np.int64))
                found[1].append(window_hashes(raw, least, _OTHER).view(np.int64))
                found[2].append(np.full(n, h, np.int64))
                found[3].append(np.arange(s, s + n, dtype=np.int32))
            columns = [pa.array(np.concatenate([np.zeros(0, t), *x])) for x, t in zip(found, (np.int64, np.int64, np.int64, np.int32), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["window", "other", "id", "start"])

    rows = materialize(rows, release=True)
    few = rows.filter("NOT big").repartition(partitions(rows.sparkSession), "gram").sortWithinPartitions("gram").mapInArrow(tidy(scan), spans)
    if big.isEmpty():
        return few
    each = rows.filter("big").mapInArrow(tidy(windows), "window long, other long, id long, start int")
    twice = each.groupBy("window", "other").agg(F.count("*").alias("c")).filter("c > 1").select("window", "other")
    return few.union(each.join(twice, ["window", "other"]).select("id", "start", F.lit(least).alias("length")))


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Repeat groups with all their occurrences: group (long), length, key, start (bytes), one row an occurrence.

    A group is a maximal repeat within the tiles of one gram (a repeat that is longer than a tile comes as the chain of its
    tiles' groups). Equal tiles are sorted once and joined back, equal texts too, so copies cost no more than their rows.
    Of a gram with over SORTED different tiles the groups are the repeated strings of ``least`` bytes.
    """
    bound_batches(df.sparkSession)
    own, _ = identified(df, F.col(text), least)
    docs = materialize(df.select(F.col(key).alias("key"), own.alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    rows = materialize(_tile_rows(docs.select("id", "text"), least, {}).drop("salt").distinct())
    tiles_ = rows.groupBy("gram", "tile").agg(F.count("*").alias("c"), F.min(F.struct("id", "start", "n")).alias("r"))
    per = tiles_.groupBy("gram").agg(F.count("*").alias("different"))
    reps = materialize(tiles_.join(per.filter("different > 1"), "gram").select("gram", "tile", "r.*", (F.col("different") > SORTED).alias("big"), (F.col("c") > 1).alias("twice")))
    asked = reps.groupBy("id").agg(F.collect_list(F.struct("gram", "tile", "start", "n", "big", "twice")).alias("asked"))
    one = docs.select("id", "text").groupBy("id").agg(F.first("text").alias("text"))
    piece = F.expr(f"substring(cast(text as binary), a.start + 1, a.n - 1 + {least})")
    held = one.join(asked, "id").select("text", F.explode("asked").alias("a")).select("a.gram", "a.tile", "a.n", "a.big", piece.alias("bytes"), "a.twice")
    held = held.repartition(partitions(df.sparkSession), "gram").sortWithinPartitions("gram", "tile")

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, mine = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "tile", "n", "big", "bytes", "twice")), strict=True):
                if row[0] != gram:
                    if mine:
                        yield told(gram, mine)
                    gram, mine = row[0], []
                if row[3]:  # window by window; equal ones meet by their hashes
                    yield windows(*row[:5])
                else:
                    mine += [row] * (2 if row[5] else 1)  # a tile with copies repeats by itself
        if mine:
            yield told(gram, mine)

    def told(gram: int, mine: list[tuple]) -> pa.RecordBatch:
        found = list(maximal_repeats([x[4] for x in mine], [x[2] for x in mine], least))
        return record([(gram, k, length, tile, p) for k, (length, where) in enumerate(found) for tile, p in {(mine[i][1], p) for i, p in where}])

    def windows(gram: int, tile: int, n: int, big: bool, raw: bytes) -> pa.RecordBatch:
        hashes = window_hashes(np.frombuffer(raw, np.uint8), least, _OTHER).view(np.int64)[:n]
        return record([(gram, int(h), least, tile, p) for p, h in enumerate(hashes)])

    def record(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()), strict=True)], names=["gram", "number", "length", "tile", "place"])

    shared = held.mapInArrow(tidy(scan), "gram long, number long, length int, tile long, place int")
    lone = tiles_.filter("c > 1").join(per.filter("different = 1"), "gram")
    whole = lone.select("gram", F.lit(-1).cast("long").alias("number"), (F.col("r.n") - 1 + least).cast("int").alias("length"), "tile", F.lit(0).alias("place"))
    named = shared.withColumn("group", F.xxhash64("gram", "number")).union(whole.withColumn("group", F.xxhash64("gram", "number", "tile")))
    met = named.join(rows.select("gram", "tile", "id", "start"), ["gram", "tile"]).select("group", "length", "id", (F.col("start") + F.col("place")).alias("start"))
    every = met.join(docs.select("key", "id"), "id").select("group", "length", F.col("key").alias(key), "start")
    several = every.groupBy("group").agg(F.count("*").alias("_c")).filter("_c > 1").select("group")
    return every.join(several, "group")


def repeated(df: DataFrame, text: str = "text", least: int = LEAST) -> tuple[Column, DataFrame]:
    """The id of a text as a Column, and id and spans (array of start and length, bytes) of texts with repeated bytes."""
    bound_batches(df.sparkSession)
    own, copies = identified(df, F.col(text), least)
    docs = df.select(own.alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    met = _met(_tile_rows(docs, least, _frequent(docs, least)))
    whole = met.filter("kind = 0").select("id", "start", (F.col("n") - 1 + least).alias("length"))
    reps = met.filter("kind = 1")
    has_rep = KeyFilter(reps.select("id").distinct()).may_have(F.col("id"))
    more = _sorted_tiles(docs.filter(has_rep), reps, least)
    spans = copies.select("id", F.lit(0).alias("start"), "length").union(whole).union(more)
    return own, materialize(spans.groupBy("id").agg(F.collect_list(F.struct("start", "length")).alias("spans")), release=True, few=True)


def _united(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((x["start"], x["start"] + x["length"]) for x in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _whole_characters(text: bytes, a: int, b: int) -> tuple[int, int]:
    """The run from a to b without characters that it covers in part."""
    while a < b and text[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def _cutter(characters: bool, kept: str):
    """A UDF of texts (binary) and spans: what is kept, as binary or, less whole characters only, as string; and the runs removed."""

    @F.arrow_udf(f"struct<kept:{kept},removed:array<struct<start:int,length:int>>>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rest, gone = [], []
        for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            runs = _united(s or [])
            if characters:
                runs = [(a, b) for a, b in (_whole_characters(t, *x) for x in runs) if a < b]
            at, parts = 0, []
            for a, b in runs:
                parts.append(t[at:a])
                at = b
            raw = b"".join([*parts, t[at:]])
            rest.append(raw.decode("utf-8", "replace") if characters else raw)
            gone.append([{"start": a, "length": b - a} for a, b in runs])
        columns = [pa.array(rest, pa.string() if characters else pa.binary()), pa.array(gone, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))]
        return pa.StructArray.from_arrays(columns, names=["kept", "removed"])

    return cut.asNondeterministic()  # else filters behind it would call it once more


def _applied(df: DataFrame, text: str, least: int, characters: bool) -> DataFrame:
    """row (all columns of df), kept and removed. Texts without repeats aren't shuffled: a filter tells them apart."""
    own, found = repeated(df, text, least)
    said = F.coalesce(F.col(text), F.lit(""))
    kind = "string" if characters else "binary"
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), own.alias("id"), said.cast(kind).alias("raw"))
    touched = KeyFilter(found.select("id")).may_have(F.col("id"))
    hit = rows.filter(touched).join(found, "id", "left").select("row", _cutter(characters, kind)(F.col("raw").cast("binary"), F.col("spans")).alias("done"))
    none = F.array().cast("array<struct<start:int,length:int>>")
    free = rows.filter(~touched).select("row", F.col("raw").alias("kept"), none.alias("removed"))
    return hit.select("row", "done.kept", "done.removed").unionByName(free)


def deduplicate(df: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """df with kept (binary: the bytes that aren't repeated) and removed (array of start and length)."""
    if clash := {"kept", "removed"} & set(df.columns):
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    return _applied(df, text, least, False).select("row.*", "kept", "removed")


def rewritten(df: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """df with its texts less all repeated characters; texts of which nothing but white space is left go."""
    out = _applied(df, text, least, True).filter((F.size("removed") == 0) | (F.trim("kept") != ""))
    new = F.when(F.size("removed") > 0, F.col("kept")).otherwise(F.col("row")[text])  # null texts stay null
    return out.select(*(new.alias(c) if c == text else F.col("row")[c].alias(c) for c in df.columns))
