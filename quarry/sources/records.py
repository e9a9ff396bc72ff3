"""Records of large files by byte ranges: a Spark data source for JSON lines and for files that are one JSON array each.

    spark.dataSource.register(RecordSource)
    spark.read.format("quarry_records").option("layout", "lines").load(path)

gives file, chunk, item, byte_offset, byte_length, sha256 and raw (bytes) of every record; a chunk is a byte range of a file
that one task reads, and owns the records that begin in it. A schema of fewer columns reads only these: digests are made
and bytes handed on only where they are asked for. ``records`` adds the number of each record in its file.

An array's chunks can't be read alone: whether a byte is inside a string, and how deep, depends on all bytes before. A
first pass tells for each chunk what it does to each of the three states of the automaton of strings and escapes (outside,
inside, after a backslash), and to the depth; one small row a chunk. These transitions are composed in order, so that
each chunk's state at its begin is known, and the second pass cuts elements in all chunks at once. A task holds its chunk
and the rest of the last record that begins there.

Files are opened by Arrow's file systems (local and shared folders, object stores, HDFS where its library is there);
``reaches`` tells whether they know a path. Blank lines aren't records. A byte order mark is no part of the first one.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes a chunk, of a further read to a record's end, and of a batch of records, read in order or by place.
CHUNK, MORE, BATCH = 64 << 20, 1 << 20, 8 << 20
BOM = b"\xef\xbb\xbf"
COLUMNS = "file string, chunk long, item long, byte_offset long, byte_length long, sha256 string, raw binary"
SCANNED = "file string, chunk long, exits array<int>, deltas array<long>, lows array<long>, tail int"
#: States of the automaton; what the last byte that isn't white space is: none, another one, a sign after which an
#: element may begin.
OUTSIDE, INSIDE, ESCAPED = range(3)
NOTHING, OTHER, OPENING = range(3)
SPACES = b" \t\r\n"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    local = re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in local else (fs.LocalFileSystem(), local)


def reaches(path: str) -> bool:
    """Whether Arrow's file systems know the path's store."""
    try:
        opened(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def listed(paths: list[str]) -> list[tuple[str, int]]:
    """Files (as Spark names them) and sizes under paths, sorted; hidden ones and those of marks are left out."""
    out = {}
    for path in paths:
        system, place = opened(path)
        prefix = "file:" if isinstance(system, fs.LocalFileSystem) else path.split("://", 1)[0] + "://"
        info = system.get_file_info(place)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(place, recursive=True))
        for x in found:
            below = x.path[len(place) :] if info.type != fs.FileType.File else ""
            if x.type == fs.FileType.File and not re.search(r"(^|/)[._]", below):
                out[prefix + x.path] = x.size
    return sorted(out.items())


# ---------------------------------------------------------------- what a chunk does to the automaton of an array


def unescaped_quotes(data: np.ndarray, state: int) -> tuple[np.ndarray, bool]:
    """Places of quotes that no backslash escapes, and whether a backslash at the end escapes what follows. In JSON
    backslashes stand in strings only, so a run of them escapes by its length alone."""
    quotes, slashes = np.flatnonzero(data == 34), np.flatnonzero(data == 92)
    if not len(slashes):
        return (quotes[1:] if state == ESCAPED and len(quotes) and quotes[0] == 0 else quotes), False
    first = np.concatenate([[True], np.diff(slashes) > 1])
    begins = slashes[first]
    lengths = np.diff(np.append(np.flatnonzero(first), len(slashes)))
    ends = begins + lengths
    if state == ESCAPED:
        if begins[0] == 0:  # the first backslash is itself escaped
            lengths[0] -= 1
        elif len(quotes) and quotes[0] == 0:
            quotes = quotes[1:]
    escaped = ends[lengths % 2 == 1]
    return quotes[~np.isin(quotes, escaped)], bool(len(escaped) and escaped[-1] == len(data))


def structure(data: np.ndarray, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of brackets, braces and commas outside strings, what each does to the depth, and the state at the end."""
    quotes, pending = unescaped_quotes(data, state)
    inside = state != OUTSIDE
    signs = np.flatnonzero((data == 91) | (data == 93) | (data == 123) | (data == 125) | (data == 44))
    signs = signs[(np.searchsorted(quotes, signs) + inside) % 2 == 0]
    kind = data[signs]
    step = np.where((kind == 91) | (kind == 123), 1, np.where(kind == 44, 0, -1))
    ends_inside = (len(quotes) + inside) % 2 == 1
    return signs, step, ESCAPED if ends_inside and pending else INSIDE if ends_inside else OUTSIDE


def scanned(data: bytes) -> tuple[list[int], list[int], list[int], int]:
    """For each state at the begin the one at the end, the change of depth and the least depth that a closing sign leads
    to, both as seen from the begin (of no closing sign a huge one); the kind of the last byte."""
    array = np.frombuffer(data, np.uint8)
    exits, deltas, lows = [], [], []
    for state in (OUTSIDE, INSIDE, ESCAPED):
        _, step, then = structure(array, state)
        exits.append(then)
        deltas.append(int(step.sum()))
        down = np.cumsum(step)[step < 0]
        lows.append(int(down.min()) if len(down) else 1 << 62)
    last = data.rstrip(SPACES)[-1:]
    return exits, deltas, lows, NOTHING if not last else OPENING if last in (b"[", b",") else OTHER


@dataclass(frozen=True)
class Entry:
    """At a chunk's begin: state, depth, whether an element may begin, whether the array is over."""

    state: int = OUTSIDE
    depth: int = 0
    waiting: bool = False
    closed: bool = False


def composed(chunks: list[tuple[list[int], list[int], list[int], int]]) -> list[Entry]:
    """The entries of a file's chunks in order."""
    out, now = [], Entry()
    for exits, deltas, lows, tail in chunks:
        out.append(now)
        state, depth = exits[now.state], now.depth + deltas[now.state]
        waiting = now.waiting if tail == NOTHING else tail == OPENING and state == OUTSIDE and depth == 1
        now = Entry(state, depth, waiting, now.closed or now.depth + lows[now.state] <= 0)
    return out


# ---------------------------------------------------------------- records that begin in a range


Read = Callable[[int, int], bytes]


def lines_in(read: Read, begin: int, end: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that begin in a range and aren't blank."""
    data, start = read(begin, end), 0
    if begin and read(begin - 1, begin) != b"\n":
        start = data.find(b"\n") + 1
        if not start:
            return
    elif not begin and data.startswith(BOM):
        start = len(BOM)
    at = end
    if start < len(data) and not data.endswith(b"\n"):
        parts = [data]
        while at < size:
            part = read(at, min(size, at + MORE))
            at += len(part)
            found = part.find(b"\n")
            parts.append(part if found < 0 else part[: found + 1])
            if found >= 0:
                break
        data = b"".join(parts)
    while start < len(data):
        stop = data.find(b"\n", start)
        stop = len(data) if stop < 0 else stop
        line = data[start:stop]
        if line.strip(b" \t\r"):
            yield begin + start, line
        start = stop + 1


def elements_in(read: Read, begin: int, end: int, size: int, entry: Entry) -> Iterator[tuple[int, bytes]]:
    """(offset, element) of a top-level array's elements that begin in a range. An element that the file's end cuts off
    is none."""
    if entry.closed:
        return
    data = read(begin, end)
    array = np.frombuffer(data, np.uint8)
    signs, step, state = structure(array, entry.state)
    depth = entry.depth + np.cumsum(step)
    if entry.depth == 0 and len(signs) and array[signs[0]] != 91:
        raise ValueError("not an array")
    opens = (step == 1) & (depth == 1)  # the array's own bracket
    cuts = ((step == 0) & (depth == 1)) | ((step == -1) & (depth == 0))  # what ends an element
    over = np.flatnonzero((step == -1) & (depth == 0))
    if len(over):  # nothing after the array counts
        opens[over[0] + 1 :], cuts[over[0] + 1 :] = False, False
    start = 0 if entry.waiting else None
    for i in np.flatnonzero(opens | cuts).tolist():
        place = int(signs[i])
        if cuts[i] and start is not None and (element := data[start:place].strip(SPACES)):
            yield begin + start + len(data[start:place]) - len(data[start:place].lstrip(SPACES)), element
        start = None if depth[i] == 0 else place + 1
    if start is None or not data[start:].strip(SPACES):
        return
    # The last element goes on behind the range.
    begun, parts = begin + start + len(data[start:]) - len(data[start:].lstrip(SPACES)), [data[start:]]
    level, at = int(depth[-1]) if len(depth) else entry.depth, end
    while at < size:
        part = read(at, min(size, at + MORE))
        signs, step, state_then = structure(np.frombuffer(part, np.uint8), state)
        depths = level + np.cumsum(step)
        ends = np.flatnonzero(((step == 0) & (depths == 1)) | ((step == -1) & (depths == 0)))
        if len(ends):
            parts.append(part[: int(signs[ends[0]])])
            yield begun, b"".join(parts).strip(SPACES)
            return
        parts.append(part)
        state, level, at = state_then, int(depths[-1]) if len(depths) else level, at + len(part)


# ---------------------------------------------------------------- the data source


@dataclass
class Range(InputPartition):
    file: str
    chunk: int
    begin: int
    end: int
    size: int
    entry: Entry


def packed(entries: dict[str, list[Entry]]) -> str:
    """Entries as an option's text."""
    told = {f: [[e.state, e.depth, int(e.waiting), int(e.closed)] for e in x] for f, x in entries.items()}
    return base64.b64encode(zlib.compress(json.dumps(told).encode())).decode()


def unpacked(text: str) -> dict[str, list[Entry]]:
    told = json.loads(zlib.decompress(base64.b64decode(text)))
    return {f: [Entry(s, d, bool(w), bool(c)) for s, d, w, c in x] for f, x in told.items()}


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType) -> None:
        self.names = schema.names
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.layout, self.chunk, self.entries = options.get("layout", "lines"), int(options.get("chunk", CHUNK)), options.get("entries")
        if self.layout not in ("lines", "array"):
            raise ValueError(f"unknown layout: {self.layout}")

    def partitions(self) -> list[Range]:
        entries = unpacked(self.entries) if self.entries else {}
        out = []
        for file, size in listed(self.paths):
            own = entries.get(file)
            for k in range(-(-size // self.chunk)):
                out.append(Range(file, k, k * self.chunk, min(size, (k + 1) * self.chunk), size, own[k] if own else Entry()))
        return out or [Range("", 0, 0, 0, 0, Entry())]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        system, place = opened(partition.file)
        with system.open_input_file(place) as f:

            def read(begin: int, end: int) -> bytes:
                f.seek(begin)
                return f.read(end - begin)

            yield from self.batches(partition, read)


class RecordReader(_Reader):
    """Batches of records. An array's chunks need their entries, unless a file is one chunk."""

    def partitions(self) -> list[Range]:
        out = super().partitions()
        if self.layout == "array" and not self.entries and any(r.chunk for r in out):
            raise ValueError("chunks of an array need their entries: use records()")
        return out

    def batches(self, r: Range, read: Read) -> Iterator[pa.RecordBatch]:
        found = lines_in(read, r.begin, r.end, r.size) if self.layout == "lines" else elements_in(read, r.begin, r.end, r.size, r.entry)
        rows: list[tuple[int, bytes]] = []
        held = done = 0
        for row in found:
            rows.append(row)
            held += len(row[1]) + 64
            if held >= BATCH:
                yield self.batch(r, rows, done)
                done, held, rows = done + len(rows), 0, []
        if rows:
            yield self.batch(r, rows, done)

    def batch(self, r: Range, rows: list[tuple[int, bytes]], first: int) -> pa.RecordBatch:
        make = {
            "file": lambda: pa.array([r.file] * len(rows)),
            "chunk": lambda: pa.array([r.chunk] * len(rows), pa.int64()),
            "item": lambda: pa.array(range(first, first + len(rows)), pa.int64()),
            "byte_offset": lambda: pa.array([x for x, _ in rows], pa.int64()),
            "byte_length": lambda: pa.array([len(x) for _, x in rows], pa.int64()),
            "sha256": lambda: pa.array([hashlib.sha256(x).hexdigest() for _, x in rows]),
            "raw": lambda: pa.array([x for _, x in rows], pa.binary()),
        }
        return pa.RecordBatch.from_arrays([make[c]() for c in self.names], names=self.names)


class ScanReader(_Reader):
    def batches(self, r: Range, read: Read) -> Iterator[pa.RecordBatch]:
        exits, deltas, lows, tail = scanned(read(r.begin, r.end))
        longs = pa.list_(pa.int64())
        columns = [pa.array([r.file]), pa.array([r.chunk], pa.int64()), pa.array([exits], pa.list_(pa.int32())), pa.array([deltas], longs), pa.array([lows], longs), pa.array([tail], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "chunk", "exits", "deltas", "lows", "tail"])


class RecordSource(DataSource):
    """Records by byte ranges. Options: layout (lines, array), chunk (bytes, more than a byte
    order mark's), paths (a JSON list, in place of a path)."""

    @classmethod
    def name(cls) -> str:
        return "quarry_records"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return RecordReader(self.options, schema)


class ScanSource(DataSource):
    """What each chunk of a JSON array does to the automaton: one row a chunk."""

    @classmethod
    def name(cls) -> str:
        return "quarry_scan"

    def schema(self) -> str:
        return SCANNED

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ScanReader(self.options, schema)


def entries_of(spark: SparkSession, paths: list[str], chunk: int) -> dict[str, list[Entry]]:
    """The entries of all chunks of arrays. One row a chunk comes to the driver, which plans one task for each as well."""
    spark.dataSource.register(ScanSource)
    rows = spark.read.format("quarry_scan").option("paths", json.dumps(paths)).option("chunk", chunk).option("layout", "array").load().collect()
    files: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.file, r.chunk)):
        files.setdefault(r.file, []).append((r.exits, r.deltas, r.lows, r.tail))
    return {f: composed(x) for f, x in files.items()}


def records(spark: SparkSession, path: str | list[str], layout: str = "lines", chunk: int = CHUNK, columns: tuple[str, ...] = ()) -> DataFrame:
    """file, line_index (records of the file from 0), byte_offset, byte_length and, if asked for, sha256 and raw.

    Records are counted by chunk in a read of two columns, and a chunk's records are shifted by the counts before: one row a
    chunk, whatever the files' sizes."""
    paths = [path] if isinstance(path, str) else list(path)
    spark.dataSource.register(RecordSource)
    options = {"paths": json.dumps(paths), "layout": layout, "chunk": str(chunk)}
    if layout == "array":
        options["entries"] = packed(entries_of(spark, paths, chunk))
    kinds = dict(x.split(" ") for x in COLUMNS.split(", "))
    wanted = lambda names: ", ".join(f"{c} {kinds[c]}" for c in names)
    read = lambda names: spark.read.format("quarry_records").options(**options).schema(wanted(names)).load()
    counts = read(["file", "chunk"]).groupBy("file", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("file", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    own = read(["file", "chunk", "item", "byte_offset", "byte_length", *columns])
    return own.join(shift, ["file", "chunk"]).select("file", (F.col("item") + F.col("shift")).alias("line_index"), "byte_offset", "byte_length", *columns)


# ---------------------------------------------------------------- reading records back


def raw_at(places: DataFrame, file: str = "file", offset: str = "byte_offset", length: str = "byte_length", name: str = "raw") -> DataFrame:
    """places with the bytes at each: rows are dealt and sorted by place, so a task reads few files, and each forwards. A task
    holds BATCH bytes of what it reads, whatever the number of places in a batch; read short records before long ones, as
    places are dealt with all their columns."""
    if name in places.columns:
        raise ValueError(f"a column {name} is there")
    dealt = places.repartitionByRange(file, offset).sortWithinPartitions(file, offset)
    at = [places.columns.index(c) for c in (file, offset, length)]

    def run(batches) -> Iterator[pa.RecordBatch]:
        now: tuple[str, pa.NativeFile] | None = None
        for b in batches:
            out, begin, held = [], 0, 0

            def put(end: int) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([*b.slice(begin, end - begin).columns, pa.array(out, pa.binary())], names=[*b.schema.names, name])  # noqa: B023

            for i, (f, o, n) in enumerate(zip(*(b.column(k).to_pylist() for k in at), strict=True)):
                if f is None or o is None or n is None:
                    out.append(None)
                    continue
                if now is None or now[0] != f:
                    if now is not None:
                        now[1].close()
                    system, place = opened(f)
                    now = f, system.open_input_file(place)
                now[1].seek(o)
                out.append(now[1].read(n))
                held += n
                if held >= BATCH:
                    yield put(i + 1)
                    out, begin, held = [], i + 1, 0
            if begin < b.num_rows:
                yield put(b.num_rows)
        if now is not None:
            now[1].close()

    return dealt.mapInArrow(run, T.StructType([*places.schema.fields, T.StructField(name, T.BinaryType())]))
