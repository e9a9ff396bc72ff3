"""Token-id files as wavelet matrices.

A shard's ids are kept as bit-planes, highest bit first: each plane holds one bit of every id, in an order that the
planes above sort stably by their bits, with the number of ones before each block. So one compressed file gives the id
at a place, the count of an id before a place, and the places of an id, without a plain copy of the ids.

File (little-endian): magic, then numbers of ids, documents, planes and bytes of the key section, and the zeros of each
plane (8 bytes each); the key section (an Arrow stream of the documents' keys and ends, compressed); the sizes of all
sections of the planes (4 bytes each); the sections. A plane has one section for its block counts (4 bytes each) and one
for each CHUNK bytes of its bits, each a zstd frame of its own. So a query inflates the block counts of the planes and
one section of bits a plane, not the file.

Files travel as rows of a table (part, number, file), which Spark can write to and read from any store. A file alone gives
its documents' keys, places and ids. Documents are
dealt by ranges of their key and sorted within, and each part's stream is cut into files of a bounded number of ids, so
the memory needed is that of one file (or one document, if longer).

Defined results: null and empty texts are a document of the end id alone; very long texts are whole in one file; equal
keys and repeated rows are documents of their own, next to each other, ordered by their texts' checksums; null keys come first; an empty
table gives no files; columns that aren't named are ignored.
"""

from __future__ import annotations

import gc
import io
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import materialize, partitions
from .tokens import WordTokenizer, tokenizer

MAGIC = b"QWM2"
#: Bits a block of the rank directory, and ids a file (a file may exceed it by its last document).
BLOCK, FILE_IDS = 512, 1 << 20
#: Bytes of a plane's bits in a section.
CHUNK = 1 << 14
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class Plane:
    """One bit of every id: how many are zero, ones before each block, and the bits, which a file holds in sections that
    are inflated when they are asked for."""

    def __init__(self, zeros: int, sections: list[bytes], before: np.ndarray | None = None, bits: np.ndarray | None = None) -> None:
        self.zeros, self.sections, self._before, self._bits, self._chunks = zeros, sections, before, bits, {}

    @property
    def before(self) -> np.ndarray:
        if self._before is None:
            self._before = np.frombuffer(_inflate(self.sections[0]), "<u4")
        return self._before

    def bits(self) -> np.ndarray:
        """All bits, packed."""
        if self._bits is None:
            self._bits = np.concatenate([self.chunk(k) for k in range(len(self.sections) - 1)])
            self._chunks.clear()
        return self._bits

    def chunk(self, k: int) -> np.ndarray:
        if self._bits is not None:
            return self._bits[k * CHUNK : (k + 1) * CHUNK]
        if k not in self._chunks:
            self._chunks[k] = np.frombuffer(_inflate(self.sections[k + 1]), np.uint8)
        return self._chunks[k]

    def block(self, k: int) -> np.ndarray:
        """The bytes of one block."""
        at = k * (BLOCK // 8)
        return self.chunk(at // CHUNK)[at % CHUNK : at % CHUNK + BLOCK // 8]

    def bit(self, i: int) -> int:
        return int(self.block(i // BLOCK)[i % BLOCK >> 3]) >> (i & 7) & 1

    def ones(self, i: int) -> int:
        """Ones before i."""
        own, at = self.block(i // BLOCK), i % BLOCK
        return int(self.before[i // BLOCK]) + int(_ONES[own[: at >> 3]].sum()) + int(_ONES[int(own[at >> 3]) & ((1 << (at & 7)) - 1)])

    def many_ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each of many places."""
        own = self.bits().reshape(-1, BLOCK // 8)[i // BLOCK]
        at, row = i % BLOCK, np.arange(len(i))
        counts = _ONES[own]
        counts[np.arange(BLOCK // 8) >= (at >> 3)[:, None]] = 0
        part = _ONES[own[row, at >> 3] & ((1 << (at & 7)) - 1)]
        return self.before[i // BLOCK].astype(np.int64) + counts.sum(1, dtype=np.int64) + part


def _inflate(frame: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(frame)


class WaveletMatrix:
    """ids: access, rank (count), select (occurrence) and all of them; ends: where each document ends; keys: theirs."""

    def __init__(self, n: int, ends: np.ndarray, planes: list[Plane], keys: pa.Array | None = None) -> None:
        self.n, self.ends, self.planes, self.keys = n, ends, planes, keys

    @classmethod
    def build(cls, ids: np.ndarray, ends: np.ndarray, bits: int, keys: pa.Array | None = None) -> WaveletMatrix:
        planes, now, n = [], ids, len(ids)
        for p in reversed(range(bits)):
            one = (now & (1 << p)) != 0
            packed = np.packbits(one, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8) + BLOCK // 8, np.uint8)])
            per = _ONES[packed].reshape(-1, BLOCK // 8).sum(1, dtype=np.uint32)
            before = np.concatenate([[0], np.cumsum(per)[:-1]]).astype("<u4")
            now = np.concatenate([np.compress(~one, now), np.compress(one, now)])
            planes.append(Plane(n - int(per.sum()), [], before, packed))
        return cls(n, np.asarray(ends, np.int64), planes, keys)

    def to_bytes(self) -> bytes:
        deflate = zstandard.ZstdCompressor(level=1).compress
        keys = self.keys if self.keys is not None else pa.nulls(len(self.ends))
        out = io.BytesIO()
        table = pa.RecordBatch.from_arrays([keys, pa.array(self.ends, pa.int64())], names=["key", "end"])
        with pa.ipc.new_stream(out, table.schema) as stream:
            stream.write_batch(table)
        told = deflate(out.getvalue())
        sections = []
        for p in self.planes:
            bits = p.bits()
            sections += [deflate(p.before.tobytes()), *(deflate(bits[a : a + CHUNK].tobytes()) for a in range(0, len(bits), CHUNK))]
        head = np.array([self.n, len(self.ends), len(self.planes), len(told), *(p.zeros for p in self.planes)], "<i8")
        return b"".join([MAGIC, head.tobytes(), told, np.array([len(x) for x in sections], "<u4").tobytes(), *sections])

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        n, _, bits, told = np.frombuffer(data, "<i8", 4, 4).tolist()
        zeros = np.frombuffer(data, "<i8", bits, 36).tolist()
        at = 36 + 8 * bits
        with pa.ipc.open_stream(_inflate(data[at : at + told])) as stream:
            table = stream.read_all().combine_chunks()
        size = (-(-n // 8) + BLOCK // 8 - 1) // (BLOCK // 8) * (BLOCK // 8) + BLOCK // 8
        each = 1 + -(-size // CHUNK)
        sizes = np.frombuffer(data, "<u4", bits * each, at + told)
        begins = at + told + sizes.nbytes + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        cut = [data[a:b] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
        planes = [Plane(z, cut[k * each : (k + 1) * each]) for k, z in enumerate(zeros)]
        column = lambda c, kind: table.column(c).chunk(0) if table.num_rows else pa.array([], kind)
        return cls(n, column("end", pa.int64()).to_numpy(), planes, column("key", table.schema.field("key").type))

    def _bit(self, p: int, i: int) -> int:
        return self.planes[p].bit(i)

    def _ones(self, p: int, i: int) -> int:
        """Ones of plane p before i."""
        return self.planes[p].ones(i)

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for p in range(len(self.planes)):
            one, ones = self._bit(p, i), self._ones(p, i)
            out = out << 1 | one
            i = self.planes[p].zeros + ones if one else i - ones
        return out

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the token's run in the last order begins, and where its occurrences before i end."""
        a, b = 0, i
        for p in range(len(self.planes)):
            x, y = self._ones(p, a), self._ones(p, b)
            one = token >> (len(self.planes) - 1 - p) & 1
            a, b = (self.planes[p].zeros + x, self.planes[p].zeros + y) if one else (a - x, b - y)
        return a, b

    def rank(self, token: int, i: int) -> int:
        """How often token stands before place i."""
        if token >> len(self.planes):
            return 0
        a, b = self._range(token, max(0, min(i, self.n)))
        return b - a

    def ranks(self, token: int, at: np.ndarray) -> np.ndarray:
        """How often token stands before each of many places."""
        if token >> len(self.planes):
            return np.zeros(len(at), np.int64)
        a, b = np.zeros(1, np.int64), np.clip(at, 0, self.n).astype(np.int64)
        for k, p in enumerate(self.planes):
            x, y = p.many_ones(a), p.many_ones(b)
            a, b = (p.zeros + x, p.zeros + y) if token >> (len(self.planes) - 1 - k) & 1 else (a - x, b - y)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence (from 0)."""
        if not 0 <= k < self.rank(token, self.n):
            raise IndexError(k)
        i = self._range(token, 0)[0] + k
        for p in reversed(range(len(self.planes))):
            plane = self.planes[p]
            zeros, before = plane.zeros, plane.before
            one = token >> (len(self.planes) - 1 - p) & 1
            want = i - zeros if one else i
            count = before.astype(np.int64) if one else np.arange(len(before)) * BLOCK - before
            block = int(np.searchsorted(count, want, "right")) - 1
            bits = np.unpackbits(plane.block(block), bitorder="little")
            i = block * BLOCK + int(np.flatnonzero(bits == one)[want - int(count[block])])
        return i

    def all(self) -> np.ndarray:
        """All ids in order."""
        now = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for p, plane in enumerate(reversed(self.planes)):
            zeros = plane.zeros
            one = np.unpackbits(plane.bits(), count=self.n, bitorder="little").view(bool)
            up = np.empty_like(now)
            up[np.flatnonzero(~one)] = now[:zeros]
            up[np.flatnonzero(one)] = now[zeros:] | (1 << p)
            now = up
        return now




def write_shards(df: DataFrame, vocabulary: str, end: int = 2, key: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Encodes all texts in ascending key order: the table of files (part, number, n_tokens, file)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        gc.disable()  # nothing here makes cycles; many small objects would set it off again and again
        tok = tokenizer(WordTokenizer, vocabulary)
        bits = max(1, (tok.library.get_vocab_size() - 1).bit_length())
        tail = np.array([end], tok.width).tobytes()
        width = len(tail)
        ids: list[bytes] = []
        keys: list[pa.Array] = []
        ends: list[int] = []
        total = 0

        def flush() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.frombuffer(b"".join(ids), tok.width), np.array(ends, np.int64), bits, pa.concat_arrays(keys))
            row = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([total], pa.int64()), pa.array([matrix.to_bytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(row, names=["part", "number", "n_tokens", "file"])

        for batch in batches:
            gc.collect()
            begin = 0
            for i, x in enumerate(batch.column(1)):
                ids.append(tok.encode(x.as_py() or "") + tail)
                total += len(ids[-1]) // width
                ends.append(total)
                if total >= file_ids:
                    keys.append(batch.column(0).slice(begin, i + 1 - begin))
                    yield flush()
                    begin, number, total = i + 1, number + 1, 0
                    ids, keys, ends = [], [], []
            if begin < batch.num_rows:
                keys.append(batch.column(0).slice(begin))
        if ends:
            yield flush()
        gc.enable()
        gc.collect()

    dealt = df.select(F.col(key).alias("key"), F.col(text).alias("text")).repartitionByRange(partitions(df.sparkSession), "key", F.crc32(F.coalesce("text", F.lit("")))).sortWithinPartitions("key", F.crc32(F.coalesce("text", F.lit(""))), "text")
    return materialize(dealt.mapInArrow(run, "part int, number int, n_tokens long, file binary"))


def starts(files: DataFrame) -> DataFrame:
    """The files with ``start``: ids in all files before. A part's sum and a file's count are all that is gathered."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    shift = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    own = files.select("part", "number", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("own"))
    places = own.join(shift, "part").select("part", "number", (F.col("own") + F.col("shift")).alias("start"))
    return files.join(places, ["part", "number"])


#: Columns of ``read_shards`` beside the key.
RESULT = ("start", "n_tokens", "ids_crc32", "end_ids")


def read_shards(files: DataFrame, key: str = "doc_id", end: int = 2, kind: T.DataType | None = None) -> DataFrame:
    """key, start, n_tokens, ids_crc32 and end_ids (occurrences of the end id, counted by rank) of every document, all read
    from the files; kind: the type of their keys."""
    if key in RESULT:
        raise ValueError(f"rename the key column first: {key} is a column of the result")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column("file")[i].as_py())
                ids = matrix.all().astype("<u4")
                begins = np.concatenate([[0], matrix.ends[:-1]]).astype(np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins.tolist(), matrix.ends.tolist(), strict=True)]
                told = np.diff(matrix.ranks(end, np.concatenate([begins[:1], matrix.ends])))
                columns = [pa.array(begins + batch.column("start")[i].as_py()), pa.array(matrix.ends - begins), pa.array(crc, pa.int64()), pa.array(told)]
                yield pa.RecordBatch.from_arrays([matrix.keys, *columns], names=["key", *RESULT])

    schema = T.StructType([T.StructField("key", kind or T.LongType()), *(T.StructField(c, T.LongType()) for c in RESULT)])
    return starts(files).select("file", "start").mapInArrow(run, schema).withColumnRenamed("key", key)
