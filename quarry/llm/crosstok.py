"""How the tokens of two vocabularies lie over the same bytes, and which pairs of ids meet in how many documents.

A text is encoded by a byte-level vocabulary (A: a space and the text) and by a vocabulary of pieces (B: it adds the
space itself). The byte offsets at which tokens of both end cut the text into groups; each A token of a group is linked
with each B token of it. The work on a batch is a pipeline of Arrow kernels:

1. Texts are cut into words at spaces before which both vocabularies end a token, whatever stands around; a slice's words
   are dictionary-encoded and looked up in a bounded store of words with their ids, new ones are tokenized together, and
   the lists of ids are taken by the words' places.
2. The lists are flattened; parent indices give each token's document; cumulative sums of the tokens' bytes, less what
   they were where the document begins, give the offset at which each token ends.
3. An Acero hash join of A's and B's document-end keys finds the ends that are common; cumulative sums over them number
   the groups; the lists of B's ids by group, taken by A's groups and flattened, are the links, their parent indices A's
   tokens; ``Table.group_by`` counts those of each (document, pair).
4. ``Table.group_by`` counts the documents of each pair in a chunk of documents; Spark adds the chunks' counts up and
   finds each A id's highest.
5. The counts go back to the chunks whose pairs they are (a chunk's different pairs are far fewer than its documents'),
   and meet the documents there.

A chunk holds a bounded number of pairs of whole documents, so what is held together in a task is bounded by CHUNK and
by the pairs of one document. A pair that is in all documents has one row a chunk in every shuffle. Long texts are taken
in slices of SLICE words; a run of characters without a space is tokenized as a whole.

Defined results: null and empty texts, and those whose tokens of either vocabulary don't spell a space and the text,
have zeros and an empty string; repeated rows are documents of their own and count as such; null keys are keys; an empty
table gives an empty result; columns that aren't named are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import bound_batches, materialize, tidy
from .tokens import ByteTokenizer, tokenizer

#: Words aligned together, pairs a chunk of documents, and words of a worker's store (it may exceed it by a slice's).
SLICE, CHUNK, REMEMBERED = 1 << 16, 1 << 20, 400_000
#: Characters of a text that are cut into words together, and words that are tokenized in one call.
TOGETHER, TOGETHER_WORDS = 1 << 19, 512
#: A space before which both vocabularies end a token: A ends one wherever white space begins, B before each of its own
#: spaces that doesn't follow another one.
BREAK, UNBROKEN = re.compile("(?<=[^\\s▁]) "), re.compile("[\\s▁] ")
#: Words with other characters than these, or with white space at an end, are tokenized one by one.
ODD = re.compile(r"[^\n\x20-\x7e\xa1-\xac\xae-\xff]|^[\n ]|[\n ]\Z|[\n ][\n ]").search
#: Columns of the result beside the key.
RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
COUNTS = RESULT[:4]


class Pair:
    """Two vocabularies, and a bounded store of words and their ids."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece

        self.a = tokenizer(ByteTokenizer, path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        spelt = {i: x for x, i in self.a.fast._mergeable_ranks.items()}
        self.bytes_a = [spelt.get(i, b"") for i in range(max(spelt) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.name_a, self.name_b = (pa.array([str(i) for i in range(len(side))]) for side in (self.bytes_a, self.bytes_b))
        #: Whether B's tokens may be had word by word: no piece holds a space within.
        self.by_word = not any(re.search("[^▁]▁", x) for x in pieces)
        self.space = self.b.piece_to_id("▁")
        self.forget()

    def forget(self) -> None:
        ids = pa.array([], pa.list_(pa.int32()))
        self.known: dict[str, int] = {}
        self.ids_a, self.ids_b, self.wrong = ids, ids, np.zeros(0, bool)

    @property
    def width(self) -> int:
        return len(self.bytes_b)

    def words(self, text: str) -> Iterator[list[str]]:
        """The text's words, some at a time: joined by single spaces they are the text."""
        if not self.by_word:
            yield [text]
            return
        at = 0
        while at <= len(text):
            end = len(text)
            if end - at > TOGETHER and (found := BREAK.search(text, at + TOGETHER)):
                end = found.start()
            part = text[at:end] if at or end < len(text) else text
            yield BREAK.split(part) if part.startswith(" ") or UNBROKEN.search(part) else part.split(" ")
            at = end + 1

    def codes(self, words: pa.StringArray) -> pa.Array:
        """Places of these words in the store, whose new ones are tokenized."""
        if len(self.known) > REMEMBERED:
            self.forget()
        coded = words.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(self.known.get, different, repeat(-1)), np.int32, len(different))
        missed = np.flatnonzero(places < 0)
        if len(missed):
            new = [different[i] for i in missed.tolist()]
            places[missed] = len(self.known) + np.arange(len(new))
            a, b, wrong = self._tokenized(new)
            self.known.update(zip(new, places[missed].tolist(), strict=True))
            self.ids_a, self.ids_b = pa.concat_arrays([self.ids_a, a]), pa.concat_arrays([self.ids_b, b])
            self.wrong = np.concatenate([self.wrong, wrong])
        return pa.array(places).take(coded.indices)

    def _tokenized(self, words: list[str]) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
        """A's and B's ids of a space and each word, and whether they spell something else (then there are none)."""
        wrong, odd = np.zeros(len(words), bool), []
        found: list[tuple[list[int], list[np.ndarray]]] = []  # which words, and of each side ids and their numbers
        for first in range(0, len(words), TOGETHER_WORDS):
            which = list(range(first, min(first + TOGETHER_WORDS, len(words))))
            if ODD(" ".join(words[first : first + TOGETHER_WORDS])):
                odd += [i for i in which if not words[i] or ODD(words[i])]
                which = [i for i in which if words[i] and not ODD(words[i])]
            if told := self._together([words[i] for i in which]):
                found.append((which, told))
            else:
                odd += which
        for i in odd:
            text = " " + words[i]
            a, b = self.a.library.encode(text, add_special_tokens=False).ids, self.b.encode(words[i]) or [self.space]  # an empty text is left without its space
            want = text.encode()
            wrong[i] = b"".join(map(self.bytes_a.__getitem__, a)) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want
            found.append(([i], [x for ids in (a, b) for x in (np.array([] if wrong[i] else ids, np.int32), np.array([0 if wrong[i] else len(ids)]))]))
        out = []
        order = np.argsort([i for w, _ in found for i in w])
        for side in (0, 2):
            sizes = np.concatenate([x[side + 1] for _, x in found])
            lists = pa.ListArray.from_arrays(pa.array(_offsets(sizes), pa.int32()), pa.array(np.concatenate([x[side] for _, x in found]), pa.int32()))
            out.append(lists.take(pa.array(order)))
        return *out, wrong

    def _together(self, words: list[str]) -> list[np.ndarray] | None:
        """Ids and their numbers of words of plain characters, in one call of each library, cut at the words' ends; None if
        they spell something else."""
        text = " ".join(words)
        want, out = f" {text}".encode(), []
        ends = np.cumsum([len(w.encode()) + 1 for w in words] if not text.isascii() else np.fromiter(map(len, words), np.int64, len(words)) + 1)
        for ids, spelt, lengths in ((self.a.fast.encode_ordinary(f" {text}"), self.bytes_a, self.length_a), (self.b.encode(text), self.bytes_b, self.length_b)):
            if b"".join(map(spelt.__getitem__, ids)) != want:
                return None
            ids = np.array(ids, np.int32)
            own = np.cumsum(lengths[ids])
            at = np.searchsorted(own, ends)
            if (own[at] != ends).any():
                return None
            out += [ids, np.diff(at, prepend=-1)]
        return out


@functools.lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    """One a worker process."""
    return Pair(path_a, path_b)


def _offsets(numbers: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(numbers)]).astype(np.int32)


class Side:
    """The tokens of one vocabulary over a slice of words: ids, documents, where they end in their document."""

    def __init__(self, lists: pa.ListArray, owner: pa.Array, lengths: np.ndarray, documents: int) -> None:
        self.ids, self.doc = lists.flatten(), owner.take(pc.list_parent_indices(lists))
        docs, ends = self.doc.to_numpy(), pc.cumulative_sum(pa.array(lengths[self.ids.to_numpy()])).to_numpy()
        self.begin = np.searchsorted(docs, np.arange(documents + 1))
        self.number = np.diff(self.begin)
        start = np.where(self.begin > 0, ends[self.begin - 1], 0)[:-1] if len(ends) else np.zeros(documents, np.int64)
        self.key = ends + ((np.arange(documents) << 40) - start)[docs]

    def table(self, place: str) -> pa.Table:
        """Document-end keys, and the tokens' numbers."""
        return pa.table({"key": self.key, place: pa.array(np.arange(len(self.ids), dtype=np.int32))})

    def sizes(self, last: pa.ChunkedArray) -> np.ndarray:
        """How many tokens each group has; last: the tokens that end one."""
        return np.diff(np.sort(last.to_numpy()), prepend=-1)

    def spelt(self, names: pa.Array, sizes: np.ndarray) -> pa.Array:
        """The decimal ids of each group, with commas."""
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(_offsets(sizes)), names.take(self.ids)), ",")


class Slice:
    """A slice of words aligned: of each document the counts, the groups spelt, and the pairs with their links."""

    def __init__(self, both: Pair, words: list[str], owner: np.ndarray, documents: int) -> None:
        codes, owners = both.codes(pa.array(words, pa.string())), pa.array(owner)
        self.wrong = np.zeros(documents, bool)
        if both.wrong.any():
            self.wrong[owner[both.wrong[codes.to_numpy()]]] = True
        a = Side(both.ids_a.take(codes), owners, both.length_a, documents)
        b = Side(both.ids_b.take(codes), owners, both.length_b, documents)
        common = a.table("i").join(b.table("j"), keys="key", join_type="inner", use_threads=False)
        size_a, size_b = a.sizes(common.column("i")), b.sizes(common.column("j"))
        last = np.cumsum(size_a) - 1  # A's token that ends each group
        end = np.searchsorted(last, a.begin[1:] - 1, "right")  # groups up to each document's end
        groups = np.diff(end, prepend=0)
        joined = pc.binary_join_element_wise(a.spelt(both.name_a, size_a), b.spelt(both.name_b, size_b), "|")
        self.text = pc.binary_join(pa.ListArray.from_arrays(pa.array(_offsets(groups)), joined), ";")
        links = pa.ListArray.from_arrays(pa.array(_offsets(size_b)), b.ids).take(pa.array(np.repeat(np.arange(len(size_a)), size_a)))
        span = both.width * len(both.bytes_a)
        own = a.doc.to_numpy() * np.int64(span) + a.ids.to_numpy() * np.int64(both.width)
        key = pc.add(pa.array(own).take(pc.list_parent_indices(links)), links.flatten().cast(pa.int64()))
        counted = pa.table({"key": key}).group_by("key", use_threads=False).aggregate([([], "count_all")])
        keys = counted.column("key").to_numpy()
        self.links = counted.column("count_all").to_numpy().astype(np.int32)
        docs = keys // span
        if (docs[1:] < docs[:-1]).any():  # keys come as they are met, so documents are in order
            order = np.argsort(docs, kind="stable")
            docs, keys, self.links = docs[order], keys[order], self.links[order]
        self.pairs = keys - docs * span
        self.begin = np.searchsorted(docs, np.arange(documents + 1))
        n_links = np.diff(np.concatenate([[0], np.cumsum(size_a * size_b)])[np.concatenate([[0], end])])
        self.counts = np.stack([a.number, b.number, groups, n_links], 1).astype(np.int64)


class Document:
    """What slices say of one document that is longer than a slice."""

    def __init__(self) -> None:
        self.wrong, self.counts, self.digest = False, np.zeros(4, np.int64), hashlib.sha256()
        self.pairs = self.links = np.zeros(0, np.int64)

    def add(self, s: Slice, k: int) -> None:
        self.wrong |= bool(s.wrong[k])
        text = s.text[k].as_py()
        self.digest.update((";" + text if self.counts[2] and text else text).encode())
        self.counts += s.counts[k]
        pairs = np.concatenate([self.pairs, s.pairs[s.begin[k] : s.begin[k + 1]]])
        self.pairs, back = np.unique(pairs, return_inverse=True)
        self.links = np.bincount(back, np.concatenate([self.links, s.links[s.begin[k] : s.begin[k + 1]]]), len(self.pairs)).astype(np.int64)


def aligned(texts: Iterable[str | None], both: Pair) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """Row numbers and their rows: counts, digest, pairs and links. Rows without tokens come without pairs."""
    words: list[str] = []
    owner, rows = array("i"), array("q")  # of each word, and of each document of the slice
    open_: Document | None = None  # of the slice's first document, if it began before

    def flush(more: bool) -> tuple[np.ndarray, pa.RecordBatch]:
        """more: the last document goes on."""
        nonlocal words, owner, rows, open_
        s = Slice(both, words, np.array(owner, np.int32), len(rows))
        number = len(rows)
        counts, wrong = s.counts, s.wrong
        digest = ["" if w else hashlib.sha256(x.as_buffer()).hexdigest() for x, w in zip(s.text, wrong, strict=True)]
        pairs = [s.pairs[s.begin[k] : s.begin[k + 1]] for k in range(number)]
        links = [s.links[s.begin[k] : s.begin[k + 1]] for k in range(number)]
        done = number
        for k in {0, number - 1} if open_ is not None or more else ():
            begun, goes_on = k == 0 and open_ is not None, more and k == number - 1
            if begun or goes_on:
                held = open_ if begun else Document()
                held.add(s, k)
                open_ = held if goes_on else None if begun else open_
                if goes_on:
                    done = number - 1
                else:
                    counts[k], wrong[k], pairs[k], links[k] = held.counts, held.wrong, held.pairs, held.links
                    digest[k] = "" if held.wrong else held.digest.hexdigest()
        counts[wrong] = 0
        sizes = [0 if w else len(x) for x, w in zip(pairs, wrong, strict=True)][:done]
        join = lambda x: np.concatenate([np.zeros(0, np.int64), *(y for y, w in zip(x[:done], wrong, strict=False) if not w)])
        lists = [pa.ListArray.from_arrays(pa.array(_offsets(sizes), pa.int32()), pa.array(join(x).astype(t))) for x, t in ((pairs, np.int64), (links, np.int32))]
        out = pa.RecordBatch.from_arrays([*(pa.array(counts[:done, c]) for c in range(4)), pa.array(digest[:done], pa.string()), *lists], names=[*COUNTS, "groups_sha256", "pairs", "links"])
        told = np.array(rows[:done], np.int64)
        words, owner, rows = [], array("i"), rows[done:]
        return told, out

    empty = array("q")
    for row, text in enumerate(texts):
        if not text:
            empty.append(row)
            continue
        rows.append(row)
        for part in both.words(text):
            if len(words) + len(part) > SLICE and words:
                more = bool(owner) and owner[-1] == len(rows) - 1
                if not more:
                    rows.pop()
                yield flush(more)
                if not more:
                    rows.append(row)
            words += part
            owner.extend([len(rows) - 1] * len(part))
    if rows:
        yield flush(False)
    if empty:
        none = pa.array([[]] * len(empty), pa.list_(pa.int64())), pa.array([[]] * len(empty), pa.list_(pa.int32()))
        yield np.array(empty), pa.RecordBatch.from_arrays([*(pa.array(np.zeros(len(empty), np.int64)) for _ in COUNTS), pa.array([""] * len(empty)), *none], names=[*COUNTS, "groups_sha256", "pairs", "links"])


def documents(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """chunk, key, the counts, groups_sha256, pairs (A id times B's size plus B id, each once) and their links."""
    bound_batches(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, first = pair(path_a, path_b), TaskContext.get().partitionId() << 32
        chunk, held = 0, 0
        for batch in batches:
            for rows, out in aligned((x.as_py() for x in batch.column(1)), both):
                told = [pa.array(np.full(len(rows), first + chunk)), batch.column(0).take(pa.array(rows)), *out.columns]
                yield pa.RecordBatch.from_arrays(told, names=["chunk", "key", *out.schema.names])
                held += len(out.column("pairs").values)
                if held >= CHUNK:
                    chunk, held = chunk + 1, 0

    fields = [T.StructField("chunk", T.LongType()), T.StructField("key", df.schema[key].dataType), *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("groups_sha256", T.StringType())]
    lists = [T.StructField("pairs", T.ArrayType(T.LongType(), False)), T.StructField("links", T.ArrayType(T.IntegerType(), False))]
    return materialize(df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(tidy(run), T.StructType([*fields, *lists])))


def chunk_counts(docs: DataFrame) -> DataFrame:
    """chunk, pair, n: in how many of a chunk's documents each pair is linked. A chunk that a task meets in parts, or that
    is read by several tasks, has several rows a pair."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def counted() -> pa.RecordBatch:
            table = pa.concat_tables(held).group_by(["chunk", "pair"], use_threads=False).aggregate([([], "count_all")])
            held.clear()
            return pa.RecordBatch.from_arrays([x.combine_chunks() for x in table.columns], names=["chunk", "pair", "n"])

        for batch in batches:
            pairs = batch.column("pairs")
            if len(flat := pairs.flatten()):
                held.append(pa.table({"chunk": batch.column("chunk").take(pc.list_parent_indices(pairs)), "pair": flat}))
            if sum(x.num_rows for x in held) > 2 * CHUNK:
                yield counted()
        if held:
            yield counted()

    return docs.select("chunk", "pairs").mapInArrow(tidy(run), "chunk long, pair long, n long")


def pair_counts(parts: DataFrame, width: int) -> DataFrame:
    """pair, n, best: the documents that hold each pair linked, and whether no other pair of its A id has more. A window
    holds the pairs of one A id, as many as B has ids at most."""
    totals = parts.groupBy("pair").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.floor(F.col("pair") / F.lit(width)))
    return totals.withColumn("best", F.col("n") == F.max("n").over(of_a))


def align(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row a document."""
    if key in RESULT:
        raise ValueError(f"rename the key column first: {key} is a column of the result")
    docs = documents(df, path_a, path_b, key, text)
    parts = materialize(chunk_counts(docs), few=True)
    told = parts.select("chunk", "pair").distinct().join(pair_counts(parts, pair(path_a, path_b).width), "pair")
    kind = docs.schema["key"].dataType

    def meet(own: pa.Table, counts: pa.Table) -> pa.Table:
        own, counts = own.combine_chunks(), counts.sort_by("pair").combine_chunks()
        pairs = own.column("pairs").combine_chunks()
        links = own.column("links").combine_chunks().flatten().to_numpy().astype(np.int64)
        at = np.searchsorted(counts.column("pair").to_numpy(), pairs.flatten().to_numpy())
        n = counts.column("n").to_numpy()[at] * links if len(at) else links
        best = np.where(counts.column("best").to_numpy(zero_copy_only=False)[at], links, 0) if len(at) else links
        ends = _offsets(pc.list_value_length(pairs).to_numpy())
        sums = [pa.array(np.diff(np.concatenate([[0], np.cumsum(x)])[ends])) for x in (best, n)]
        return pa.table([*(own.column(c) for c in ("key", *COUNTS)), *sums, own.column("groups_sha256")], names=["key", *RESULT])

    schema = T.StructType([T.StructField("key", kind), *(T.StructField(c, T.LongType()) for c in RESULT[:-1]), T.StructField(RESULT[-1], T.StringType())])
    return docs.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(meet, schema).withColumnRenamed("key", key)
