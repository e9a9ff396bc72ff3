"""N-gram Jaccard self-join, size-aware: small sets by subsets, large sets by inverted lists.

Two texts link when their sets of word shingles have a Jaccard similarity of at least 4/5. Texts with equal sets are
one node. In any order of all shingles, linked sets of n shingles share a shingle among their first n - ceil(4n/5) + 1
(their prefixes), and two among one more. So a large set enters the inverted list of each shingle of its prefix, and a
small set instead the bucket of each pair of shingles of its longer prefix: fewer, more telling meetings, at more rows.
The boundary is the size up to which the pairs cost less, given the mean length of a list, counted over all documents.
Sets just under it enter both, as they may link with larger ones. The order is that of the shingles' hashes, but for
shingles that many documents have, which come last (a set of bounded size, chosen by counts over all documents; which
shingles are in it has no influence on the result).

A bucket's members aren't paired with each other but given to one leader each (members of similar size, by sorted
runs, each also to the leader before if that one's members may be similar): two members of a bucket that may link
share a leader. All members of a leader meet once, with
their whole texts, however many buckets they share, and all their intersections are counted together, by products of
incidence matrices. What leaves a task are links that join what links join, fewer than members. Leaders of many members
are copied to several tasks of bounded size; links make components, and only members of such a leader that are still in
different components meet across tasks: blocks of members of smaller components are compared with all. So no link that
joins components is missed, and a group of copies that links join costs a multiple of its size. Buckets of
frequent shingles are dealt out too; their leaders are found by aggregation.

Ids of nodes, keys and shingles are 64-bit hashes.

Defined results: null and empty texts and texts of white space have an empty set, link with nothing and are their own
component; fewer than five words make one shingle; very long texts are taken whole; repeated rows and texts with equal
sets are one node, each row is returned; a null key takes part, and a component's id is its smallest key that isn't
null; an empty table gives an empty result; columns that aren't named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import KeyFilter, bound_batches, materialize, partitions, tidy, trim
from .words import U, mix, shingle_sets

SHINGLE = 5
#: A shingle is frequent from this count in prefixes; at most so many, the most frequent first, are put last.
FREQUENT, AT_MOST = 32, 200_000
#: Members of a frequent bucket, or of a leader, in one task.
DEALT = 512
#: Shingles of the members of a leader in one task (or one member, if it has more).
HELD = 300_000
#: Cost of a companion met in a bucket, in rows that are shuffled: its text travels to the leader and is compared there.
MEETING = 12
#: Sets below this size link only with equal sets.
LEAST = 4


def prefix_size(n: int) -> int:
    return n + (-4 * n // 5) + 1


def boundary(mean_list: float) -> int:
    """The largest size for which pairs of shingles cost no more than lists: pairs are more rows, but only sets that are
    nearly alike meet in them; in a list a set meets all companions, mean_list - 1 of them."""
    n = LEAST
    while True:
        p = prefix_size(n + 1)
        if (p + 1) * p / 2 > p * (1 + MEETING * (mean_list - 1)):
            return n
        n += 1


def short(s: np.ndarray) -> np.ndarray:
    """The lower 32 bits, by which shingles are counted."""
    return s.astype(np.uint32).view(np.int32)


def node_of(s: np.ndarray) -> int:
    """A set's id."""
    return int(mix(mix(s).sum(dtype=np.uint64, keepdims=True) + U(len(s))).view(np.int64)[0]) if len(s) else 0


def ordered(s: np.ndarray, last: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """The first n shingles of a set, frequent ones last, and how many of them aren't frequent. last: ascending."""
    if len(last):
        low = short(s)
        hit = last[np.minimum(np.searchsorted(last, low), len(last) - 1)] == low
        if hit[: n + 1].any():
            rare = s[~hit]
            return np.concatenate([rare, s[hit]])[:n], min(n, len(rare))
    return s[:n], n


def nodes(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, h (a hash of key and text, by which a text is found again: of rows without a key none has another's), node, n and
    the prefix in order of hashes (lower 32 bits), written to the shared folder."""

    @F.arrow_udf("struct<node:long,n:int,prefix:array<int>>")
    def described(texts: pa.Array) -> pa.Array:
        sets = shingle_sets(texts.to_pylist(), SHINGLE)
        heads = [short(s[: prefix_size(len(s))]) if len(s) >= LEAST else np.zeros(0, np.int32) for s in sets]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(h) for h in heads])]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *heads])))
        trim()
        return pa.StructArray.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), lists], names=["node", "n", "prefix"])

    own = df.select(F.col(key).alias("key"), F.xxhash64(F.col(key), F.col(text)).alias("h"), described(text).alias("d"))
    return materialize(own.select("key", "h", "d.node", "d.n", "d.prefix"))


def frequent(own: DataFrame) -> tuple[dict[int, int], float]:
    """Counts of the most frequent shingles, and the mean length of the list that another shingle of a prefix is in."""
    once = materialize(own.filter(F.size("prefix") > 0).groupBy("node").agg(F.any_value("prefix").alias("prefix")), release=True)
    counts = once.select(F.explode("prefix").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("c")).filter("c > 1")
    counts = materialize(counts, release=True, few=True)
    top = counts.filter(F.col("c") >= FREQUENT).orderBy(F.desc("c"), "shingle").limit(AT_MOST).toPandas()
    rows = once.agg(F.sum(F.size("prefix"))).first()[0] or 0
    few = F.when(F.col("c") < FREQUENT, F.col("c"))
    twice, many, squares = (x or 0 for x in counts.agg(F.sum("c"), F.sum("c") - F.sum(few), F.sum(few * few)).first())
    mean = (rows - twice + squares) / (rows - many) if rows > many else 1.0
    return dict(zip(top["shingle"].tolist(), top["c"].tolist(), strict=True)), max(1.0, mean)


def entries(df: DataFrame, text: str, counts: dict[int, int], small: int) -> DataFrame:
    """bucket, salt (-1: not frequent), n, node: where each set goes."""
    last = np.array(sorted(counts), np.int32)
    size = np.array([counts[x] for x in last.tolist()], np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for s in shingle_sets(batch.column(0).to_pylist(), SHINGLE):
                n = len(s)
                if n < LEAST:
                    continue
                p, node = prefix_size(n), node_of(s)
                head, rare = ordered(s, last, p + 1)
                buckets, salts = [], []

                def salted(shingles: np.ndarray, node: int = node) -> np.ndarray:
                    c = size[np.searchsorted(last, short(shingles))]
                    return node % (-(-c // DEALT))

                if n <= small:
                    i, j = (np.array(x) for x in zip(*combinations(range(len(head)), 2), strict=True))
                    buckets.append(mix(mix(head[i]) + head[j]))
                    salts.append(np.where(i >= rare, salted(head[np.maximum(i, rare)]), -1) if rare < len(head) else np.full(len(i), -1))
                if 5 * n >= 4 * (small + 1):
                    own = head[:p]
                    buckets.append(own)
                    salts.append(np.concatenate([np.full(min(rare, p), -1), salted(own[rare:])]))
                for b, t in zip(buckets, salts, strict=True):
                    columns[0].append(b.view(np.int64))
                    columns[1].append(t.astype(np.int32))
                    columns[2].append(np.full(len(b), n, np.int32))
                    columns[3].append(np.full(len(b), node, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, t), *c])) for c, t in zip(columns, (np.int64, np.int32, np.int32, np.int64), strict=True)], names=["bucket", "salt", "n", "node"])

    return df.select(text).mapInArrow(tidy(run), "bucket long, salt int, n int, node long")


def meetings(places: DataFrame) -> DataFrame:
    """bucket, salt, leader, node, n, for members that have company of similar size; written to the shared folder.

    Rows come sorted by bucket, size and node, so a bucket is a run that is looked at row by row.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last row: bucket, salt, n, node, leader, told
        head = prior = (0, 0)  # n and node of the leader, and of the one before it in the bucket
        for batch in batches:
            b, t, n, v = (batch.column(c).to_numpy() for c in ("bucket", "salt", "n", "node"))
            if not len(b):
                continue
            kept = np.concatenate([[before is None or (b[0], t[0], v[0]) != (before[0], before[1], before[3])], (b[1:] != b[:-1]) | (t[1:] != t[:-1]) | (v[1:] != v[:-1])])
            b, t, n, v = b[kept], t[kept], n[kept], v[kept]  # equal sets meet once
            out: list[tuple[int, int, int, int, int]] = []
            if before is not None:
                b, t, n, v = (np.concatenate([[x], y]) for x, y in zip(before[:4], (b, t, n, v), strict=True))
            new = (b[1:] != b[:-1]) | (t[1:] != t[:-1])
            same = (~new) & (v[1:] != v[:-1])
            near = same & (5 * n[:-1] >= 4 * n[1:])
            hot = t >= 0
            # Rows with a neighbour of similar size, and all of frequent buckets, are told; the last row waits.
            told = hot.copy()
            told[1:] |= near
            told[:-1] |= near
            if before is not None and before[4]:
                told[0] = True
            todo = np.flatnonzero(told[:-1])
            if before is None or not before[4]:
                head = prior = (0, 0)
            last_run = -1
            run_id = np.concatenate([[0], np.cumsum(new)])
            if before is not None and before[4]:
                last_run = 0
            for i in todo.tolist():
                if run_id[i] != last_run:
                    head, prior, last_run = (int(n[i]), int(v[i])), (0, 0), run_id[i]
                elif 4 * n[i] > 5 * head[0]:
                    head, prior = (int(n[i]), int(v[i])), head
                add(out, head, prior, (b[i], t[i], v[i], n[i]))
            open_run = last_run == run_id[-1]
            if not open_run:
                head = prior = (0, 0)
            before = (b[-1], t[-1], n[-1], v[-1], bool(told[-1]) and open_run, bool(told[-1]))
            if told[-1] and not open_run:
                # It begins a run (or follows rows that weren't told) and leads what comes.
                head = (int(n[-1]), int(v[-1]))
                before = (*before[:4], True, True)
            yield _rows(out)
        if before is not None and before[5]:
            b, t, n, v = (int(x) for x in before[:4])
            if 4 * n > 5 * head[0]:
                head, prior = (n, v), head
            out = []
            add(out, head, prior, (b, t, v, n))
            yield _rows(out)

    def add(out: list, head: tuple[int, int], prior: tuple[int, int], row: tuple) -> None:
        b, t, v, n = map(int, row)
        out.append((b, t, head[1], v, n))
        if 16 * n <= 25 * prior[0]:  # it may link with members of the leader before
            out.append((b, t, prior[1], v, n))

    def _rows(out: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["bucket", "salt", "leader", "node", "n"])

    dealt = places.repartition(partitions(places.sparkSession), "bucket", "salt").sortWithinPartitions("bucket", "salt", "n", "node")
    return materialize(dealt.mapInArrow(tidy(run), "bucket long, salt int, leader long, node long, n int"), release=True)


def _links(df: DataFrame, key: str, text: str, own: DataFrame, asked: DataFrame) -> DataFrame:
    """a, b: links found within each (leader, salt) of ``asked`` (node, leader, salt, role); written to the shared folder.

    The texts of the nodes asked for, and only these, go to their leaders' tasks. Without roles 2 all members are
    compared with each other; else those of role 2 with those of role 1.
    """
    asked = materialize(asked, release=True, few=True)
    some = own.join(asked.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key"), F.col("h").alias("h"))).alias("k")).select("node", "k.h")
    some = materialize(some, few=True)
    docs = df.select(F.xxhash64(F.col(key), F.col(text)).alias("h"), F.col(text).alias("text"))
    docs = docs.filter(KeyFilter(some.select("h")).may_have(F.col("h"), F.col("h")))
    rows = asked.join(some, "node").join(docs, "h").select("node", "leader", "salt", "role", "text")
    rows = rows.repartition(partitions(df.sparkSession), "leader", "salt").sortWithinPartitions("leader", "salt", "role", "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: tuple | None = None
        members: list[tuple[int, int, np.ndarray]] = []  # node, role, set
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                out: list[tuple[int, int]] = []
                sets = shingle_sets(part.column("text").to_pylist(), SHINGLE)
                for node, leader, salt, role, s in zip(*(part.column(c).to_pylist() for c in ("node", "leader", "salt", "role")), sets, strict=True):
                    if (leader, salt) != group:
                        out += compared(members)
                        group, members = (leader, salt), []
                    if node_of(s) == node and not (members and members[-1][:2] == (node, role)):  # not another text under the same key
                        members.append((node, role, s))
                yield _rows(out)
        yield _rows(compared(members))

    def _rows(out: list[tuple[int, int]]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return materialize(rows.mapInArrow(tidy(run), "a long, b long"), release=True)


def overlaps(sets: list[np.ndarray], most: int = 200_000) -> np.ndarray:
    """Sizes of all intersections. Sets are taken in chunks of so many shingles (or one set), two chunks at a time."""
    size = np.array([len(x) for x in sets])
    chunk = (np.cumsum(size) - 1) // most
    places = [np.flatnonzero(chunk == c) for c in np.unique(chunk)]
    out = np.zeros((len(sets), len(sets)), np.int32)
    for a, i in enumerate(places):
        for j in places[a:] if len(places) == 1 else places[a + 1 :]:
            both = i if i is j else np.concatenate([i, j])
            out[np.ix_(both, both)] = _overlaps([sets[k] for k in both])
    np.fill_diagonal(out, size)
    return out


def _overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Products of incidence matrices over the shingles that several sets have."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    rank = np.cumsum(count > 1) - 1
    kept = count[place] > 1
    place, owner = rank[place[kept]], owner[kept]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    for c in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
        i, j = np.searchsorted(place, [c, c + columns])
        part = np.zeros((n, columns), np.float32)
        part[owner[i:j], place[i:j] - c] = 1
        out += part @ part.T
    return out


def compared(members: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """Links that join all that links join among (node, role, set); with roles 2, links between these and others."""
    if len(members) < 2:
        return []
    sets = [m[2] for m in members]
    node, role, size = np.array([m[0] for m in members]), np.array([m[1] for m in members]), np.array([len(x) for x in sets])
    both = overlaps(sets)
    link = 100 * both >= 80 * (size[:, None] + size[None, :] - both)
    if (role == 2).any():
        link &= (role == 2)[:, None] ^ (role == 2)[None, :]
    np.fill_diagonal(link, False)
    out, left = [], np.ones(len(members), bool)
    for start in range(len(members)):
        if left[start]:
            left[start], todo = False, [start]
            while todo:
                i = todo.pop()
                new = np.flatnonzero(link[i] & left)
                left[new] = False
                out += [(int(node[i]), int(node[j])) for j in new]
                todo += new.tolist()
    return [(a, b) for a, b in out if a != b]


def join(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles and component_id: one row a document."""
    bound_batches(df.sparkSession)
    own = nodes(df, key, text)
    counts, mean = frequent(own)
    met = meetings(entries(df, text, counts, boundary(mean)))
    # Frequent buckets: a leader for each class of sizes, which members of the next class have too.
    often = met.filter("salt >= 0").select("bucket", "node", "n", F.floor(F.log(1.25, "n")).alias("class")).distinct()
    heads = often.groupBy("bucket", "class").agg(F.min(F.struct("n", "node")).alias("top")).select("bucket", "class", F.col("top.node").alias("leader"))
    often = often.withColumn("class", F.explode(F.array("class", F.col("class") - 1))).join(heads, ["bucket", "class"]).filter("leader <> node").select("leader", "node", "n")
    stars = materialize(met.filter("salt < 0 AND leader <> node").select("leader", "node", "n").union(often).distinct(), release=True, few=True)
    each = stars.groupBy("leader").agg(F.ceil(F.greatest(F.count("*") / DEALT, F.sum("n") / HELD)).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt")
    members = stars.join(each, "leader").select("node", "leader", salt, F.lit(1).alias("role"))
    leaders = each.select(F.col("leader").alias("node"), "leader", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"))
    links = _links(df, key, text, own, members.union(leaders))
    labels = components(links)
    # Members of one leader that were dealt to different tasks and are still apart.
    dealt = each.filter("salts > 1")
    if not dealt.isEmpty():
        placed = stars.join(dealt, "leader").join(labels, "node", "left").select("node", "leader", "salts", F.coalesce("label", "node").alias("label"))
        held = placed.groupBy("leader", "label").agg(F.count("*").alias("c")).groupBy("leader").agg(F.max(F.struct("c", "label")).alias("most"), F.count("*").alias("labels"), F.sum("c").alias("all")).filter("labels > 1")
        placed = placed.join(held.select("leader", F.col("most.label").alias("major"), F.ceil((F.col("all") - F.col("most.c")) / DEALT).cast("int").alias("blocks")), "leader")
        # Each block of members of smaller components meets each task's members: a task holds two blocks.
        block = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
        every = placed.select("node", "leader", salt, "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("k")).select("node", "leader", (F.col("salt") * F.col("blocks") + F.col("k")).alias("salt"), F.lit(1).alias("role"))
        minor = placed.filter("label <> major").select("node", "leader", block.alias("k"), "blocks", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("s")).select("node", "leader", (F.col("s") * F.col("blocks") + F.col("k")).alias("salt"), F.lit(2).alias("role"))
        links = links.union(_links(df, key, text, own, every.union(minor)))
        labels = components(links)
    found = own.join(labels, "node", "left").select("key", "n", F.coalesce("label", "node").alias("label"))
    full = found.filter("n > 0")
    least = full.groupBy("label").agg(F.min("key").alias("least"))
    out = full.join(least, "label").select("key", "n", "least").union(found.filter("n = 0").select("key", "n", F.col("key").alias("least")))
    return out.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), F.col("least").alias("component_id"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df without all but the smallest of each component, by key, then by the text's hash. Rows of one key and
    text are one document, of which the first by its other columns stays; other texts of its key are documents of their
    own. Rows without a key can't be told apart and stay."""
    known = df.filter(F.col(key).isNotNull()).select(F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(text).alias("said"))
    document = F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("said")))
    least = join(df.select(document.alias("document"), F.col(text).alias("text")), "document", "text").select("component_id.*")
    stay = materialize(least.filter(F.col("key").isNotNull()).distinct(), release=True)
    others = F.to_json(F.struct(F.lit(0), *(F.col(f"row.`{c}`") for c in df.columns if c not in (key, text))))
    first = known.join(stay, ["key", "said"], "left_semi").groupBy("key", "said").agg(F.min_by("row", others).alias("row"))
    return first.select("row.*").unionByName(df.filter(F.col(key).isNull()))
