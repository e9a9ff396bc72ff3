"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws -ln(u) / weight, where u in (0, 1] comes from
the hash of the row's key and the child's name, and the smallest draw wins. A draw depends on nothing but key, child
and weight, so that a changed weight moves rows only between the changed subtree and its siblings. A new shard gets a
region of its own: then rows move only into it, and a row's place depends on its key and the number of shards alone.

Defined results: a null key is hashed as the empty string and gets a place like any other; equal keys share a shard;
empty and null texts have size 1; ties of equal draws go to the first child; repeated rows get a slot each; an empty
table gives an empty result; columns that aren't named are ignored. Only Column expressions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import with_ranks

BITS = 52  # of the hash, exact in a double


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. A shard has a number and no children; an inner node weighs what its shards weigh."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int = -1
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(shards: int = 8, regions: int = 2, racks: int = 2) -> Node:
    """Equal shards under ``regions`` times ``racks`` racks; numbers run through the racks."""
    per = -(-shards // (regions * racks))
    at, top = 0, []
    for r in range(regions):
        inner = []
        for k in range(racks):
            own = tuple(Node(f"shard{i}", shard=i) for i in range(at, min(at + per, shards)))
            at += len(own)
            if own:
                inner.append(Node(f"region{r}/rack{k}", own))
        if inner:
            top.append(Node(f"region{r}", tuple(inner)))
    return Node("root", tuple(top))


def grown(root: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region of its own."""
    n, r = count(root), len(root.children)
    one = Node(f"region{r}", (Node(f"region{r}/rack0", (Node(f"shard{n}", shard=n, own_weight=weight),)),))
    return Node(root.name, (*root.children, one))


def count(root: Node) -> int:
    return sum(map(count, root.children)) if root.children else 1


def draw(key: Column, node: Node) -> Column:
    """The weighted draw of a node for a key (string): smaller is better."""
    hashed = F.conv(F.substring(F.md5(F.concat(key, F.lit("|" + node.name))), 1, BITS // 4), 16, 10).cast("double")
    return -F.ln((hashed + 1) / float(2**BITS)) / float(node.weight)


def place(key: Column, node: Node) -> Column:
    """The shard that a key reaches from ``node``."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return place(key, node.children[0])
    best = F.least(*(F.struct(draw(key, c), F.lit(i)) for i, c in enumerate(node.children)))["col2"]
    out = place(key, node.children[-1])
    for i, c in reversed(list(enumerate(node.children[:-1]))):
        out = F.when(best == i, place(key, c)).otherwise(out)
    return out


def assign(df: DataFrame, key: str = "doc_id", text: str = "text", root: Node | None = None, more: Node | None = None) -> DataFrame:
    """key, size, text_crc32, shard, grown_shard, slot. Slots count the rows of a shard from 0, in order of key.

    Texts are read once and never shuffled: only key, size, checksum and shard are.
    """
    root = root or tree()
    more = more or grown(root)
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), place(name, root).cast("int").alias("shard"), place(name, more).cast("int").alias("grown_shard"))
    return with_ranks(rows, ["shard"], [key, "text_crc32"], "slot")
