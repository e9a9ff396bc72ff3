"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, label for every node of ``edges`` (a, b): nodes share a label where edges join them.

    Each round every node points to its smallest neighbour (or itself), pointers are followed once, edges are carried
    over to what their ends point to, and loops go. Edges shrink fast; rounds are about the logarithm of the longest
    chain. Nothing but counts comes to the driver.
    """
    maps: list[DataFrame] = []
    left = edges.filter("a <> b").select("a", "b").distinct()
    while True:
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), few=True)
        follow = to.alias("x").join(to.alias("y"), F.col("x.to") == F.col("y.a"))
        to = materialize(follow.select(F.col("x.a").alias("a"), F.col("y.to").alias("to")), few=True)
        if to.isEmpty():
            break
        maps.append(to)
        left = left.join(to, "a").select(F.col("to").alias("p"), "b").join(to.withColumnRenamed("a", "b"), "b").select(F.col("p").alias("a"), F.col("to").alias("b")).filter("a <> b").distinct()
        left = materialize(left, few=True)
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0)
    out = maps[0].select(F.col("a").alias("node"), F.col("to").alias("label"))
    for to in maps[1:]:
        out = out.join(to, out["label"] == to["a"], "left").select("node", F.coalesce("to", "label").alias("label"))
    return materialize(out, few=True)
