"""Templates, clusters and the review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text


def provisional(rows: DataFrame) -> DataFrame:
    """Rule labels of (source, split, source_index, source_sha256, input, output, task): one projection, no shuffle."""
    shaped = text.cluster_template(F.col("input"))
    return rows.withColumns(
        {
            "template": shaped,
            "cluster_id": text.cluster_id(F.col("source"), shaped),
            "sample_id": text.sample_id(F.col("source"), F.col("source_index"), F.col("source_sha256")),
            "provisional": rules.decide(F.col("source"), F.col("task"), F.col("input")),
        }
    )


def census(df: DataFrame, key: Column, order: list[Column], payload: list[str], name: str = "template_id") -> DataFrame:
    """Members of each template, and the payload of the first in order. Partial aggregation keeps hot templates cheap."""
    first = F.min_by(F.struct(*payload), F.struct(*order))
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("member_count"), first.alias("_first")).select(name, "member_count", *(F.col(f"_first.{c}").alias(c) for c in payload))


def compression(census_: DataFrame, cached: DataFrame | None = None, name: str = "template_id") -> DataFrame:
    """Rows, templates, templates that a cache has, and rows a template, over a census."""
    if cached is not None:
        census_ = census_.join(cached.select(name).distinct().withColumn("hit", F.lit(1)), name, "left")
    else:
        census_ = census_.withColumn("hit", F.lit(None).cast("int"))
    out = census_.agg(F.coalesce(F.sum("member_count"), F.lit(0)).alias("rows"), F.count("*").alias("templates"), F.count("hit").alias("cached"))
    return out.withColumn("pending", F.col("templates") - F.col("cached")).withColumn("ratio", F.when(F.col("templates") == 0, 0.0).otherwise(F.bround(F.col("rows") / F.col("templates"), 3)))


def clusters(labelled: DataFrame, source_order: Column) -> DataFrame:
    """One row a cluster: the first member in (source, index) order, and the number of members."""
    order = F.struct(source_order, F.col("source_index"))
    kept = ["source", "split", "input", "output", "template", "provisional"]
    out = labelled.groupBy("cluster_id").agg(F.count("*").alias("member_count"), F.min_by(F.struct(*kept), order).alias("f"))
    return out.select("cluster_id", "member_count", "f.*")


def review_queue(clusters_: DataFrame, limit: int = 0) -> DataFrame:
    """Clusters whose first member is up for review, largest first (the first so many, if limited). A cluster whose first
    member was accepted never is."""
    out = clusters_.filter("provisional.status = 'review'").orderBy(F.desc("member_count"), "cluster_id")
    return out.limit(limit) if limit else out


def rule_counters(labelled: DataFrame) -> DataFrame:
    """kind, value, rows: counts by source, primary label, fit and status, in one pass."""
    cols = {"source": F.col("source"), "primary": F.coalesce("provisional.primary_label", F.lit("NONE")), "fit": F.col("provisional.taxonomy_fit"), "status": F.col("provisional.status")}
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), c.alias("value")) for k, c in cols.items())))
    return labelled.select(pairs.alias("p")).groupBy("p.kind", "p.value").agg(F.count("*").alias("rows"))


def missing(wanted: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """What a cache lacks: the calls left to make on resume."""
    return wanted.join(cache.select(*keys).distinct(), keys, "left_anti")


def latest_cached(cache: DataFrame, key: str, model: str, version: str, line: str) -> DataFrame:
    """The last line of each key that the same model and prompt version wrote."""
    names = [c for c in cache.columns if c != key]
    own = cache.filter((F.col("model") == model) & (F.col("prompt_version") == version))
    return own.groupBy(key).agg(F.max_by(F.struct(*names), F.col(line)).alias("l")).select(key, "l.*")


def expanded(members: DataFrame, labels: DataFrame, key: str = "template_id") -> DataFrame:
    """Each template's label for all of its members."""
    return members.join(labels, key)
