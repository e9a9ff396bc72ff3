"""Eligibility, deterministic caps and training buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules

# The defaults of a materialisation.
LEAST_CONFIDENCE, TRAIN_FITS, SEED = 0.85, ("exact", "compatible"), 42


def eligible(final: Column, split: Column, least: float = LEAST_CONFIDENCE, fits: tuple[str, ...] = TRAIN_FITS, splits: tuple[str, ...] = ("train",)) -> Column:
    """Whether a row may train: accepted, a known label, confident enough, a fit and a split that are wanted."""
    return F.coalesce((final["status"] == "accepted") & final["primary_label"].isin(*rules.LABELS) & (final["confidence"] >= least) & final["taxonomy_fit"].isin(*fits) & split.isin(*splits), F.lit(False))


def score(key: Column, seed: int = SEED) -> Column:
    """A place in a fixed random order."""
    return F.sha2(F.concat(F.lit(f"{seed}\0"), key.cast("string")), 256)


def capped(df: DataFrame, cluster: list[str], key: str, most: int, seed: int = SEED) -> DataFrame:
    """At most so many rows of each cluster, those of smallest score; 0: all. Rows beyond go before the shuffle."""
    if most <= 0:
        return df
    order = Window.partitionBy(*cluster).orderBy(score(F.col(key), seed), key)
    return df.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= most).drop("_r")


def cap_report(df: DataFrame, cluster: list[str], most: int) -> DataFrame:
    """Candidates, what a cap keeps and takes, clusters, those that it cuts, and the largest."""
    sizes = df.groupBy(*cluster).agg(F.count("*").alias("n"))
    kept = F.least("n", F.lit(most)) if most > 0 else F.col("n")
    out = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"), F.coalesce(F.sum(kept), F.lit(0)).alias("selected"), F.count("*").alias("clusters"), F.count_if(F.col("n") > (most if most > 0 else 1 << 62)).alias("capped"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))
    return out.withColumn("filtered", F.col("candidates") - F.col("selected"))


def cap_report_by(df: DataFrame, cluster: list[str], most: int, by: str) -> DataFrame:
    """Candidates, selected and filtered rows of a cap by source or label; a cluster may have rows of several labels, so
    what is selected is told by rank within the cluster (``rank``, from 1, as ``ranked`` gives it)."""
    kept = F.col("rank") <= most if most > 0 else F.lit(True)
    out = df.groupBy(by).agg(F.count("*").alias("candidates"), F.count_if(kept).alias("selected"))
    return out.withColumn("filtered", F.col("candidates") - F.col("selected"))


def ranked(df: DataFrame, cluster: list[str], key: str, seed: int = SEED) -> DataFrame:
    """df with each row's rank in its cluster, by the order in which a cap takes rows."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*cluster).orderBy(score(F.col(key), seed), key)))


def only(df: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of df whose keys were chosen."""
    return df.join(chosen.select(*keys).distinct(), keys, "left_semi")


def write_buckets(df: DataFrame, label: Column, path: str, order: list[str]) -> None:
    """One folder a label; its files, one after another by name, keep the order of the sources. Rows are dealt by ranges of
    (label, order), so a large label is many files. A folder that holds data is refused."""
    labelled = df.withColumn("primary_label", label)
    labelled.repartitionByRange("primary_label", *order).sortWithinPartitions("primary_label", *order).write.mode("errorifexists").partitionBy("primary_label").json(path)
