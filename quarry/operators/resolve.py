"""Votes and the resolution of provisional labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text

AGREEMENT = 0.85
VOTE = "struct<primary_label:string,secondary_labels:array<string>,taxonomy_fit:string,confidence:string,rationale:string>"


def parsed_vote(reply: Column) -> Column:
    """A model's reply as a vote, or null where it isn't a valid one: labels, fit and confidence are checked."""
    vote = text.read_object(reply, VOTE)
    label, fit = vote["primary_label"], vote["taxonomy_fit"]
    second = F.coalesce(vote["secondary_labels"], F.array().cast("array<string>"))
    sure = F.when(vote["confidence"].isNull(), 0.0).otherwise(vote["confidence"].try_cast("double"))
    good = vote.isNotNull() & fit.isin(*rules.FITS) & (label.isNull() | label.isin(*rules.LABELS)) & _known_labels(second) & F.coalesce(sure.between(0, 1), F.lit(False))
    return F.when(good, F.struct(label.alias("primary_label"), F.array_sort(F.array_distinct(F.filter(second, lambda x: label.isNull() | (x != label)))).alias("secondary_labels"), fit.alias("taxonomy_fit"), sure.alias("confidence"), F.substring(F.coalesce(vote["rationale"], F.lit("")), 1, 1000).alias("rationale")))


def parsed_quality(reply: Column) -> Column:
    """A model's reply as quality, difficulty and reason (500 characters), or null."""
    said = text.read_object(reply, "struct<quality:string,difficulty:string,reason:string>")
    good = said["quality"].isin(*QUALITY) & said["difficulty"].isin(*DIFFICULTY) & (F.trim(F.coalesce(said["reason"], F.lit(""))) != "")
    return F.when(good, F.struct(said["quality"].alias("quality"), said["difficulty"].alias("difficulty"), F.substring(text.compact(said["reason"]), 1, 500).alias("reason")))


# Ordinal levels, lowest first.
QUALITY = ("unusable", "weak", "acceptable", "good", "excellent")
DIFFICULTY = ("very_easy", "easy", "moderate", "hard", "very_hard")


def human_labels(sheet: DataFrame, order: Column | None = None) -> DataFrame:
    """A review sheet's rows: blank fits are left out, null words read as null, secondaries split, sorted, less the primary.

    An unknown fit, label or secondary label fails the job. Of several rows of a cluster the last one counts, by order or
    else as the sheet was read. Without a column of rationales or reviewers these are empty.
    """
    told = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in sheet.columns else F.lit("")
    rows = sheet.withColumn("_at", F.monotonically_increasing_id() if order is None else order)
    rows = rows.withColumns({"fit": told("human_taxonomy_fit"), "label": told("human_primary_label"), "second": told("human_secondary_labels"), "rationale": told("human_rationale"), "reviewer": told("reviewer")}).filter("fit <> ''")
    rows = _refused(rows, ~F.col("fit").isin(*rules.FITS), "invalid human taxonomy_fit: ", F.col("fit"))
    rows = rows.withColumn("label", F.when(~F.lower("label").isin("", "none", "null"), F.col("label")))
    rows = _refused(rows, F.col("label").isNotNull() & ~F.col("label").isin(*rules.LABELS), "invalid human primary_label: ", F.col("label"))
    rows = rows.withColumn("seconds", F.filter(F.split("second", r"[\s,;|]+"), lambda x: x != ""))
    rows = _refused(rows, ~_known_labels(F.col("seconds")), "invalid human secondary_labels: ", F.col("second"))
    second = F.array_sort(F.array_distinct(F.filter("seconds", lambda x: F.col("label").isNull() | (x != F.col("label")))))
    fields = [F.col("label").alias("primary_label"), second.alias("secondary_labels"), F.col("fit").alias("taxonomy_fit"), "rationale", "reviewer"]
    return rows.groupBy("cluster_id").agg(F.max_by(F.struct(*fields), F.col("_at")).alias("_h")).select("cluster_id", "_h.*")


def _known_labels(labels: Column) -> Column:
    known = F.array(*map(F.lit, rules.LABELS))
    return F.forall(labels, lambda x: F.array_contains(known, x))


def human_records(rows: DataFrame, order: Column | None = None) -> DataFrame:
    """Human labels that come as records (JSON lines): cluster_id, primary_label, secondary_labels, taxonomy_fit (exact, where
    it isn't given). An unknown label fails; of several records of a cluster the last one counts, as in ``human_labels``."""
    kind = {"secondary_labels": "array<string>"}
    col = lambda c: F.col(c).cast(kind.get(c, "string")) if c in rows.columns else F.lit(None).cast(kind.get(c, "string"))
    at = F.monotonically_increasing_id() if order is None else order
    out = rows.select(at.alias("_at"), F.col("cluster_id").cast("string").alias("cluster_id"), col("primary_label").alias("primary_label"), F.coalesce(col("secondary_labels"), F.array().cast("array<string>")).alias("secondary_labels"), F.coalesce(col("taxonomy_fit"), F.lit("exact")).alias("taxonomy_fit"))
    out = _refused(out, F.col("primary_label").isNotNull() & ~F.col("primary_label").isin(*rules.LABELS), "invalid human primary_label: ", F.col("primary_label"))
    names = [c for c in out.columns if c not in ("cluster_id", "_at")]
    return out.groupBy("cluster_id").agg(F.max_by(F.struct(*names), F.col("_at")).alias("_h")).select("cluster_id", "_h.*")


def read_votes(rows: DataFrame, vote: str = "vote", place: str = "seen") -> DataFrame:
    """Vote records (cluster_id, vote as JSON text, place) as rows for ``tally``; a record whose vote isn't valid fails."""
    found = rows.select(F.col("cluster_id"), F.col(place).alias("seen"), F.col(vote).alias("raw"), parsed_vote(F.col(vote)).alias("v"))
    return _refused(found, F.col("v").isNull(), "invalid vote: ", F.col("raw")).select("cluster_id", "seen", "v.*")


def one_each(votes: DataFrame, what: str = "authoritative votes") -> DataFrame:
    """votes; a cluster with several of them fails."""
    names = [c for c in votes.columns if c != "cluster_id"]
    out = votes.groupBy("cluster_id").agg(F.count("*").alias("_n"), F.any_value(F.struct(*names)).alias("_v"))
    return _refused(out, F.col("_n") > 1, f"{what} must be one a cluster: ", F.col("cluster_id").cast("string")).select("cluster_id", "_v.*")


def _refused(df: DataFrame, wrong: Column, message: str, value: Column) -> DataFrame:
    return df.filter(F.coalesce(F.when(wrong, F.raise_error(F.concat(F.lit(message), F.coalesce(value, F.lit(""))))).cast("boolean"), F.lit(True)))


def tally(votes: DataFrame) -> DataFrame:
    """Votes (cluster_id, seen, primary_label, secondary_labels, taxonomy_fit, confidence) by cluster: the winner by
    count and then by first appearance, and what those that agree with it say."""
    by = votes.groupBy("cluster_id", "primary_label").agg(
        F.count("*").alias("agree"), F.min("seen").alias("first"), F.avg("confidence").alias("confidence"), F.max("confidence").alias("best"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("secondary_labels")))).alias("secondary_labels")
    )
    fits = votes.groupBy("cluster_id", "primary_label", "taxonomy_fit").agg(F.count("*").alias("c"), F.min("seen").alias("s"))
    fits = fits.groupBy("cluster_id", "primary_label").agg(F.min_by("taxonomy_fit", F.struct(-F.col("c"), "s")).alias("taxonomy_fit"))
    same = by["cluster_id"].eqNullSafe(fits["cluster_id"]) & by["primary_label"].eqNullSafe(fits["primary_label"])
    joined = by.join(fits, same).select(by["cluster_id"], by["primary_label"], "agree", "first", "confidence", "best", "secondary_labels", "taxonomy_fit")
    win = F.min_by(F.struct("primary_label", "agree", "secondary_labels", "taxonomy_fit", F.bround("confidence", 4).alias("confidence")), F.struct(-F.col("agree"), "first"))
    return joined.groupBy("cluster_id").agg(F.sum("agree").alias("votes"), win.alias("winner"), F.max("best").alias("best"))


def resolve(labelled: DataFrame, human: DataFrame, authoritative: DataFrame, tallied: DataFrame) -> DataFrame:
    """labelled with ``final``: human, then accepted rules, then the authoritative model, then consensus, then one vote
    that agrees with the rules; else human review. A winner may be no label, which excludes. Several human labels or
    several authoritative votes of one cluster fail."""
    authoritative, human = one_each(authoritative), one_each(human, "human labels")
    pack = lambda df, name: df.select("cluster_id", F.struct(*(c for c in df.columns if c != "cluster_id")).alias(name))
    rows = labelled.join(pack(human, "h"), "cluster_id", "left").join(pack(authoritative, "a"), "cluster_id", "left").join(pack(tallied, "t"), "cluster_id", "left")

    def final(label: Column, second: Column, fit: Column, confidence: Column, method: str) -> Column:
        status = F.when(label.isNotNull(), "accepted").otherwise("excluded")
        return F.struct(label.alias("primary_label"), F.coalesce(second, F.array().cast("array<string>")).alias("secondary_labels"), fit.alias("taxonomy_fit"), confidence.cast("double").alias("confidence"), status.alias("status"), F.lit(method).alias("method"))

    p, h, a, t = (F.col(x) for x in ("provisional", "h", "a", "t"))
    w = t["winner"]
    proposed = F.coalesce(p["primary_label"], p["closest_label"])
    none = F.struct(F.lit(None).cast("string").alias("primary_label"), F.array().cast("array<string>").alias("secondary_labels"), F.coalesce(p["taxonomy_fit"], F.lit("out_of_scope")).alias("taxonomy_fit"), F.lit(0.0).alias("confidence"), F.lit("human_review").alias("status"), F.lit("unresolved").alias("method"))
    out = (
        F.when(h.isNotNull(), final(h["primary_label"], h["secondary_labels"], h["taxonomy_fit"], F.lit(1.0), "human"))
        .when(p["status"] == "auto_accept", final(p["primary_label"], p["secondary_labels"], p["taxonomy_fit"], p["confidence"], "rules"))
        .when(a.isNotNull(), final(a["primary_label"], a["secondary_labels"], a["taxonomy_fit"], F.bround(a["confidence"], 4), "authoritative_model"))
        .when((t["votes"] >= 2) & (w["agree"] >= 2), final(w["primary_label"], w["secondary_labels"], w["taxonomy_fit"], w["confidence"], "model_consensus"))
        .when((t["votes"] == 1) & w["primary_label"].eqNullSafe(proposed) & (t["best"] >= AGREEMENT), final(w["primary_label"], w["secondary_labels"], w["taxonomy_fit"], w["confidence"], "rule_model_agreement"))
        .otherwise(none)
    )
    return rows.withColumn("final", out).drop("h", "a", "t")


def coverage(queue: DataFrame, votes: DataFrame) -> DataFrame:
    """Queue against votes: clusters without a vote, votes without a cluster, clusters with several votes."""
    given = votes.groupBy("cluster_id").agg(F.count("*").alias("n"))
    both = queue.select("cluster_id", F.lit(1).alias("asked")).join(given, "cluster_id", "full_outer")
    return both.agg(F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("asked").isNull()).alias("unexpected"), F.count_if(F.col("n") > 1).alias("duplicates"))
