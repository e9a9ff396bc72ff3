"""Joining rows with ability and quality labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNMAPPED, MISSING = "UNMAPPED", "MISSING"


def zipped(left: DataFrame, right: DataFrame, keys: list[str], name: str) -> DataFrame:
    """A positional zip by key; a row that stands alone on either side makes the job fail."""
    a, b = left.withColumn("_l", F.lit(1)), right.withColumn("_r", F.lit(1))
    both = a.join(b, keys, "full_outer")
    whole = F.when(F.col("_l").isNull() | F.col("_r").isNull(), F.raise_error(F.concat(F.lit(f"{name}: unmatched row "), F.to_json(F.struct(*keys)))))
    return both.filter(F.coalesce(whole.cast("boolean"), F.lit(True))).drop("_l", "_r")


def matched(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows (source, source_index, digest) with ``label_index`` and ``join_method``.

    Direct: same place and digest. The rest take labels of the same digest that no direct match used, in order of place,
    each once: the k-th row left takes the k-th label left. Labels are one a place. They meet rows by place, so a store that is
    dealt by place isn't dealt anew; only digests of labels without a direct match are.
    """
    # Names differ on both sides, as rows and labels may come of one table.
    have = labels.select(F.col("source").alias("_source"), F.col("source_index").alias("label_index"), F.col("digest").alias("_digest"))
    # Digests are compared after the join: as a third key they would have both sides dealt anew.
    met = rows.join(have, F.expr("source = _source AND source_index = label_index"), "left").drop("_source")
    met = met.withColumn("_direct", F.coalesce(F.col("_digest") == F.col("digest"), F.lit(False))).drop("_digest")
    direct = met.filter("_direct").drop("_direct").withColumn("join_method", F.lit("taxonomy_direct_hash"))
    left = met.filter("NOT _direct").drop("label_index", "_direct")
    own = rows.select(F.col("source").alias("_s"), F.col("source_index").alias("_i"), F.col("digest").alias("_d"))
    unused = have.join(own, F.expr("_source = _s AND label_index = _i"), "left")
    spare = unused.filter(F.coalesce(F.col("_d") != F.col("_digest"), F.lit(True))).select(F.col("_source").alias("source"), F.col("_digest").alias("digest"), "label_index")
    left = numbered(left, "k", by=["source", "digest"])
    spare = numbered(spare, "k", by=["source", "digest"], order="label_index")
    found = left.join(spare, ["source", "digest", "k"], "left").drop("k")
    found = found.withColumn("join_method", F.when(F.col("label_index").isNotNull(), "taxonomy_digest_recovery").otherwise("missing"))
    return direct.unionByName(found.select(*direct.columns))


def numbered(rows: DataFrame, name: str, block: int = 1 << 16, by: list[str] | None = None, order: str = "source_index") -> DataFrame:
    """rows with the number (from 1) of each within its source (or the columns ``by``), in ascending order of a whole number.

    Two levels: within blocks of that number, and over the counts of the blocks before, one row a group and block. So no
    group, however many rows it has, is gathered in one task; a block holds as many rows as it has numbers, if these are
    different within a group. Rows whose group has a null are numbered as well."""
    by = by or ["source"]
    own = rows.withColumn("_block", F.floor(F.col(order) / block))
    counts = own.groupBy(*by, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*(F.col(c).alias(f"_by{i}") for i, c in enumerate(by)), F.col("_block").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = Window.partitionBy(*by, "_block").orderBy(order)
    same = F.col("_block").eqNullSafe(F.col("_of"))
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    out = own.withColumn("_k", F.row_number().over(within)).join(shift, same)
    return out.withColumn(name, F.col("_k") + F.col("_shift")).drop("_block", "_k", "_shift", "_of", *(f"_by{i}" for i in range(len(by))))


def aligned(clean: DataFrame, raw: DataFrame) -> DataFrame:
    """The k-th clean row (source, source_index, canonical) with the k-th valid raw row's label; other content fails."""
    a = numbered(clean, "k")
    b = numbered(raw.filter("valid"), "k").select("source", "k", F.col("source_index").alias("label_index"), F.col("canonical").alias("raw_canonical"))
    out = a.join(b, ["source", "k"], "full_outer")
    wrong = F.when(~F.col("canonical").eqNullSafe(F.col("raw_canonical")), F.raise_error(F.concat(F.lit("clean and raw rows differ at "), F.col("source"), F.lit(":"), F.col("k").cast("string"))))
    return out.filter(F.coalesce(wrong.cast("boolean"), F.lit(True))).drop("k", "raw_canonical").withColumn("join_method", F.lit("taxonomy_clean_sequence"))


def ability(final: Column, provisional: Column, audit: Column | None = None) -> Column:
    """ability_label, its source, status, confidence and fit: final, then proposed, then provisional, then the audit."""

    def told(label: Column, source: str, status: Column, confidence: Column, fit: Column) -> Column:
        return F.struct(label.alias("ability_label"), F.coalesce(label, F.lit(UNMAPPED)).alias("ability_bucket"), F.lit(source).alias("ability_label_source"), status.alias("ability_status"), confidence.cast("double").alias("ability_confidence"), fit.alias("taxonomy_fit"))

    no = F.lit(None).cast("string")
    has = final.isNotNull() | provisional.isNotNull()
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    out = (
        F.when(filled(final["primary_label"]), told(final["primary_label"], "final", F.coalesce(final["status"], F.lit("accepted")), final["confidence"], final["taxonomy_fit"]))
        .when(filled(final["proposed_primary_label"]), told(final["proposed_primary_label"], "final_proposed", F.lit("human_review"), final["proposed_confidence"], final["proposed_taxonomy_fit"]))
        .when(filled(provisional["primary_label"]), told(provisional["primary_label"], "provisional", F.coalesce(final["status"], provisional["status"], F.lit("review")), provisional["confidence"], provisional["taxonomy_fit"]))
        .when(has, told(no, "unmapped", F.when(F.coalesce(provisional["taxonomy_fit"], final["taxonomy_fit"]) == "out_of_scope", "out_of_scope").otherwise("unmapped"), F.coalesce(provisional["confidence"], final["confidence"]), F.coalesce(provisional["taxonomy_fit"], final["taxonomy_fit"])))
    )
    if audit is not None:
        out = out.when(filled(audit["primary_label"]), told(audit["primary_label"], "audit_fallback", F.coalesce(audit["status"], F.lit("audit_fallback")), audit["confidence"], audit["taxonomy_fit"]))
    return out.otherwise(told(no, "unmapped", F.lit("unmapped"), F.lit(None), no))


def with_quality(rows: DataFrame, quality: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """rows with quality and difficulty where labelled. Labels must be one a key and carry the row's template_id."""
    once = quality.groupBy(*keys).agg(F.count_distinct(F.struct(*(c for c in quality.columns if c not in keys))).alias("n"), *(F.any_value(c).alias(c) for c in quality.columns if c not in keys))
    once = once.filter(F.coalesce(F.when(F.col("n") > 1, F.raise_error(F.lit("conflicting quality labels"))).cast("boolean"), F.lit(True))).drop("n")
    if "template_id" in quality.columns and "template_id" in rows.columns:
        once = once.withColumnRenamed("template_id", "quality_template_id")
    out = rows.join(once, keys, "left")
    if "quality_template_id" in out.columns:
        bad = F.when(F.col("quality_template_id") != F.col("template_id"), F.raise_error(F.lit("quality label of another template")))
        out = out.filter(F.coalesce(bad.cast("boolean"), F.lit(True)))
    if strict:
        out = out.filter(F.coalesce(F.when(F.col("quality").isNull(), F.raise_error(F.lit("row without a quality label"))).cast("boolean"), F.lit(True)))
    return out


def check_fields(sample: DataFrame, annotation: DataFrame) -> None:
    """Annotation fields must not overwrite a sample's."""
    if both := set(sample.columns) & set(annotation.columns):
        raise ValueError(f"annotation field collision: {sorted(both)}")
