"""Joint distributions: zero-filled cubes, shares, summaries and coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import percent


def levels(spark, name: str, values: list[str]) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, values))).alias(name))  # one partition


def cube(df: DataFrame, dims: list[str]) -> DataFrame:
    """Counts of each cell, MISSING for nulls."""
    return df.groupBy(*(F.coalesce(F.col(d), F.lit("MISSING")).alias(d) for d in dims)).agg(F.count("*").alias("count"))


def zero_filled(cells: DataFrame, domains: dict[str, list[str]], within: str) -> DataFrame:
    """Every combination of the domains with its count, percent of all and percent within one dimension.

    The domains are fixed lists, so their product is small whatever the data; totals count cells outside them too.
    """
    spark, dims = cells.sparkSession, list(domains)
    grid = reduce(lambda a, b: a.crossJoin(b), (levels(spark, d, v) for d, v in domains.items()))
    total = cells.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"))
    part = cells.groupBy(within).agg(F.sum("count").alias("part"))
    out = grid.join(cells, dims, "left").join(part, within, "left").crossJoin(total)
    n = F.coalesce("count", F.lit(0))
    return out.select(*dims, n.alias("count"), percent(n, F.col("total")).alias("percent_all"), percent(n, F.coalesce("part", F.lit(0))).alias("percent_within"))


def rolled_up(cells: DataFrame, by: str, dim: str) -> DataFrame:
    """Counts by ``by`` and one dimension, over all levels of the others."""
    return cells.groupBy(by, dim).agg(F.sum("count").alias("count"))


def membership(flags: Column, flag: str) -> Column:
    """Whether a row carries a flag."""
    return F.coalesce(F.array_contains(flags, flag), F.lit(False))


def status_table(df: DataFrame, group: Column, status: Column) -> DataFrame:
    """Rows of each status by group, with percents of the group."""
    counts = df.groupBy(group.alias("dataset_group"), F.coalesce(status, F.lit("missing")).alias("status")).agg(F.count("*").alias("count"))
    total = counts.groupBy("dataset_group").agg(F.sum("count").alias("total"))
    return counts.join(total, "dataset_group").select("dataset_group", "status", "count", percent(F.col("count"), F.col("total")).alias("percent"))


def marginals(cells: DataFrame, dims: list[str]) -> DataFrame:
    """dimension, value, count for each dimension on its own, in one pass over the cells."""
    pairs = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dims)))
    return cells.select(pairs.alias("p"), "count").groupBy("p.dimension", "p.value").agg(F.sum("count").alias("count"))


def ability_summary(cells: DataFrame, by: str, high: Column, hard: Column) -> DataFrame:
    """Count, percent of all and percents of good and of hard rows of each value of ``by``."""
    total = cells.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"))
    out = cells.groupBy(by).agg(F.sum("count").alias("count"), F.sum(F.when(high, F.col("count")).otherwise(0)).alias("h"), F.sum(F.when(hard, F.col("count")).otherwise(0)).alias("d")).crossJoin(total)
    return out.select(by, "count", percent(F.col("count"), F.col("total")).alias("percent_all"), percent(F.col("h"), F.col("count")).alias("high_percent"), percent(F.col("d"), F.col("count")).alias("hard_percent"))


def coverage(df: DataFrame, by: str, quality: Column, ability: Column, method: Column) -> DataFrame:
    """Rows with quality and ability labels by source, and how rows were joined (JSON)."""
    methods = df.groupBy(by, method.alias("m")).agg(F.count("*").alias("n")).groupBy(by).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("m", "n"))))).alias("join_methods"))
    rows = df.groupBy(by).agg(F.count("*").alias("total_rows"), F.count_if(quality.isNotNull()).alias("quality_labeled_rows"), F.count_if(ability.isNotNull()).alias("ability_rows"))
    rows = rows.withColumns({"quality_coverage_percent": percent(F.col("quality_labeled_rows"), F.col("total_rows")), "ability_coverage_percent": percent(F.col("ability_rows"), F.col("total_rows")), "ability_unmapped_rows": F.col("total_rows") - F.col("ability_rows")})
    return rows.join(methods, by)


def long_summary(cells: DataFrame, by: str, dims: dict[str, list[str]]) -> DataFrame:
    """by, dimension, label, count, percent within (by, dimension): levels without rows have 0."""
    spark = cells.sparkSession
    pairs = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.lit(v).alias("label")) for d, values in dims.items() for v in values)))
    grid = spark.range(0, 1, 1, 1).select(pairs.alias("p")).select("p.*")
    tall = cells.select(by, "count", F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).alias("label")) for d in dims))).alias("p"))
    sums = tall.groupBy(by, "p.dimension", "p.label").agg(F.sum("count").alias("count"))
    totals = sums.groupBy(by, "dimension").agg(F.sum("count").alias("total"))
    out = cells.select(by).distinct().crossJoin(grid).join(sums, [by, "dimension", "label"], "left").join(totals, [by, "dimension"])
    n = F.coalesce("count", F.lit(0))
    return out.select(by, "dimension", "label", n.alias("count"), percent(n, F.col("total")).alias("percent"))


def wide_summary(cells: DataFrame, by: str, dim: str, values: list[str]) -> DataFrame:
    """One row of counts a value of ``by``; the columns are a fixed list."""
    out = cells.groupBy(by).pivot(dim, values).agg(F.sum("count"))
    return out.select(by, *(F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("long").alias(f"{dim}_{v}") for v in values))


def distribution(df: DataFrame, group: Column, label: Column, accepted: Column, labels: list[str]) -> DataFrame:
    """Accepted rows of each label by group, zero-filled, with percents of the group's accepted rows of these labels.
    Other labels count nowhere; a group that has only such rows is listed with zeros."""
    own = df.select(group.alias("dataset_group"), F.when(accepted & label.isin(*labels), label).alias("label"))
    counts = own.filter(F.col("label").isNotNull()).groupBy("dataset_group", "label").agg(F.count("*").alias("n"))
    totals = counts.groupBy("dataset_group").agg(F.sum("n").alias("total"))
    grid = own.select("dataset_group").distinct().crossJoin(levels(df.sparkSession, "label", labels))
    out = grid.join(counts, ["dataset_group", "label"], "left").join(totals, "dataset_group", "left")
    n = F.coalesce("n", F.lit(0))
    return out.select("dataset_group", "label", n.alias("count"), percent(n, F.coalesce("total", F.lit(0))).alias("percent"))


def dataset_group(source: Column, prefixes: dict[str, str]) -> Column:
    """A source's group: the first prefix that it has, else itself."""
    out = source
    for prefix, name in reversed(list(prefixes.items())):
        out = F.when(source.startswith(prefix), F.lit(name)).otherwise(out)
    return out


def histogram(df: DataFrame, flags: Column) -> DataFrame:
    """Rows of each flag, most first, with percents of all rows."""
    total = df.agg(F.count("*").alias("total"))
    out = df.select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("count")).crossJoin(total)
    return out.select("flag", "count", percent(F.col("count"), F.col("total")).alias("percent")).orderBy(F.desc("count"), "flag")


def markdown(rows: DataFrame, title: str, most: int = 1000) -> str:
    """A small result as a Markdown table."""
    names = rows.columns
    lines = [f"# {title}", "", "| " + " | ".join(names) + " |", "|" + "---|" * len(names)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.limit(most).collect()]
    return "\n".join(lines) + "\n"
