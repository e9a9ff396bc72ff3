"""Composites: what a user calls. Each is one lineage; what several writes share is materialised once by Parquet."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.series import Options
from ..operators import cluster, convert, merge, reports, resolve, selection, views
from ..operators.review import Conflict
from ..sources import commits, files, readers


def convert_files(spark: SparkSession, inputs: list[str], adapter: str, out: str, options: Options = Options(), train_only: bool = True, dedup: bool = True, limit: int = 0, preview: int = 0) -> dict:  # noqa: B008
    """Converts files to samples, audit rows and a manifest under ``out``. Files of other splits and contaminated folders
    aren't opened; contaminated rows go before they are parsed. limit: the first so many samples in the order of files and
    rows; preview: so many of them, shortened, in what is returned."""
    paths = readers.discover(spark, inputs)
    names = spark.createDataFrame([(p,) for p in paths], "path string")
    wanted = names.filter(~convert.is_contaminated_file(F.col("path")) & (convert.is_training_file(F.col("path")) if train_only else F.lit(True)))
    kept = [r.path for r in wanted.orderBy("path").collect()]  # file names only
    if not kept:
        raise FileNotFoundError("no input files are left")
    order = spark.createDataFrame([(p.split(":", 1)[-1].lstrip("/"), i) for i, p in enumerate(kept)], "_name string, _file int")
    rows = readers.read_many(spark, kept).withColumn("_name", F.regexp_replace("_path", "^[a-z0-9]+:/*|^/+", ""))
    rows = rows.join(F.broadcast(order), "_name", "left").drop("_name")  # one row a file, as the driver lists them
    dataset = convert.field(rows, ("dataset", "dataset_name", "source_dataset"))
    seen = Observation("rows")
    clean = rows.observe(seen, F.count(F.lit(1)).alias("n")).filter(~convert.is_contaminated_row(dataset))
    done = convert.converted(clean, adapter, options)
    done.write.mode("errorifexists").parquet(f"{out}/converted")
    done = spark.read.parquet(f"{out}/converted")
    good = done.filter("sample.reason IS NULL").withColumn("sample_sha256", convert.sample_digest(F.col("sample")))
    place = ["_file", "_start", "_at", "_item"]
    if dedup:
        good = convert.first_of_each(good, F.col("sample_sha256"), [F.col(c) for c in place])
    if limit:
        good = good.orderBy(*place).limit(limit)
    good.write.parquet(f"{out}/kept")
    good = spark.read.parquet(f"{out}/kept")
    good.select("sample.input", "sample.timeseries", "sample.output").write.json(f"{out}/samples")
    told = lambda name, *aliases: convert.field(good, aliases or (name,)).alias(name)
    tags = [told("source_dataset", "dataset", "dataset_name", "source_dataset"), F.col("_path").alias("source_file"), told("task", "task", "task_type"), told("question_type"), told("dataset_name"), told("domain", "domain", "application_domain")]
    good.select("sample_sha256", *tags, F.size("sample.timeseries").alias("series_count"), F.transform("sample.timeseries", lambda s: F.size(s)).alias("series_lengths"), "sample.used_missing_mask").write.json(f"{out}/audit")
    manifest = {"files": kept, "rows_seen": seen.get["n"], "rows_filtered_contamination": seen.get["n"] - done.count(), "rows_written": good.count(), "reasons": {str(r.reason): r["rows"] for r in convert.conversion_report(done).collect()}}
    manifest["values"] = [r.asDict() for r in convert.value_histogram(done).limit(1000).collect()]
    if preview:
        manifest["preview"] = [r.asDict() for r in views.preview(good.orderBy(*place).select("sample.input", "sample.timeseries", "sample.output"), preview).collect()]
    write_manifest(spark, f"{out}/manifest.json", manifest)
    return manifest


def prepare(spark: SparkSession, sources: list[readers.Source], out: str, limit: int = 0) -> None:
    """Validates registered sources, labels by rules, and writes labels, quarantine, clusters and the review queue. An audit
    must tell of each line that isn't blank, and of no other. limit: the first so many valid rows of all sources."""
    good, bad = [], []
    for k, s in enumerate(sources):
        valid, wrong = readers.validated(spark, s.path)
        if s.audit:
            audit = readers.read_jsonl(spark, s.audit)
            task = F.col("task").cast("string") if "task" in audit.columns else F.lit(None).cast("string")
            audit = audit.select(F.col("sample_index").cast("long").alias("source_index"), task.alias("task"))
            lines = valid.select("source_index").union(wrong.select("source_index"))
            valid = valid.join(merge.zipped(lines, audit, ["source_index"], f"audit of {s.name}"), "source_index")
        else:
            valid = valid.withColumn("task", F.lit(None).cast("string"))
        tags = {"source": F.lit(s.name), "split": F.lit(s.split), "source_order": F.lit(k)}
        good.append(valid.withColumns(tags))
        bad.append(wrong.withColumn("source", F.lit(s.name)))
    rows, wrong = good[0], bad[0]
    for g, b in zip(good[1:], bad[1:], strict=True):
        rows, wrong = rows.unionByName(g), wrong.unionByName(b)
    if limit:
        rows = rows.orderBy("source_order", "source_index").limit(limit)
    cluster.provisional(rows).write.parquet(f"{out}/provisional")
    labelled = spark.read.parquet(f"{out}/provisional")
    wrong.write.json(f"{out}/invalid")
    cluster.clusters(labelled, F.col("source_order")).write.parquet(f"{out}/clusters")
    cluster.review_queue(spark.read.parquet(f"{out}/clusters")).write.json(f"{out}/review")
    counters = [r.asDict() for r in cluster.rule_counters(labelled).orderBy("kind", "value").collect()]
    counters += [{"kind": "invalid", "value": r.source, "rows": r["count"]} for r in spark.read.json(f"{out}/invalid").groupBy("source").count().orderBy("source").collect()] if not wrong.isEmpty() else []
    write_manifest(spark, f"{out}/manifest.json", {"counters": counters})


def review_sheet(queue: DataFrame, path: str) -> None:
    """The queue as CSV with blank columns for a reviewer."""
    p = F.col("provisional")
    blank = {c: F.lit("") for c in ("human_primary_label", "human_secondary_labels", "human_taxonomy_fit", "human_rationale", "reviewer")}
    queue.select("cluster_id", "source", "member_count", "template", F.substring("input", 1, 12000).alias("input"), F.substring("output", 1, 3000).alias("output"), p["primary_label"].alias("rule_primary"), F.concat_ws(",", p["secondary_labels"]).alias("rule_secondary"), p["taxonomy_fit"].alias("rule_fit"), p["confidence"].alias("rule_confidence"), F.concat_ws("; ", p["evidence"]).alias("rule_evidence")).withColumns(blank).write.csv(path, header=True, quoteAll=True)


def materialize_buckets(rows: DataFrame, out: str, most: int = 0, scope: tuple[str, ...] = (), seed: int = selection.SEED, samples: DataFrame | None = None) -> DataFrame:
    """Writes eligible rows by label; a cap holds for the sources in scope (all, if none). Returns the cap's report.

    rows: final labels with source, source_index, split, cluster_id, sample_id. samples: the sources' valid rows (source,
    source_index and what is to be written); they must be the labels' rows, one for one.
    """
    if samples is not None:
        rows = merge.zipped(rows, samples, ["source", "source_index"], "final labels and sources")
    own = rows.filter(selection.eligible(F.col("final"), F.col("split")))
    inside = F.col("source").isin(*scope) if scope else F.lit(True)
    candidates = own.filter(inside)
    chosen = selection.only(candidates, selection.capped(candidates.select("cluster_id", "sample_id"), ["cluster_id"], "sample_id", most, seed), ["sample_id"])
    selection.write_buckets(chosen.unionByName(own.filter(~inside)), F.col("final.primary_label"), out, ["source", "source_index"])
    return selection.cap_report(candidates, ["cluster_id"], most)


def resolve_votes(labelled: DataFrame, sheet: DataFrame, authoritative: DataFrame, votes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Final labels, and the clusters left for people."""
    out = resolve.resolve(labelled, resolve.human_labels(sheet), authoritative, resolve.tally(votes))
    return out, out.filter("final.status = 'human_review'").select("cluster_id").distinct()


def resolve_files(labelled: DataFrame, human: DataFrame, authoritative: DataFrame, votes: DataFrame, queue: DataFrame, out: str) -> dict:
    """Writes final labels and the rows of the review queue that are left for people; returns counts and the queue's coverage.

    human: labels as ``resolve.human_labels`` or ``human_records`` gives them; votes as ``resolve.read_votes`` does.
    """
    spark = labelled.sparkSession
    final = resolve.resolve(labelled, human, authoritative, resolve.tally(votes))
    final.write.mode("errorifexists").parquet(f"{out}/final")
    final = spark.read.parquet(f"{out}/final")
    open_ = final.filter("final.status = 'human_review'").select("cluster_id").distinct()
    selection.only(queue, open_, ["cluster_id"]).write.json(f"{out}/human_review")
    pairs = F.explode(F.array(F.col("final.status"), F.coalesce("final.primary_label", F.lit("NONE"))))
    counts = {r.v: r["count"] for r in final.select(pairs.alias("v")).groupBy("v").count().orderBy("v").collect()}
    told = {"counts": counts, "unresolved_clusters": open_.count(), "coverage": resolve.coverage(queue, votes).first().asDict()}
    write_manifest(spark, f"{out}/manifest.json", told)
    return told


def distribution_report(rows: DataFrame, group: dict[str, str], labels: list[str], out: str, splits: tuple[str, ...] = ()) -> dict:
    """The label distribution of accepted rows by dataset group, and the statuses of all rows: Markdown, CSV and JSON.

    rows: source, split and final. group: prefixes of sources and their groups' names; splits: those that count (all, if none).
    """
    spark = rows.sparkSession
    own = rows.filter(F.col("split").isin(*splits)) if splits else rows
    by = reports.dataset_group(F.col("source"), group)
    table = reports.distribution(own, by, F.col("final.primary_label"), F.col("final.status") == "accepted", labels)
    states = reports.status_table(own, by, F.col("final.status"))
    table.coalesce(1).write.csv(f"{out}/distribution", header=True)  # a row a group and label
    sources = own.select(by.alias("dataset_group"), "source").distinct().orderBy("dataset_group", "source").collect()  # a row a source
    told = {"sources": {}, "distribution": [r.asDict() for r in table.orderBy("dataset_group", "label").collect()], "statuses": [r.asDict() for r in states.orderBy("dataset_group", "status").collect()]}
    for r in sources:
        told["sources"].setdefault(r.dataset_group, []).append(r.source)
    files.write_text(spark, f"{out}/distribution.json", json.dumps(told, ensure_ascii=False, indent=2, sort_keys=True))
    files.write_text(spark, f"{out}/distribution.md", [reports.markdown(table.orderBy("dataset_group", "label"), "Labels"), "\n", reports.markdown(states.orderBy("dataset_group", "status"), "Statuses")])
    return told


def merged_report(rows: DataFrame, quality: DataFrame, out: str, abilities: list[str]) -> None:
    """The cube of ability, quality and difficulty with coverage by source, as CSV; rows outside the levels count only in totals."""
    merge.with_quality(rows, quality, ["source", "line_number"]).select("source", "ability_bucket", "quality", "difficulty", "join_method").write.parquet(f"{out}/joined")
    both = rows.sparkSession.read.parquet(f"{out}/joined")
    cells = reports.cube(both, ["ability_bucket", "quality", "difficulty"])
    domains = {"ability_bucket": [*abilities, merge.UNMAPPED], "quality": list(resolve.QUALITY), "difficulty": list(resolve.DIFFICULTY)}
    reports.zero_filled(cells, domains, "ability_bucket").coalesce(1).write.csv(f"{out}/ability_quality_difficulty", header=True)
    reports.coverage(both, "source", F.col("quality"), F.nullif("ability_bucket", F.lit(merge.UNMAPPED)), F.col("join_method")).coalesce(1).write.csv(f"{out}/coverage_by_source", header=True)
    reports.ability_summary(cells, "ability_bucket", F.col("quality").isin("good", "excellent"), F.col("difficulty").isin("hard", "very_hard")).coalesce(1).write.csv(f"{out}/ability_summary", header=True)


def up_to_date(spark: SparkSession, manifest: str, inputs: list[str]) -> bool:
    """Whether a manifest names the inputs' present signatures and its outputs are there."""
    try:
        found = json.loads(files.read_text(spark, manifest)) if files.exists(spark, manifest) else {}
    except ValueError:
        return False
    now = [files.signature(spark, p) if files.exists(spark, p) else None for p in inputs]
    return found.get("signatures") == now and all(files.exists(spark, p) for p in found.get("outputs", []))


def write_manifest(spark: SparkSession, path: str, content: dict) -> None:
    """Written aside and renamed, on the store of the path."""
    files.write_text(spark, path, json.dumps(content | {"written_at": int(time.time())}, ensure_ascii=False, indent=2, sort_keys=True, default=str))


def versioned(spark: SparkSession, root: str, inputs: list[str], make: Callable[[], DataFrame], wait: float = 3600.0) -> DataFrame:
    """A table derived from files, made anew only if their signatures changed.

    make() gives the DataFrame; it is written as the next version under root, and the manifest, which names the current
    version, is replaced when that is done: a reader sees either version, whole. The version before it stays readable,
    earlier ones go. One builder at a time is at work: others wait for it so long at most, and then take what it has made; a
    builder that died holds them up for no longer than that, and its number isn't taken again.
    """
    place, begun = f"{root}/manifest.json", time.time()
    while not up_to_date(spark, place, inputs):
        lease = commits.Lease(spark, f"{root}.lease", wait)
        if not lease.take():
            if time.time() - begun > wait:
                raise Conflict(f"{root} is being built")
            time.sleep(0.2)
            continue
        try:
            if up_to_date(spark, place, inputs):
                break  # made while this one asked
            have = [int(n.removeprefix("v")) for n in files.listed(spark, root) if n.startswith("v")]
            now = max(have, default=0) + 1
            own, seen = f"{root}/v{now}", [files.signature(spark, p) for p in inputs]  # as they are before they are read
            make().write.parquet(own)
            write_manifest(spark, place, {"signatures": seen, "outputs": [own]})
            for old in have:
                if old < now - 1:
                    files.delete(spark, f"{root}/v{old}")
        finally:
            lease.release()
        break
    return spark.read.parquet(json.loads(files.read_text(spark, place))["outputs"][0])
