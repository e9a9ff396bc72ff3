"""Merging ability and quality labels into samples: per source, over all sources, and the reports of the whole.

Every step is a join over all rows of a source; conditions that must hold (counts, hashes, conflicts) fail the job where
they don't.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules, text
from ..operators import merge, reports, resolve
from ..operators.review import Conflict
from ..sources import commits, files
from ..sources.readers import strict_json
from ..sources.sinks import failing

# The fields of a quality label, and the parts of a merged dataset.
QUALITY_LABEL = "struct<record_id:string,line_number:long,input_hash:string,template_id:string,quality:string,difficulty:string,reason:string,model:string,prompt_version:string>"
DECISION = "struct<primary_label:string,secondary_labels:array<string>,taxonomy_fit:string,confidence:double,status:string,proposed_primary_label:string,proposed_taxonomy_fit:string,proposed_confidence:double>"
AUDIT = "struct<primary_label:string,secondary_labels:array<string>,taxonomy_fit:string,confidence:double,status:string,reasoning_subtype:string,training_role:string,taxonomy_verifier_status:string>"


def quality_labels(raw: DataFrame, model: str, prompt_version: str) -> tuple[DataFrame, DataFrame]:
    """Labels (one a line_number) of one model and prompt from raw lines (column ``raw``), and one row of counts.

    Lines of another model or prompt are counted and left out. A line that is no JSON, lacks its line number or reason, or
    holds another level fails, as do different labels of one line; equal ones count as duplicates.
    """
    own = failing(raw, strict_json(F.col("raw")).isNotNull(), "a quality label is no JSON object").withColumn("l", F.from_json("raw", QUALITY_LABEL))
    same = F.coalesce((F.col("l.model") == model) & (F.col("l.prompt_version") == prompt_version), F.lit(False))
    used = own.filter(same).select("l.*")
    used = failing(used, F.col("line_number").isNull(), "a quality label has no line number")
    used = failing(used, ~F.coalesce(F.col("quality").isin(*resolve.QUALITY) & F.col("difficulty").isin(*resolve.DIFFICULTY), F.lit(False)), "a quality label has an unknown level")
    used = failing(used, text.strip(F.coalesce("reason", F.lit(""))) == "", "a quality label has no reason")
    names = [c for c in used.columns if c != "line_number"]
    told = F.struct(*names)
    once = used.groupBy("line_number").agg(F.count("*").alias("_n"), F.count_distinct(F.to_json(told)).alias("_k"), F.any_value(told).alias("_l"))
    once = failing(once, F.col("_k") > 1, "conflicting quality labels of one line")
    stats = own.agg(F.count("*").alias("file_rows"), F.count_if(~same).alias("ignored_other_model_or_prompt"))
    kept = once.agg(F.count("*").alias("usable_rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_identical"))
    return once.select("line_number", "_l.*"), stats.crossJoin(kept)  # one row each


def taxonomy_rows(provisional: DataFrame, final: DataFrame) -> DataFrame:
    """provisional with the final decision of the same sample_id; a row that stands alone, or twice, fails."""
    lone = lambda df, what: failing(df.groupBy("sample_id").agg(F.count("*").alias("_n"), F.any_value(F.struct(*(c for c in df.columns if c != "sample_id"))).alias("_r")), F.col("_n") > 1, f"{what} labels have a sample twice").select("sample_id", "_r.*")
    return merge.zipped(lone(provisional, "provisional"), lone(final.select("sample_id", "final"), "final"), ["sample_id"], "final labels")


def consistent(manifests: Iterable[dict]) -> tuple[dict, dict[str, str]]:
    """The one taxonomy that all manifests agree on, and each source's path; disagreement is an error."""
    taxonomy, paths = None, {}
    for m in manifests:
        now = m.get("taxonomy")
        if not isinstance(now, dict) or len(now) != len(rules.LABELS):
            raise ValueError("a manifest has no full taxonomy")
        if taxonomy is not None and now != taxonomy:
            raise ValueError("taxonomy definitions disagree")
        taxonomy = now
        for s in m.get("sources", []):
            if paths.setdefault(s["name"], s["path"]) != s["path"]:
                raise ValueError(f"the path of {s['name']} disagrees")
    if taxonomy is None:
        raise ValueError("no manifest")
    return taxonomy, paths


def with_audit(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """rows (source, source_index) with ``audit`` of the same place; either side without the other fails."""
    return merge.zipped(rows, audit.select("source", "source_index", F.col("audit")), ["source", "source_index"], "audit")


@dataclass(frozen=True)
class Strict:
    """What must be there: a quality label for each row and a row for each label; an ability label for each row."""

    quality: bool = True
    ability: bool = True


def annotated(samples: DataFrame, taxonomy: DataFrame, quality: DataFrame, strict: Strict = Strict(), raw: DataFrame | None = None) -> DataFrame:  # noqa: B008
    """samples with ``annotation``, a struct of ability and quality fields.

    samples: source, source_index, digest, input, output and, optionally, audit (AUDIT). taxonomy: source, source_index,
    digest, sample_id, cluster_id, provisional and final (DECISION). quality: source and the fields of a quality label.
    Labels join by place and digest, then by digest alone. With raw (source, source_index, valid, canonical; then samples
    have canonical too) the samples are a cleaned copy of the labelled source and the k-th valid row's label is the
    k-th sample's. Without a label the audit's is the fallback.
    """
    keys = ["source", "source_index"]
    place = samples.select(*keys, "digest", *(["canonical"] if raw is not None else []))
    found = merge.aligned(place, raw) if raw is not None else merge.matched(place, taxonomy.select(*keys, "digest"))
    found = found.select(*keys, "label_index", "join_method")
    own = taxonomy.select("source", F.col("source_index").alias("label_index"), "sample_id", "cluster_id", *(_shaped(taxonomy, c, DECISION) for c in ("provisional", "final")), F.lit(True).alias("_labelled"))
    # Labels meet places first, and all three meet by line: so texts are dealt once.
    line = (F.col("source_index") + 1).alias("line_number")
    labelled = own.join(found, ["source", "label_index"], "right").withColumn("line_number", line).drop("source_index")
    rows = samples.withColumn("audit", _shaped(samples, "audit", AUDIT)).withColumn("line_number", line).join(labelled, ["source", "line_number"])
    if raw is not None:
        rows = failing(rows, F.col("_labelled").isNull(), "a row of the labelled source has no label")
    blank = F.coalesce(F.col("audit.primary_label"), F.lit("")) == ""
    method = F.when(F.col("_labelled").isNotNull(), F.col("join_method")).when(~blank, "audit_fallback").otherwise("missing")
    rows = rows.withColumn("_method", method)
    if strict.ability:
        rows = failing(rows, F.col("_method") == "missing", "a row has no ability label")
    told = rows.withColumn("_a", merge.ability(F.col("final"), F.col("provisional"), F.when(F.col("_labelled").isNull(), F.col("audit"))))
    told = failing(told, F.col("_a.ability_label").isNotNull() & ~F.col("_a.ability_label").isin(*rules.LABELS), "unknown ability label")
    # The quality label of the same line must be of the same template and text.
    q = quality.select("source", "line_number", F.struct(*(c for c in quality.columns if c not in ("source", "line_number"))).alias("_q"))
    if strict.quality:
        told = merge.zipped(told, q, ["source", "line_number"], "quality labels")
    else:
        told = told.join(q, ["source", "line_number"], "left")
    other = text.bind(text.template(F.col("input"), F.col("output")), lambda t: (F.col("_q.template_id") != t["template_id"]) | (F.col("_q.input_hash") != t["input_hash"]))
    told = failing(told, F.when(F.col("_q").isNotNull(), other), "a quality label is of another template or text")
    return told.withColumn("annotation", _annotation()).select(*samples.columns, "annotation")


def _shaped(df: DataFrame, name: str, shape: str) -> Column:
    """A struct column in a given shape, fields that it lacks null."""
    if name not in df.columns:
        return F.lit(None).cast(shape).alias(name)
    have = {f.name for f in df.schema[name].dataType.fields}
    wanted = [x.split(":", 1) for x in shape.removeprefix("struct<").removesuffix(">").split(",")]
    fields = [(F.col(name)[n] if n in have else F.lit(None)).cast(kind).alias(n) for n, kind in wanted]
    return F.when(F.col(name).isNotNull(), F.struct(*fields)).alias(name)


def _annotation() -> Column:
    a, q = F.col("_a"), F.col("_q")
    major = F.create_map(*(F.lit(x) for row in rules.TAXONOMY for x in (row[0], row[1])))
    name = F.create_map(*(F.lit(x) for row in rules.TAXONOMY for x in (row[0], row[2])))
    label, source = a["ability_label"], a["ability_label_source"]
    decision = F.when(source.isin("final", "final_proposed"), F.col("final.secondary_labels")).when(source == "audit_fallback", F.col("audit.secondary_labels")).otherwise(F.coalesce("provisional.secondary_labels", "final.secondary_labels"))
    told = [
        F.concat_ws(":", "source", "line_number").alias("annotation_id"), F.col("source").alias("annotation_source"), "source_index", "line_number",
        F.col("sample_id").alias("taxonomy_sample_id"), F.col("cluster_id").alias("taxonomy_cluster_id"),
        *(a[c].alias(c) for c in ("ability_label", "ability_bucket")), F.when(label.isNotNull(), name[label]).alias("ability_name"), F.when(label.isNotNull(), major[label]).alias("ability_major"),
        F.coalesce(decision, F.array().cast("array<string>")).alias("ability_secondary_labels"),
        *(a[c].alias(c) for c in ("ability_label_source", "ability_status", "ability_confidence", "taxonomy_fit")),
        *(F.when(F.col("_labelled").isNull(), F.col(f"audit.{c}")).alias(c) for c in ("reasoning_subtype", "training_role", "taxonomy_verifier_status")),
        F.col("_method").alias("ability_join_method"), q["quality"].alias("quality"), q["difficulty"].alias("difficulty"), q["reason"].alias("quality_reason"),
        q["template_id"].alias("quality_template_id"), q["model"].alias("quality_model"), q["prompt_version"].alias("quality_prompt_version"),
    ]
    return F.struct(*told)


def cube(annotated_: DataFrame) -> DataFrame:
    """source, ability_bucket, quality, difficulty, count."""
    a = F.col("annotation")
    cells = annotated_.select("source", a["ability_bucket"].alias("ability_bucket"), a["quality"].alias("quality"), a["difficulty"].alias("difficulty"))
    return reports.cube(cells, ["source", "ability_bucket", "quality", "difficulty"])


def write_annotated(annotated_: DataFrame, sample: list[str], out: str, with_samples: bool = True, sidecar: bool = True) -> DataFrame:
    """Writes annotated samples and annotations alone, both from one written table, which it returns."""
    if not with_samples and not sidecar:
        raise ValueError("at least one output must be written")
    fields = annotated_.schema["annotation"].dataType.names
    if clash := set(fields) & set(sample):
        raise ValueError(f"annotation field collision: {sorted(clash)}")
    annotated_.write.mode("errorifexists").parquet(f"{out}/rows")
    rows = annotated_.sparkSession.read.parquet(f"{out}/rows")
    if sidecar:
        rows.select("annotation.*").write.json(f"{out}/annotations")
    if with_samples:
        rows.select(*sample, "annotation.*").write.json(f"{out}/annotated")
    return rows


def report_parts(rows: DataFrame) -> dict[str, DataFrame]:
    """What reports are made of: the cells of the cube, coverage and counts, each by source, so that the parts of different
    sources are one another's complement."""
    a = F.col("annotation")
    return {
        "cells": cube(rows),
        "coverage": reports.coverage(rows.select("source", "annotation"), "source", a["quality"], a["ability_label"], a["ability_join_method"]),
        "counts": rows.groupBy("source").agg(F.count("*").alias("total_rows"), F.count(a["quality"]).alias("quality_labeled_rows"), F.count(a["ability_label"]).alias("ability_15d_rows"), F.count_if(a["ability_label"].isNull()).alias("ability_unmapped_rows")),
    }


def write_reports(rows: DataFrame, out: str) -> dict:
    """The cubes of all sources and of each, their summaries, coverage, a summary as JSON and a report as Markdown."""
    parts = report_parts(rows)
    parts["cells"].write.mode("errorifexists").parquet(f"{out}/cells")
    return write_parts(parts | {"cells": rows.sparkSession.read.parquet(f"{out}/cells")}, out)


def write_parts(parts: dict[str, DataFrame], out: str) -> dict:
    """The reports of such parts, of however many sources."""
    cells, coverage, counts = (parts[k] for k in ("cells", "coverage", "counts"))
    spark = cells.sparkSession
    whole = cells.groupBy("ability_bucket", "quality", "difficulty").agg(F.sum("count").alias("count"))
    domains = {"ability_bucket": [*rules.LABELS, merge.UNMAPPED], "quality": list(resolve.QUALITY), "difficulty": list(resolve.DIFFICULTY)}
    abilities = reports.ability_summary(whole, "ability_bucket", F.col("quality").isin(*resolve.QUALITY[3:]), F.col("difficulty").isin(*resolve.DIFFICULTY[3:]))
    tables = {
        "ability_quality_difficulty": reports.zero_filled(whole, domains, "ability_bucket"),
        "source_ability_quality_difficulty": cells,
        "coverage_by_source": coverage,
        "ability_summary": abilities,
    }
    for name, table in tables.items():
        table.coalesce(1).write.csv(f"{out}/{name}", header=True)  # at most a row a source and cell
    marginals = {d: {r[d]: r["n"] for r in whole.groupBy(d).agg(F.sum("count").alias("n")).orderBy(d).collect()} for d in domains}
    summary = {"sources": [r.asDict() for r in counts.orderBy("source").collect()], "marginals": marginals, "tables": sorted(tables)}
    files.write_text(spark, f"{out}/summary.json", json.dumps(summary, ensure_ascii=False, indent=2, sort_keys=True))
    files.write_text(spark, f"{out}/report.md", [reports.markdown(abilities.orderBy("ability_bucket"), "Abilities"), "\n", reports.markdown(coverage.orderBy("source"), "Coverage")])
    return summary


def merge_all(samples: DataFrame, taxonomy: DataFrame, quality: DataFrame, out: str, sample: list[str], inputs: Iterable[str] = (), strict: Strict = Strict(), raw: DataFrame | None = None, with_samples: bool = True) -> dict:  # noqa: B008
    """Annotates the samples of all sources in one job, writes them and the reports, and returns the summary.

    inputs: the files that this is made from. If their signatures are those of the last merge into this folder, it isn't
    made again. Each merge is a folder of its own; the manifest, replaced at the end, names the current one.
    """
    spark = samples.sparkSession
    place, inputs = f"{out}/manifest.json", list(inputs)
    now = [files.signature(spark, p) for p in inputs]
    have = json.loads(files.read_text(spark, place)) if files.exists(spark, place) else {}
    if inputs and have.get("signatures") == now and files.exists(spark, have.get("folder", out)):
        return have["summary"]
    folder = f"{out}/merge-{1 + max((int(n.split('-')[1]) for n in files.listed(spark, out) if n.startswith('merge-')), default=0)}"
    rows = write_annotated(annotated(samples, taxonomy, quality, strict, raw), sample, folder, with_samples)
    summary = write_reports(rows, f"{folder}/reports")
    files.write_text(spark, place, json.dumps({"signatures": now, "folder": folder, "summary": summary}, ensure_ascii=False, indent=2, sort_keys=True))
    return summary


#: Part of every source's signature: what a merge writes has changed with it.
VERSION = "1"


def source_signature(spark: SparkSession, paths: Iterable[str], *settings: object) -> str:
    """What a source's part of a merge is made from: its files, the settings, the version of the merge."""
    told = [VERSION, *(files.signature(spark, p) for p in paths), *map(repr, settings)]
    return hashlib.sha256("\n".join(told).encode()).hexdigest()[:24]


def merge_changed(samples: DataFrame, taxonomy: DataFrame, quality: DataFrame, signatures: Mapping[str, str], out: str, sample: list[str], strict: Strict = Strict(), raw: DataFrame | None = None, with_samples: bool = True) -> dict:  # noqa: B008
    """Merges the sources whose signature isn't that of their last merge into this folder, and reports on all.

    signatures: {source: signature} of all sources there are; rows of others in the frames take no part. All changed
    sources are one job, written by source. What is live is a log of commits: one commit takes the changed sources' parts in
    place of their old ones, and those of sources that are gone away, so a reader sees either merge whole; of two mergers of
    one source the later one is refused. Annotations and annotated samples (JSON) are overwritten source by source. The
    reports are made of the parts of all sources: those that didn't change aren't read again.
    """
    spark, log = samples.sparkSession, commits.Log(samples.sparkSession, f"{out}/log")
    tags = {s: f"{sig} {s}" for s, sig in signatures.items()}
    state = log.state()
    have = {tag.split(" ", 1)[1] for tag in state.live.values()}  # "<kind> <signature> <source>"
    changed = sorted(s for s, tag in tags.items() if tag not in have)
    gone = sorted({tag.split(" ", 1)[1] for tag in have} - set(signatures))
    adds: dict[str, str] = {}
    if changed:
        only = lambda df: df.filter(F.col("source").isin(changed))
        rows = annotated(only(samples), only(taxonomy), only(quality), strict, None if raw is None else only(raw))
        if clash := set(rows.schema["annotation"].dataType.names) & set(sample):
            raise ValueError(f"annotation field collision: {sorted(clash)}")
        number = F.create_map(*(x for i, s in enumerate(changed) for x in (F.lit(s), F.lit(i))))
        by_source = lambda df: df.withColumn("_part", number[F.col("source")])

        def put(df: DataFrame, kind: str) -> DataFrame:
            name = f"data/{uuid.uuid4().hex}"
            by_source(df).write.partitionBy("_part").parquet(f"{log.folder}/{name}")
            made = set(files.listed(spark, f"{log.folder}/{name}"))
            adds.update({f"{name}/_part={i}": f"{kind} {tags[s]}" for i, s in enumerate(changed) if f"_part={i}" in made})
            return spark.read.schema(df.schema).parquet(f"{log.folder}/{name}").select(*df.columns)

        rows = put(rows, "rows")
        for kind, part in report_parts(rows).items():
            put(part, kind)
        if lost := [s for s in changed if f"rows {tags[s]}" not in adds.values()]:
            raise ValueError(f"no rows of {lost}")
        told = {"annotations": rows.select("source", "annotation.*")} | ({"annotated": rows.select("source", *(c for c in sample if c != "source"), "annotation.*")} if with_samples else {})
        for name, df in told.items():
            df = df.withColumn("dataset", text.slug(F.col("source"))).drop(*({"source"} - set(sample)))
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset").json(f"{out}/{name}")

    def make(now: commits.State) -> dict | None:
        of = lambda tag: tag.split(" ", 2)[2]
        theirs = {of(t) for f, t in now.live.items() if f not in state.live}
        if theirs & {*changed, *gone}:
            raise Conflict(f"another merge has changed {sorted(theirs & {*changed, *gone})}")
        removes = [f for f, t in now.live.items() if of(t) in {*changed, *gone}]
        return {"adds": adds, "removes": removes} if adds or removes else None

    now = log.commit(make, "merge")
    place = f"{out}/reports/{now.number:06d}"
    if not files.exists(spark, f"{place}/summary.json"):
        files.delete(spark, place)
        parts = {}
        for kind in ("cells", "coverage", "counts"):
            folders = [f"{log.folder}/{f}" for f, t in now.live.items() if t.startswith(kind + " ")]
            parts[kind] = spark.read.parquet(*folders)
        write_parts(parts, place)
    summary = json.loads(files.read_text(spark, f"{place}/summary.json"))
    return {"rewritten": changed, "removed": gone, "kept": sorted(set(signatures) - set(changed)), "commit": now.number, "reports": place, "summary": summary}


def merged_rows(spark: SparkSession, out: str, source: str | None = None, at: int | None = None) -> DataFrame:
    """The rows of the last merge (or of an earlier commit), of all sources or one: other sources' files aren't opened."""
    log = commits.Log(spark, f"{out}/log")
    live = [f for f, t in log.state(at).live.items() if t.startswith("rows ") and source in (None, t.split(" ", 2)[2])]
    if not live:
        raise KeyError(source or "no merge")
    return spark.read.parquet(*(f"{log.folder}/{f}" for f in live))


def store_labels(taxonomy: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Writes labels as a table dealt into buckets by (source, source_index) and sorted by them, and returns it. What joins it
    by place needs no exchange and no sort of the labels; ``annotated`` deals its samples to the buckets. Labels are one a place."""
    spark = taxonomy.sparkSession
    keys = ["source", "source_index"]
    once = taxonomy.groupBy(*keys).agg(F.count("*").alias("_n"), F.any_value(F.struct(*(c for c in taxonomy.columns if c not in keys))).alias("_l"))
    once = failing(once, F.col("_n") > 1, "labels have a place twice").select(*keys, "_l.*")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    once.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    told = {"buckets": buckets, "schema": once.schema.jsonValue()}
    files.write_text(spark, f"{path}.json", json.dumps(told))
    return spark.table(name)


def stored_labels(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Labels that another session has stored, under a name of this one."""
    told = json.loads(files.read_text(spark, f"{path}.json"))
    columns = T.StructType.fromJson(told["schema"])
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({shape}) USING parquet CLUSTERED BY (source, source_index) SORTED BY (source, source_index) INTO {told['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def labels_of(labels: DataFrame, source: str) -> DataFrame:
    """One source's labels in order of their places."""
    return labels.filter(F.col("source") == source).orderBy("source_index")


def missing_inputs(spark: SparkSession, paths: dict[str, dict[str, str | None]]) -> list[dict]:
    """A dry run: for each source, which of its named paths exist (a path that isn't given is no lack)."""
    return [{"dataset": name, "paths": own, "exists": {k: v is None or files.exists(spark, v) for k, v in own.items()}} for name, own in paths.items()]


def chosen_sources(names: Iterable[str], wanted: Iterable[str] | None) -> list[str]:
    """The sources to work on, in their order; an unknown name is an error, and so are two names with one folder name."""
    names = list(names)
    if unknown := set(wanted or ()) - set(names):
        raise ValueError(f"unknown dataset(s): {', '.join(sorted(unknown))}")
    return [n for n in names if wanted is None or n in set(wanted)]


def write_summaries(cells: DataFrame, out: str, datasets: Iterable[str] | None = None) -> dict:
    """Long and wide summaries of quality and difficulty by dataset, and a manifest. cells: source, quality, difficulty, count."""
    spark = cells.sparkSession
    names = chosen_sources([r.source for r in cells.select("source").distinct().orderBy("source").collect()], datasets)  # one row a source
    folders = {r.source: r.s for r in spark.createDataFrame([(n,) for n in names], "source string").select("source", text.slug(F.col("source")).alias("s")).collect()}
    if len(set(folders.values())) < len(folders):
        raise ValueError("two datasets have the same folder name")
    own = cells.filter(F.col("source").isin(names))
    dims = {"quality": list(resolve.QUALITY), "difficulty": list(resolve.DIFFICULTY)}
    reports.long_summary(own, "source", dims).coalesce(1).write.csv(f"{out}/dataset_distribution_summary", header=True)
    wide = reports.wide_summary(own, "source", "quality", dims["quality"]).join(reports.wide_summary(own, "source", "difficulty", dims["difficulty"]), "source")
    wide.coalesce(1).write.csv(f"{out}/dataset_distribution_wide", header=True)
    manifest = {"dataset_count": len(names), "datasets": names, "folders": folders}
    files.write_text(spark, f"{out}/manifest.json", json.dumps(manifest, ensure_ascii=False, indent=2, sort_keys=True))
    return manifest
