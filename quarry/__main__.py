"""``python -m quarry <command>``: the composites as jobs, for spark-submit or a local session.

    convert INPUT... --adapter primary|embedded --out DIR     raw files to samples, audit and manifest
    prepare REGISTRY --out DIR                                rule labels, clusters and the review queue
    sheet QUEUE --out DIR                                     the queue as CSV for reviewers
    resolve PREPARED --out DIR [--human CSV] [--votes JSONL] [--authoritative JSONL]
    buckets FINAL --out DIR [--cap K] [--seed N] [--scope SOURCE]...
    labels CONFIG                                             what a labelling configuration says, as JSON
    check CONFIG                                              which inputs of a merge don't exist; exit 1 if any
    lines PATH --out DIR [--layout lines|array]               byte places of records as an index for lookups
    record INDEX FILE NUMBER                                  one record of an index
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import cluster, resolve
from .plans import pipelines
from .sources import config, places, readers, records


def _votes(spark: SparkSession, path: str | None):
    """Vote files are JSON lines of cluster_id and vote, in their order."""
    if path is None:
        return spark.createDataFrame([], f"cluster_id string, seen long, {resolve.VOTE.removeprefix('struct<').removesuffix('>').replace(':', ' ').replace('confidence string', 'confidence double')}")
    raw = readers.lines(spark, path).filter(F.trim("raw") != "")
    rows = raw.select(F.get_json_object("raw", "$.cluster_id").alias("cluster_id"), F.get_json_object("raw", "$.vote").alias("vote"), F.col("source_index").alias("seen"))
    return resolve.read_votes(rows)


def run(spark: SparkSession, argv: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="quarry", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    add = lambda name, *places_: [c := commands.add_parser(name), *(c.add_argument(p, **k) for p, k in places_)][0]
    out = ("--out", {"required": True})
    add("convert", ("inputs", {"nargs": "+"}), ("--adapter", {"choices": ("primary", "embedded"), "required": True}), out, ("--limit", {"type": int, "default": 0}), ("--keep-copies", {"action": "store_true"}))
    add("prepare", ("registry", {}), out, ("--limit", {"type": int, "default": 0}))
    add("sheet", ("queue", {}), out, ("--limit", {"type": int, "default": 0}))
    add("resolve", ("prepared", {}), out, ("--human", {}), ("--votes", {}), ("--authoritative", {}))
    add("buckets", ("final", {}), out, ("--cap", {"type": int, "default": 0}), ("--seed", {"type": int, "default": 42}), ("--scope", {"action": "append", "default": []}))
    add("labels", ("config", {}))
    add("check", ("config", {}))
    add("lines", ("path", {}), out, ("--layout", {"choices": ("lines", "array"), "default": "lines"}))
    add("record", ("index", {}), ("file", {}), ("number", {"type": int}))
    a = parser.parse_args(argv)
    told: object = None
    if a.command == "convert":
        told = pipelines.convert_files(spark, a.inputs, a.adapter, a.out, dedup=not a.keep_copies, limit=a.limit)
    elif a.command == "prepare":
        pipelines.prepare(spark, readers.registry(a.registry, spark), a.out, a.limit)
    elif a.command == "sheet":
        queue = spark.read.parquet(a.queue)
        pipelines.review_sheet(cluster.review_queue(queue, a.limit), a.out)
    elif a.command == "resolve":
        labelled = spark.read.parquet(f"{a.prepared}/provisional")
        none = spark.createDataFrame([], "cluster_id string, human_primary_label string, human_secondary_labels string, human_taxonomy_fit string")
        human = resolve.human_labels(readers.read_csv(spark, a.human) if a.human else none)
        queue = cluster.review_queue(spark.read.parquet(f"{a.prepared}/clusters"))
        told = pipelines.resolve_files(labelled, human, _votes(spark, a.authoritative).drop("seen"), _votes(spark, a.votes), queue, a.out)
    elif a.command == "buckets":
        told = [r.asDict() for r in pipelines.materialize_buckets(spark.read.parquet(a.final), a.out, a.cap, tuple(a.scope), a.seed).collect()]
    elif a.command == "labels":
        found = config.labelling(spark, a.config)
        told = {"settings": found.settings, "datasets": {k: [d.input, d.output] for k, d in found.datasets.items()}}
    elif a.command == "check":
        told = config.merge(spark, a.config).missing(spark)
    elif a.command == "lines":
        places.write(records.records(spark, a.path, a.layout), a.out)
    else:
        told = places.record_at(spark, a.index, a.file, a.number)
    if told is not None:
        print(json.dumps(told, ensure_ascii=False, indent=2, sort_keys=True, default=str))
    return int(a.command == "check" and bool(told))


if __name__ == "__main__":
    sys.exit(run(SparkSession.builder.appName("quarry").getOrCreate(), sys.argv[1:]))
