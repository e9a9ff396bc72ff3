"""Queries that run the drivers (merge, import of results, indexes, catalogue) over the driver's tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import series, text
from ..operators import merge, reports, resolve
from ..sources import offsets, results
from . import inspect, merging
from .queries import query, table


def work_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-")
    return f"{shared.rstrip('/')}/engine-{uuid.uuid4().hex}"


@query("""WITH a AS (SELECT d.doc_id, d.lang AS source, d.source AS name, sha256(d."text") AS digest, toxic, quality FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic, max(quality) AS quality FROM labels GROUP BY 1) l USING (doc_id)),
t AS (SELECT source, CASE WHEN doc_id % 3 = 0 THEN doc_id + 1000000 ELSE doc_id END AS place, digest, toxic FROM a WHERE name <> 'src1'),
d AS (SELECT a.source, a.doc_id, t.place FROM a JOIN t ON a.source = t.source AND a.doc_id = t.place AND a.digest = t.digest),
l AS (SELECT source, doc_id, digest, row_number() OVER (PARTITION BY source, digest ORDER BY doc_id) AS k FROM a WHERE (source, doc_id) NOT IN (SELECT (source, doc_id) FROM d)),
s AS (SELECT source, place, digest, row_number() OVER (PARTITION BY source, digest ORDER BY place) AS k FROM t WHERE (source, place) NOT IN (SELECT (source, place) FROM d)),
m AS (SELECT source, doc_id, place, 'taxonomy_direct_hash' AS method FROM d UNION ALL SELECT l.source, l.doc_id, s.place, CASE WHEN s.place IS NULL THEN CASE WHEN l.source = 'en' THEN 'audit_fallback' ELSE 'missing' END ELSE 'taxonomy_digest_recovery' END FROM l LEFT JOIN s USING (source, digest, k))
SELECT m.source, m.method AS ability_join_method,
    CASE WHEN m.place IS NULL THEN CASE WHEN m.source = 'en' THEN 'CA' ELSE 'UNMAPPED' END WHEN t.toxic = 1 THEN 'AD' WHEN t.toxic = 0 THEN 'PR' ELSE 'UNMAPPED' END AS ability_bucket,
    CASE WHEN m.place IS NULL THEN CASE WHEN m.source = 'en' THEN 'audit_fallback' ELSE 'unmapped' END WHEN t.toxic = 1 THEN 'final' WHEN t.toxic = 0 THEN 'provisional' ELSE 'unmapped' END AS ability_label_source,
    CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'weak' END AS quality, count(*) AS n
FROM m JOIN a USING (source, doc_id) LEFT JOIN t ON t.source = m.source AND t.place = m.place GROUP BY ALL""")
def merged_annotations(spark, sf_dir):
    """Documents as samples; their labels as ability (final for toxic ones, provisional for others) and quality, a third of the
    ability labels at another place, none of one crawl; an audit of the English ones."""
    samples, taxonomy, quality = merge_inputs(spark, sf_dir)
    return merged_counts(merging.annotated(samples, taxonomy, quality, merging.Strict(False, False)))


def merge_inputs(spark, sf_dir):
    """Samples, ability labels and quality labels made of documents and their labels."""
    once = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
    docs = table(spark, sf_dir, "documents").join(once, "doc_id", "left")
    docs = docs.select("doc_id", F.col("lang").alias("source"), F.col("source").alias("name"), F.sha2("text", 256).alias("digest"), F.col("text").alias("input"), "toxic", "quality")
    audit = F.when(F.col("source") == "en", F.struct(F.lit("CA").alias("primary_label"), F.lit("checked").alias("status")))
    samples = docs.select("source", F.col("doc_id").alias("source_index"), "digest", "input", F.lit("x").alias("output"), audit.alias("audit"))
    moved = F.when(F.col("doc_id") % 3 == 0, F.col("doc_id") + 1000000).otherwise(F.col("doc_id"))
    say = lambda label: F.struct(label.alias("primary_label"), F.lit("exact").alias("taxonomy_fit"), F.lit("accepted").alias("status"))
    taxonomy = docs.filter("name <> 'src1'").select(
        "source", moved.alias("source_index"), "digest", F.concat_ws(":", "source", moved).alias("sample_id"), F.lit("c").alias("cluster_id"),
        say(F.when(F.col("toxic") == 0, "PR")).alias("provisional"), say(F.when(F.col("toxic") == 1, "AD")).alias("final"),
    )
    t = text.template(F.col("input"), F.lit("x"))
    quality = docs.filter("quality IS NOT NULL").select(
        "source", (F.col("doc_id") + 1).alias("line_number"), t["template_id"].alias("template_id"), t["input_hash"].alias("input_hash"), F.when(F.col("quality") == 1, "good").otherwise("weak").alias("quality"),
        F.lit("easy").alias("difficulty"), F.lit("r").alias("reason"), F.lit("m").alias("model"), F.lit("p").alias("prompt_version"),
    )
    return samples, taxonomy, quality


def merged_counts(rows):
    a = F.col("annotation")
    return rows.groupBy("source", *(a[c].alias(c) for c in ("ability_join_method", "ability_bucket", "ability_label_source", "quality"))).agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT p_type AS model, p_partkey, p_size, chr((65 + p_size % 5)::INT) AS gold, CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size % 7 = 1 THEN 'no idea' ELSE chr((65 + p_partkey % 5)::INT) END AS said FROM part),
n AS (SELECT count(*) AS n FROM part)
SELECT model, n.n AS expected_rows, count(*) AS matched_rows, n.n - count(*) AS missing_rows, count(*) FILTER (p_size % 11 = 0) AS invalid_rows,
    count(*) FILTER (said NOT IN ('', 'no idea') AND said = gold) AS correct_rows, count(*) FILTER (said NOT IN ('', 'no idea') AND said <> gold) AS incorrect_rows, count(*) FILTER (said = 'no idea') AS unparsed_rows, count(*) FILTER (said = '') AS error_rows,
    CASE WHEN count(*) = n.n AND count(*) FILTER (p_size % 11 = 0) = 0 THEN 'complete' ELSE 'partial' END AS status
FROM r, n GROUP BY model, n.n""")
def imported_results(spark, sf_dir):
    """Parts as questions; answers of each type of part written as JSON lines by model, some of them twice, and imported."""
    part = table(spark, sf_dir, "part")
    root = work_folder(spark)
    letter = lambda k: F.element_at(F.array(*map(F.lit, "ABCDE")), (F.pmod(k, F.lit(5)) + 1).cast("int"))
    said = F.when(F.col("p_size") % 7 == 0, "").when(F.col("p_size") % 7 == 1, "no idea").otherwise(letter(F.col("p_partkey")))
    rows = part.select(F.col("p_type").alias("model"), F.col("p_partkey").alias("idx"), said.alias("response"), F.when(F.col("p_size") % 11 == 0, 2).otherwise(1).alias("times"))
    rows.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times").repartition(4, "model").write.partitionBy("model").json(f"{root}/r/perception")
    gold = part.select(F.lit("bench_perception").alias("dataset"), F.col("p_partkey").alias("idx"), letter(F.col("p_size")).alias("output"))
    got = results.import_results(spark, f"{root}/r".removeprefix("file://"), gold, f"{root}/w", names="part-*.json")
    names = ["expected_rows", "matched_rows", "missing_rows", "invalid_rows", "correct_rows", "incorrect_rows", "unparsed_rows", "error_rows", "status"]
    return got.runs.select(F.regexp_replace("model_name", "^model=", "").alias("model"), *names)


@query("""SELECT count(*) AS records, sum(octet_length(encode(lang || source)) + 1)::BIGINT AS bytes, max(octet_length(encode(lang || source)) + 1) AS longest FROM documents""")
def byte_places(spark, sf_dir):
    """Documents' tags written as lines and indexed by byte places."""
    path = f"{work_folder(spark)}/lines"
    table(spark, sf_dir, "documents").select(F.concat_ws(":", "lang", "source")).write.text(path)
    return offsets.line_index(spark, path).agg(F.count("*").alias("records"), F.sum("byte_length").alias("bytes"), F.max("byte_length").alias("longest"))


@query("""SELECT count(*) + count(*) FILTER (toxic = 1) AS file_rows, count(*) FILTER (quality = 0) + count(*) FILTER (quality = 0 AND toxic = 1) AS ignored_other_model_or_prompt,
    count(*) FILTER (quality = 1) AS usable_rows, count(*) FILTER (quality = 1 AND toxic = 1) AS duplicate_identical FROM labels""")
def quality_label_scan(spark, sf_dir):
    """Labels as raw lines: toxic ones twice, those of low quality by another model."""
    rows = table(spark, sf_dir, "labels").select("toxic", F.col("doc_id").alias("line_number"), F.lit("h").alias("input_hash"), F.lit("good").alias("quality"), F.lit("easy").alias("difficulty"), F.lit("r").alias("reason"), F.when(F.col("quality") == 1, "m").otherwise("other").alias("model"), F.lit("p").alias("prompt_version"))
    raw = rows.union(rows.filter("toxic = 1")).select(F.to_json(F.struct(*(c for c in rows.columns if c != "toxic"))).alias("raw"))
    return merging.quality_labels(raw, "m", "p")[1]


@query("""WITH v AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT count(*) FILTER (n IS NULL) AS missing, count(*) FILTER (o_orderkey IS NULL) AS unexpected, count(*) FILTER (n > 1) AS duplicates FROM orders FULL JOIN v ON o_orderkey = l_orderkey""")
def vote_coverage(spark, sf_dir):
    """Returned lines as votes on orders."""
    queue = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cluster_id"))
    return resolve.coverage(queue, table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("cluster_id")))


@query("""SELECT role, CASE WHEN length(t) <= 80 AND NOT contains(t, chr(10)) THEN t WHEN contains(body, chr(10)) THEN 'multiline_text' ELSE 'text' END AS class, count(*) AS n
FROM (SELECT role, coalesce("text", '') AS body, trim(coalesce("text", ''), ' ' || chr(10) || chr(9) || chr(13)) AS t FROM conversations WHERE "text" IS NOT NULL) GROUP BY ALL""")
def answer_classes(spark, sf_dir):
    """What each turn says, if it is short, or else its form."""
    rows = table(spark, sf_dir, "conversations").filter("text IS NOT NULL")
    return rows.groupBy("role", text.answer_class(F.col("text")).alias("class")).agg(F.count("*").alias("n"))


@query("""SELECT lang, CASE WHEN contains("text", chr(10)) THEN 'multiline_text' ELSE 'text' END AS form, count(*) AS n FROM documents WHERE length("text") > 200 GROUP BY ALL""")
def document_forms(spark, sf_dir):
    """The form of every long text, as that of a training answer: folded and matched whole."""
    rows = table(spark, sf_dir, "documents").filter(F.length("text") > 200)
    return rows.groupBy("lang", text.structure(F.col("text")).alias("form")).agg(F.count("*").alias("n"))


@query("""SELECT d.source AS name, count(*) AS rows, count(DISTINCT sha256("text")) AS templates, count(DISTINCT lang) AS runs, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 0) AS bad, round_even(count(*) / count(DISTINCT sha256("text")), 3) AS compression
FROM documents d LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def dataset_catalogue(spark, sf_dir):
    """Crawls as datasets, languages as runs, labels as reviews."""
    docs = table(spark, sf_dir, "documents")
    of = docs.withColumn("dataset", F.col("source"))
    stats = of.groupBy("dataset").agg(F.count_distinct(F.sha2("text", 256)).alias("templates"))
    state = table(spark, sf_dir, "labels").join(of.select("doc_id", "dataset"), "doc_id").select("dataset", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad").alias("verdict"))
    return inspect.catalogue(docs.select(F.col("source").alias("name")).distinct(), of, stats, of.select("dataset", F.col("lang").alias("run_id")), state)


@query("""WITH c AS (SELECT o_orderpriority AS g, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY ALL)
SELECT g AS dataset_group, s AS status, n AS count, round_even(100.0 * n / (SELECT sum(n) FROM c x WHERE x.g = c.g), 4) AS percent FROM c""")
def status_distribution(spark, sf_dir):
    return reports.status_table(table(spark, sf_dir, "orders"), F.col("o_orderpriority"), F.col("o_orderstatus"))


@query("""SELECT source, doc_id AS source_index, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents""")
def numbered_sources(spark, sf_dir):
    """Places within each source, numbered in blocks."""
    return merge.numbered(table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("source_index")), "k", 1000)


@query("""SELECT vec_id, len(embedding)::INT AS points, round(list_sum(list_transform(embedding, lambda v: v::DOUBLE)), 6) AS total FROM embeddings""")
def whole_series(spark, sf_dir):
    """A series that has no more points than are shown is shown as it is."""
    points = series.downsampled(F.col("embedding"), 900)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", points.alias("p"))
    return rows.select("vec_id", F.size("p").alias("points"), F.round(F.aggregate("p", F.lit(0.0), lambda s, v: s + v), 6).alias("total"))
