"""Queries that write the tables' rows as files of records, sheets and logs, and read them back by the library's readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import resolve, review
from ..sources import commits, files, offsets, places, readers, records
from . import merging, pipelines
from .more_queries import merge_inputs, merged_annotations, merged_counts, work_folder
from .queries import SQL, query, table

#: Bytes a chunk of the records' source here: small, so that records lie over the borders of chunks at any scale.
CHUNK = 1 << 20


def _groups(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _write_lines(rows: DataFrame, path: str, order: list[str]) -> None:
    """rows (g, value) as lines, a file for each g, in order."""
    dealt = rows.repartition(_groups(rows.sparkSession), "g").sortWithinPartitions("g", *order)
    dealt.select("g", "value").write.partitionBy("g").text(path)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, g and a line: the number, a tab, the text with its line breaks written out."""
    body = F.coalesce("text", F.lit(""))
    for sign, told in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        body = F.replace(body, F.lit(sign), F.lit(told))
    g = F.pmod(F.xxhash64("doc_id"), F.lit(_groups(spark)))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", g.alias("g"), F.concat(F.col("doc_id").cast("string"), F.lit("\t"), body).alias("value"))


LINE = r"""doc_id || chr(9) || replace(replace(replace(coalesce("text", ''), '\', '\\'), chr(10), '\n'), chr(13), '\r')"""


@query(f"""SELECT doc_id, octet_length(encode({LINE}))::BIGINT AS byte_length, sha256({LINE}) AS sha256, true AS gapless FROM documents""")
def record_lines(spark, sf_dir):
    """Every document's whole text as a line, read by byte ranges: lengths and digests; each line begins where the one
    before it ends."""
    path = f"{work_folder(spark)}/lines"
    _write_lines(_documents(spark, sf_dir), path, ["doc_id"])
    out = records.records(spark, path, chunk=CHUNK, columns=("sha256", "raw"))
    # The line after it says where it should begin: numbers are joined, no file is one window.
    after = out.select("file", (F.col("line_index") + 1).alias("line_index"), (F.col("byte_offset") + F.col("byte_length") + 1).alias("due"))
    told = out.join(after, ["file", "line_index"], "left")
    number = F.split_part(F.col("raw").cast("string"), F.lit("\t"), F.lit(1)).cast("long")
    return told.select(number.alias("doc_id"), "byte_length", "sha256", (F.col("byte_offset") == F.coalesce("due", F.lit(0))).alias("gapless"))


@query("""SELECT doc_id, length(coalesce("text", ''))::BIGINT AS n_chars, sha256(coalesce("text", '')) AS text_sha256, lang FROM documents""")
def array_elements(spark, sf_dir):
    """Every document as an element of a JSON array, a file of them a group; the arrays are split over tasks at any byte."""
    path = f"{work_folder(spark)}/arrays"
    n = _groups(spark)
    docs = _documents(spark, sf_dir).drop("value").join(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    told = F.concat(F.to_json(F.struct("doc_id", "lang", "text", F.array("doc_id", F.lit(1)).alias("more"))), F.lit(","))
    edge = lambda at, value: spark.range(n).select(F.col("id").alias("g"), F.lit(at).alias("at"), F.lit(None).cast("long").alias("doc_id"), F.lit(value).alias("value"))
    rows = docs.select("g", F.lit(1).alias("at"), "doc_id", told.alias("value")).unionByName(edge(0, "[")).unionByName(edge(2, '{"last": "],["}]'))
    _write_lines(rows, path, ["at", "doc_id"])
    out = records.records(spark, path, "array", chunk=CHUNK, columns=("raw",))
    r = F.from_json(F.col("raw").cast("string"), "doc_id long, lang string, text string")
    return out.select(r.alias("r")).filter("r.doc_id IS NOT NULL").select("r.doc_id", F.length("r.text").cast("long").alias("n_chars"), F.sha2("r.text", 256).alias("text_sha256"), "r.lang")


@query(f"""SELECT doc_id, sha256({LINE}) AS record_sha256, lang || ':' || source AS audit FROM documents""")
def record_places(spark, sf_dir):
    """Every document's line and its audit's, attached by position, written as an index for lookups, and read back by place."""
    home = work_folder(spark)
    docs = _documents(spark, sf_dir)
    _write_lines(docs, f"{home}/records", ["doc_id"])
    _write_lines(docs.withColumn("value", F.concat_ws(":", "lang", "source")), f"{home}/audits", ["doc_id"])
    group = F.regexp_extract("file", r"/g=(\d+)/", 1).alias("g")
    index, audit = offsets.line_index(spark, f"{home}/records"), offsets.line_index(spark, f"{home}/audits")
    of = index.select(group, F.col("file").alias("of")).distinct()  # one row a file
    audit = audit.select("*", group).join(of, "g").drop("g")
    places.write(places.attached(index, {"audit": audit}), f"{home}/index", rows=1 << 14)
    held = spark.read.parquet(f"{home}/index/places").select("file", "byte_offset", "byte_length", *(F.col(f"audit.{c}").alias(f"audit_{c}") for c in ("file", "byte_offset", "byte_length")))
    # Audits first: they are short, and the second read deals what the first one gave.
    both = records.raw_at(records.raw_at(held, "audit_file", "audit_byte_offset", "audit_byte_length", "audit"))
    line = F.col("raw").cast("string")
    return both.select(F.split_part(line, F.lit("\t"), F.lit(1)).cast("long").alias("doc_id"), F.sha2("raw", 256).alias("record_sha256"), F.col("audit").cast("string").alias("audit"))


EVENTS = T.StructType([T.StructField("dataset", T.StringType()), T.StructField("line_index", T.LongType()), T.StructField("verdict", T.StringType()), T.StructField("revision", T.LongType())])


@query("""WITH e AS (SELECT event_type AS dataset, user_id AS line_index, min(event_id) AS first, max(event_id) AS last FROM events GROUP BY ALL)
SELECT dataset, line_index, CASE WHEN first < last THEN last ELSE first END::VARCHAR AS verdict, CASE WHEN first < last THEN 2 ELSE 1 END::BIGINT AS revision FROM e WHERE NOT (first < last AND last % 2 = 0)
UNION ALL SELECT dataset, line_index, 'again', 3 FROM e WHERE first < last AND last % 2 = 0""")
def review_commits(spark, sf_dir):
    """Each user's reviews of an event's type in a log of commits: the first event, then the last one, then some again. The
    latest state is read of three commits."""
    log = commits.Log(spark, f"{work_folder(spark)}/reviews")
    keys = ["dataset", "line_index"]
    ends = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("dataset"), F.col("user_id").alias("line_index")).agg(F.min("event_id").alias("a"), F.max("event_id").alias("b"))
    more = ends.filter("a < b")
    for k, (rows, verdict) in enumerate(((ends, F.col("a").cast("string")), (more, F.col("b").cast("string")), (more.filter("b % 2 = 0"), F.lit("again")))):
        commits.append(log, rows.select(*keys, verdict.alias("verdict")), keys, F.lit(k), EVENTS)
    return review.current(log.read(EVENTS), keys)


@query(SQL[merged_annotations.__name__])
def merged_by_source(spark, sf_dir):
    """The merge by languages, made twice: the second time only of the language whose signature has changed."""
    samples, taxonomy, quality = merge_inputs(spark, sf_dir)
    out, names = f"{work_folder(spark)}/merge", [r.source for r in samples.select("source").distinct().collect()]  # languages
    again = {n: "2" if n == min(names) else "1" for n in names}
    for signatures in ({n: "1" for n in names}, again):
        merging.merge_changed(samples, taxonomy, quality, signatures, out, ["input", "output"], merging.Strict(False, False), with_samples=False)
    return merged_counts(merging.merged_rows(spark, out))


@query("""WITH s AS (SELECT p_brand AS cluster_id, p_partkey AS line, ['AD', 'none', 'PR', ''][(p_size % 4)::INT + 1] AS label, ['exact', 'closest', '', 'out_of_scope'][((p_size // 4) % 4)::INT + 1] AS fit, 'by ' || p_type AS rationale FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY line DESC) AS k FROM s WHERE fit <> '')
SELECT cluster_id, CASE WHEN label NOT IN ('none', '') THEN label END AS primary_label, CASE label WHEN 'AD' THEN 'TR' ELSE 'AD,TR' END AS secondary_labels, fit AS taxonomy_fit, rationale FROM r WHERE k = 1""")
def human_sheet(spark, sf_dir):
    """Parts as rows of a sheet on their brands, written as CSV, read, checked, and the last filled-in row of each taken."""
    path = f"{work_folder(spark)}/sheet"
    letter = lambda values, key: F.element_at(F.array(*map(F.lit, values)), (key % 4 + 1).cast("int"))
    sheet = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("cluster_id"), letter(["AD", "none", "PR", ""], F.col("p_size")).alias("human_primary_label"), F.lit("TR; AD|TR").alias("human_secondary_labels"),
        letter(["exact", "closest", "", "out_of_scope"], F.floor(F.col("p_size") / 4)).alias("human_taxonomy_fit"), F.concat(F.lit("by "), "p_type").alias("human_rationale"), F.col("p_partkey").alias("line"),
    )
    sheet.write.csv(path, header=True, quoteAll=True)
    read = readers.read_csv(spark, path)
    out = resolve.human_labels(read, read["line"].cast("long"))
    return out.select("cluster_id", "primary_label", F.array_join("secondary_labels", ",").alias("secondary_labels"), "taxonomy_fit", "rationale")


@query("""SELECT vec_id, len(embedding)::INT AS points, round(list_sum(list_transform(embedding, lambda v: v::DOUBLE)), 4) AS total, label::VARCHAR AS answer,
    'Input time series: <ts><ts/>.' || chr(10) || chr(10) || 'Which class is item ' || vec_id || '?' AS input FROM embeddings""")
def converted_files(spark, sf_dir):
    """Vectors as series in files of three formats, under three names of the field, converted together."""
    home = work_folder(spark)
    points = F.transform("embedding", lambda v: v.cast("double"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.concat(F.lit("Which class is item "), F.col("vec_id").cast("string"), F.lit("?")).alias("question"), F.col("label").cast("string").alias("answer"), points.alias("p"))
    kind = F.pmod(F.xxhash64("vec_id"), F.lit(3))
    rows.filter(kind == 0).select("question", F.to_json("p").alias("input_ts"), "answer").write.csv(f"{home}/in/a", header=True, quoteAll=True, escape='"')
    rows.filter(kind == 1).select(F.to_json(F.struct("question", F.col("p").alias("timeseries"), "answer"))).write.text(f"{home}/in/b")
    files.rename(spark, f"{home}/in/b", ".txt", ".jsonl")
    rows.filter(kind == 2).select("question", F.array("p").alias("series"), "answer").write.parquet(f"{home}/in/c")
    pipelines.convert_files(spark, [f"{home}/in"], "primary", f"{home}/out")
    out = spark.read.schema("input string, timeseries array<array<double>>, output string").json(f"{home}/out/samples")
    series = F.flatten("timeseries")
    number = F.regexp_extract("input", r"item (\d+)", 1).cast("long")
    return out.select(number.alias("vec_id"), F.size(series).alias("points"), F.round(F.aggregate(series, F.lit(0.0), lambda s, v: s + v), 4).alias("total"), F.col("output").alias("answer"), "input")
