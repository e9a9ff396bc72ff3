"""Queries that run the operators over the driver's tables, with SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, series, text
from ..operators import cluster, convert, evaluate, merge, reports, resolve, review, selection

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# RE2 has no lookbehind: a sentinel splits a number from a signed number behind it.
SHAPED = r"""trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(replace(lower("text"), '<ts><ts/>', ' <ts> '), 'https?://\S+', '<url>', 'g'),
    '([0-9])([-+][0-9])', '\1' || chr(1) || '\2', 'g'), '([0-9])([-+][0-9])', '\1' || chr(1) || '\2', 'g'),
    '(^|[^a-z])[-+]?[0-9]+(?:\.[0-9]+)?(?:e[-+]?[0-9]+)?', '\1<num>', 'g'), chr(1), ''), '\s+', ' ', 'g'))"""


@query(f"""SELECT substr(sha256(t), 1, 24) AS template_id, count(*) AS member_count, min(doc_id) AS doc_id
FROM (SELECT doc_id, {SHAPED} AS t FROM documents) GROUP BY 1""")
def template_census(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.cluster_template(F.col("text")).alias("t"))
    return cluster.census(docs, F.substring(F.sha2("t", 256), 1, 24), [F.col("doc_id")], ["doc_id"]).orderBy(F.desc("member_count"), "template_id")


@query(f"""SELECT substr(sha256(source || chr(10) || t), 1, 24) AS cluster_id, count(*) AS member_count, min(doc_id) AS doc_id
FROM (SELECT doc_id, source, {SHAPED} AS t FROM documents) GROUP BY 1""")
def source_census(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.cluster_id(F.col("source"), text.cluster_template(F.col("text"))).alias("c"))
    return cluster.census(docs, F.col("c"), [F.col("doc_id")], ["doc_id"], "cluster_id")


@query(f"""WITH c AS (SELECT t, count(*) AS n, max((lang = 'en')::INT) AS m FROM (SELECT lang, {SHAPED} AS t FROM documents) GROUP BY 1)
SELECT sum(n)::BIGINT AS rows, count(*) AS templates, count(*) FILTER (m = 1) AS cached, count(*) FILTER (m = 0) AS pending, round_even(sum(n) / count(*), 3) AS ratio FROM c""")
def compression_report(spark, sf_dir):
    """The cache holds the templates of English documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2(text.cluster_template(F.col("text")), 256).alias("template_id"))
    return cluster.compression(cluster.census(docs, F.col("template_id"), [F.col("doc_id")], ["doc_id"]), docs.filter("lang = 'en'"))


@query("""SELECT doc_id, sha256("text") AS digest FROM documents QUALIFY row_number() OVER (PARTITION BY sha256("text") ORDER BY doc_id) = 1""")
def exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return convert.first_of_each(docs, F.col("digest"), [F.col("doc_id")])


@query("""SELECT doc_id, source, lang FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY sha256('17' || chr(0) || doc_id), doc_id) <= 3""")
def capped_sample(spark, sf_dir):
    return selection.capped(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), ["source", "lang"], "doc_id", 3, 17)


@query("""SELECT sum(n)::BIGINT AS candidates, sum(least(n, 3))::BIGINT AS selected, count(*) AS clusters, count(*) FILTER (n > 3) AS capped, max(n) AS largest, sum(n - least(n, 3))::BIGINT AS filtered
FROM (SELECT count(*) AS n FROM documents GROUP BY source, lang)""")
def cap_statistics(spark, sf_dir):
    return selection.cap_report(table(spark, sf_dir, "documents"), ["source", "lang"], 3)


PROMPTS = (
    ("Describe the trend and periodicity.", "PR"), ("What are the noise characteristics and noise magnitude?", "NU"), ("Locate the anomalous segment.", "AD"), ("Compare the trend between series A and B.", "CA"),
    ("What underlying cause generated this observed series?", "ER"), ("Find the directed causal relationship between the rivers.", "CD"), ("What might have happened during this sudden change?", "AR"), ("Put these events in chronological order.", "TR"),
    ("Calculate the mean value of the series.", "NR"), ("According to the stated equation, derive the correct result.", "DR"), ("Infer the underlying rule and predict the next symbol.", "IR"), ("Predict the next 12 time series values.", "TSF"),
    ("Predict whether the machine will fail within 24 hours.", "EP"), ("Which treatment is the most appropriate management action?", "QualDM"), ("Backtest each strategy and choose the best return.", "QuantDM"), ("Say something.", "NONE"),
)


def pick(values: list[str], key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


@query(f"""SELECT label, count(*) AS n FROM (SELECT {sql_list([x for _, x in PROMPTS])}[(o_orderkey % {len(PROMPTS)})::INT + 1] AS label FROM orders) GROUP BY 1""")
def rule_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(pick([p for p, _ in PROMPTS], F.col("o_orderkey")).alias("input"))
    decided = rules.decided(rows, F.lit("any"), F.lit(""), F.col("input"), "d")
    return decided.groupBy(F.coalesce("d.primary_label", F.lit("NONE")).alias("label")).agg(F.count("*").alias("n"))


TASKS = ("tsaqa|classification", "time_mqa|imputation", "tsaqa|comparison", "time_mqa|forecasting")


@query("""SELECT * FROM (SELECT ['tsaqa', 'time_mqa', 'tsaqa', 'time_mqa'][(o_orderkey % 4)::INT + 1] AS source, ['closest', 'out_of_scope', 'exact', 'exact'][(o_orderkey % 4)::INT + 1] AS fit,
    ['PR', NULL, 'CA', 'TSF'][(o_orderkey % 4)::INT + 1] AS label, ['review', 'review', 'auto_accept', 'auto_accept'][(o_orderkey % 4)::INT + 1] AS status, count(*) AS n FROM orders GROUP BY ALL)""")
def metadata_labels(spark, sf_dir):
    task = F.split(pick(list(TASKS), F.col("o_orderkey")), "\\|")
    rows = table(spark, sf_dir, "orders").select(task[0].alias("source"), task[1].alias("task"))
    d = rows.select("source", rules.decide(F.col("source"), F.col("task"), F.lit("Say something.")).alias("d"))
    return d.groupBy("source", F.col("d.taxonomy_fit").alias("fit"), F.col("d.primary_label").alias("label"), F.col("d.status").alias("status")).agg(F.count("*").alias("n"))


ANSWERS = (("<ts><ts/>", "time_series"), ("<answer>B</answer>", "choice_label"), ("(C)", "choice_label"), ("<think>x</think><answer>A</answer>", "reasoning_with_label"), ("<think>x</think><answer>up</answer>", "reasoning_with_answer"), ("<answer>up</answer>", "tagged_answer"), ("-3.5e2", "scalar"), ("one\ntwo", "multiline_text"), ("plain words", "text"), ("[1, 2, 3, 4]", "time_series"))


@query(f"""SELECT form, count(*) AS n FROM (SELECT {sql_list([x for _, x in ANSWERS])}[(l_orderkey % {len(ANSWERS)})::INT + 1] AS form FROM lineitem) GROUP BY 1""")
def answer_forms(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(text.structure(pick([a for a, _ in ANSWERS], F.col("l_orderkey"))).alias("form"))
    return rows.groupBy("form").agg(F.count("*").alias("n"))


REPLIES = (('{"answer": "b"}', "B"), ("<answer> c </answer>", "C"), ("Final answer: D.", "D"), ("```json\n{'answer': 'E'}\n```", "E"), ("A", "A"), ("no idea", ""))


@query(f"""SELECT letter, count(*) AS n FROM (SELECT nullif({sql_list([x for _, x in REPLIES])}[(l_orderkey % {len(REPLIES)})::INT + 1], '') AS letter FROM lineitem) GROUP BY 1""")
def choice_answers(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(text.choice(pick([a for a, _ in REPLIES], F.col("l_orderkey"))).alias("letter"))
    return rows.groupBy("letter").agg(F.count("*").alias("n"))


@query("""SELECT substr(sha256('{"answer_structure":"scalar","question_template":"What follows <ts> for <num>?"}'), 1, 24) AS template_id, count(*) AS members, min(p_partkey) AS first_part FROM part""")
def quality_templates(spark, sf_dir):
    numbers = F.concat_ws(", ", F.col("p_size"), F.col("p_retailprice"), F.lit("-1e5"), F.lit(".5"))
    rows = table(spark, sf_dir, "part").select("p_partkey", text.template(F.concat(F.lit("What  follows ["), numbers, F.lit("]\nfor "), F.col("p_size").cast("string"), F.lit("?")), F.col("p_size").cast("string")).alias("t"))
    return rows.groupBy("t.template_id").agg(F.count("*").alias("members"), F.min("p_partkey").alias("first_part"))


@query("""SELECT d.source, count(*) AS total_rows, count(l.quality) AS quality_labeled_rows, count(l.toxic) AS ability_rows,
    round_even(100.0 * count(l.quality) / count(*), 4) AS quality_coverage_percent, round_even(100.0 * count(l.toxic) / count(*), 4) AS ability_coverage_percent, count(*) - count(l.toxic) AS ability_unmapped_rows,
    '{' || concat_ws(',', CASE WHEN count(l.doc_id) > 0 THEN '"label":' || count(l.doc_id) END, CASE WHEN count(*) > count(l.doc_id) THEN '"missing":' || (count(*) - count(l.doc_id)) END) || '}' AS join_methods
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def label_coverage(spark, sf_dir):
    rows = merge.with_quality(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), ["doc_id"])
    return reports.coverage(rows, "source", F.col("quality"), F.col("toxic"), F.when(F.col("quality").isNull(), "missing").otherwise("label"))


def _cells(spark, sf_dir) -> DataFrame:
    rows = merge.with_quality(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), ["doc_id"])
    return reports.cube(rows.select("lang", F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic")), ["lang", "quality", "toxic"])


CELLS = "cells AS (SELECT lang, coalesce(quality::VARCHAR, 'MISSING') AS quality, coalesce(toxic::VARCHAR, 'MISSING') AS toxic, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL)"
LANGS = ["en", "de", "fr", "es", "xx"]


@query(f"""WITH {CELLS}, g AS (SELECT * FROM (SELECT unnest({sql_list(LANGS)}) AS lang), (SELECT unnest(['0', '1']) AS quality), (SELECT unnest(['0', '1']) AS toxic))
SELECT g.*, coalesce(n, 0) AS count, round_even(100.0 * coalesce(n, 0) / (SELECT sum(n) FROM cells), 4) AS percent_all,
    coalesce(round_even(100.0 * coalesce(n, 0) / (SELECT sum(n) FROM cells c WHERE c.lang = g.lang), 4), 0) AS percent_within
FROM g LEFT JOIN cells USING (lang, quality, toxic)""")
def zero_filled_cube(spark, sf_dir):
    return reports.zero_filled(_cells(spark, sf_dir), {"lang": LANGS, "quality": ["0", "1"], "toxic": ["0", "1"]}, "lang")


@query(f"""WITH {CELLS} SELECT 'lang' AS dimension, lang AS value, sum(n)::BIGINT AS count FROM cells GROUP BY lang UNION ALL SELECT 'quality', quality, sum(n)::BIGINT FROM cells GROUP BY quality UNION ALL SELECT 'toxic', toxic, sum(n)::BIGINT FROM cells GROUP BY toxic""")
def cube_marginals(spark, sf_dir):
    return reports.marginals(_cells(spark, sf_dir), ["lang", "quality", "toxic"])


@query(f"""WITH {CELLS} SELECT lang, sum(n)::BIGINT AS count, round_even(100.0 * sum(n) / (SELECT sum(n) FROM cells), 4) AS percent_all,
    round_even(100.0 * coalesce(sum(n) FILTER (quality = '1'), 0) / sum(n), 4) AS high_percent, round_even(100.0 * coalesce(sum(n) FILTER (toxic = '1'), 0) / sum(n), 4) AS hard_percent FROM cells GROUP BY lang""")
def ability_shares(spark, sf_dir):
    return reports.ability_summary(_cells(spark, sf_dir), "lang", F.col("quality") == "1", F.col("toxic") == "1")


@query("""WITH c AS (SELECT l_returnflag, l_linestatus AS s, (l_linenumber % 3)::VARCHAR AS m FROM lineitem),
g AS (SELECT r.l_returnflag, d.* FROM (SELECT DISTINCT l_returnflag FROM c) r, (VALUES ('status', 'F'), ('status', 'O'), ('status', 'X'), ('third', '0'), ('third', '1'), ('third', '2')) d(dimension, label)),
n AS (SELECT l_returnflag, 'status' AS dimension, s AS label, count(*) AS n FROM c GROUP BY ALL UNION ALL SELECT l_returnflag, 'third', m, count(*) FROM c GROUP BY ALL)
SELECT g.l_returnflag, g.dimension, g.label, coalesce(n.n, 0) AS count, round_even(100.0 * coalesce(n.n, 0) / t.n, 4) AS percent
FROM g LEFT JOIN n USING (l_returnflag, dimension, label) JOIN (SELECT l_returnflag, count(*) AS n FROM c GROUP BY 1) t USING (l_returnflag)""")
def summary_long(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_linestatus").alias("status"), (F.col("l_linenumber") % 3).cast("string").alias("third"))
    return reports.long_summary(reports.cube(rows, ["l_returnflag", "status", "third"]), "l_returnflag", {"status": ["F", "O", "X"], "third": ["0", "1", "2"]})


@query("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "o_orderstatus_F", count(*) FILTER (o_orderstatus = 'O') AS "o_orderstatus_O", count(*) FILTER (o_orderstatus = 'P') AS "o_orderstatus_P" FROM orders GROUP BY 1""")
def summary_wide(spark, sf_dir):
    return reports.wide_summary(reports.cube(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"]), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("""WITH labels AS (SELECT n_name AS label FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AFRICA'),
o AS (SELECT CASE WHEN c_mktsegment LIKE 'A%' THEN 'first' ELSE c_mktsegment END AS dataset_group, CASE WHEN c_acctbal > 0 THEN n_name END AS label FROM customer JOIN nation ON c_nationkey = n_nationkey),
n AS (SELECT dataset_group, label, count(*) AS n FROM o JOIN labels USING (label) GROUP BY ALL)
SELECT g.dataset_group, g.label, coalesce(n, 0) AS count, coalesce(round_even(100.0 * coalesce(n, 0) / (SELECT sum(n) FROM n x WHERE x.dataset_group = g.dataset_group), 4), 0) AS percent
FROM (SELECT DISTINCT a.dataset_group, b.label FROM o a, labels b) g LEFT JOIN n USING (dataset_group, label)""")
def grouped_distribution(spark, sf_dir):
    """Labels are the nations of one region; customers of other nations carry labels that aren't on the list."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    own = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).filter("r_name = 'AFRICA'")
    names = [r.n_name for r in own.select("n_name").collect()]  # five labels
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return reports.distribution(rows, reports.dataset_group(F.col("c_mktsegment"), {"A": "first"}), F.col("n_name"), F.col("c_acctbal") > 0, names)


@query("""WITH v AS (SELECT l_orderkey AS c, l_returnflag AS p, min(l_linenumber * 10000000000 + l_partkey * 10000 + l_suppkey) AS s, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT c AS cluster_id, sum(n)::BIGINT AS votes, arg_min(p, (-n, s)) AS primary_label, max(n) AS agree FROM v GROUP BY c""")
def vote_tally(spark, sf_dir):
    votes = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cluster_id"), (F.col("l_linenumber") * F.lit(10000000000) + F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("seen"), F.col("l_returnflag").alias("primary_label"), F.array("l_linestatus").alias("secondary_labels"), F.lit("exact").alias("taxonomy_fit"), F.col("l_discount").alias("confidence"))
    return resolve.tally(votes).select("cluster_id", "votes", "winner.primary_label", "winner.agree")


@query("""WITH p AS (SELECT o_orderkey, (o_orderkey % 16)::INT AS k, o_orderpriority = '1-URGENT' AS human, o_orderstatus = 'P' AS model FROM orders),
v AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT method, status, count(*) AS n FROM (SELECT CASE WHEN human THEN 'human' WHEN k IN (0, 8, 9, 10, 15, 4) THEN CASE WHEN model THEN 'authoritative_model' WHEN v.n >= 2 THEN 'model_consensus' ELSE 'unresolved' END ELSE 'rules' END AS method,
    CASE WHEN human THEN 'accepted' WHEN k IN (0, 8, 9, 10, 15, 4) THEN CASE WHEN model THEN 'excluded' WHEN v.n >= 2 THEN 'accepted' ELSE 'human_review' END ELSE 'accepted' END AS status
    FROM p LEFT JOIN v ON o_orderkey = l_orderkey) GROUP BY ALL""")
def vote_resolve(spark, sf_dir):
    """Every line is a vote; urgent orders have a human label, pending ones an authoritative vote."""
    orders = table(spark, sf_dir, "orders")
    prompts = spark.createDataFrame(list(enumerate(p for p, _ in PROMPTS)), "k int, prompt string")
    told = prompts.select("k", rules.decide(F.lit("any"), F.lit(""), F.col("prompt")).alias("provisional"))  # each prompt once
    rows = orders.withColumn("k", F.pmod("o_orderkey", F.lit(len(PROMPTS))).cast("int")).join(F.broadcast(told), "k").select(F.col("o_orderkey").alias("cluster_id"), "provisional")
    empty = F.array().cast("array<string>")
    human = orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("cluster_id"), F.lit("AD").alias("primary_label"), empty.alias("secondary_labels"), F.lit("exact").alias("taxonomy_fit"))
    model = orders.filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("cluster_id"), F.lit(None).cast("string").alias("primary_label"), empty.alias("secondary_labels"), F.lit("out_of_scope").alias("taxonomy_fit"), F.lit(0.9).alias("confidence"))
    votes = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cluster_id"), F.col("l_linenumber").alias("seen"), F.lit("IR").alias("primary_label"), empty.alias("secondary_labels"), F.lit("exact").alias("taxonomy_fit"), (F.col("l_discount") / 10).alias("confidence"))
    out = resolve.resolve(rows, human, model, resolve.tally(votes))
    return out.groupBy(F.col("final.method").alias("method"), F.col("final.status").alias("status")).agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT unnest(list_filter([CASE WHEN doc_id % 4 = 0 THEN 'answer_leakage' END, CASE WHEN doc_id % 3 = 0 THEN 'visual_grounding_mismatch' END], lambda x: x IS NOT NULL)) AS flag FROM documents)
SELECT flag, count(*) AS count, round_even(100.0 * count(*) / (SELECT count(*) FROM documents), 4) AS percent FROM f GROUP BY 1""")
def issue_histogram(spark, sf_dir):
    prompt = F.when(F.col("doc_id") % 4 == 0, F.lit("You must end\nwith the ANSWER : x")).otherwise(F.lit("no"))
    output = F.when(F.col("doc_id") % 3 == 0, F.lit("as the Chart shows")).otherwise(F.lit("charted"))
    return reports.histogram(table(spark, sf_dir, "documents").select("doc_id"), text.issues(prompt, output))


@query("""WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS e FROM embeddings)
SELECT vec_id, len(e)::INT AS length, round(list_min(e), 9) AS min, round(list_max(e), 9) AS max, round(list_sum(e) / len(e), 9) AS mean,
    round(sqrt(list_sum(list_transform(e, lambda v: (v - list_sum(e) / len(e)) * (v - list_sum(e) / len(e)))) / len(e)), 9) AS std, round(e[1], 9) AS first, round(e[-1], 9) AS last FROM x""")
def channel_statistics(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", series.statistics(F.col("embedding")).alias("s"))
    return rows.select("vec_id", "s.length", *(F.round(f"s.{c}", 9).alias(c) for c in ("min", "max", "mean", "std", "first", "last")))


@query("""WITH RECURSIVE x AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS e, len(embedding) AS n, (len(embedding) - 2) / 14.0 AS step FROM embeddings),
r AS (SELECT vec_id, e, n, step, 0 AS k, 0::BIGINT AS last, [e[1]] AS points FROM x
UNION ALL SELECT vec_id, e, n, step, k + 1, best.i, list_append(points, e[best.i + 1]) FROM (
    SELECT *, list_reduce(list_transform(range(lo, greatest(lo + 1, least(hi, n - 1))), lambda i: {'a': abs((last - hi) * (e[i + 1] - e[last + 1]) - (last - i) * (mean - e[last + 1])), 'i': i}), lambda p, q: CASE WHEN q.a > p.a THEN q ELSE p END) AS best
    FROM (SELECT *, list_sum(e[hi + 1:hi2]) / (hi2 - hi) AS mean FROM (
        SELECT *, floor(k * step)::BIGINT + 1 AS lo, floor((k + 1) * step)::BIGINT + 1 AS hi, least(floor((k + 2) * step)::BIGINT + 1, n) AS hi2 FROM r WHERE k < 14))))
SELECT vec_id, list_append(points, e[n]) AS points FROM r WHERE k = 14""")
def downsampled_series(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", series.downsampled(F.col("embedding"), 16).alias("points"))


@query("""SELECT min(doc_id) AS doc_id FROM (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) WHERE doc_id > 50""")
def next_unlabeled(spark, sf_dir):
    return review.next_unlabeled(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"], "doc_id", 50)


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40""")
def order_page(spark, sf_dir):
    return evaluate.page(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 40, 20)


@query("""SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max("value", event_id) AS value FROM events GROUP BY 1""")
def latest_state(spark, sf_dir):
    return review.current(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], "event_id")


@query("""WITH r AS (SELECT d.source AS source, count(*) AS total, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 0) AS bad, count(l.doc_id) AS labeled FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1),
a AS (SELECT source, total, good, bad, labeled FROM r UNION ALL SELECT NULL, sum(total)::BIGINT, sum(good)::BIGINT, sum(bad)::BIGINT, sum(labeled)::BIGINT FROM r)
SELECT *, total - labeled AS remaining, round_even(100.0 * labeled / total, 4) AS coverage FROM a""")
def review_progress(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    state = table(spark, sf_dir, "labels").join(docs, "doc_id").select("source", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("verdict"))
    return review.progress(docs, state, "source")


def _answers(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(
        F.col("l_returnflag").alias("run_id"), F.lit("d").alias("dataset"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_index"),
        F.when(F.col("l_linenumber") == 6, "error").when(F.col("l_linenumber") == 5, "empty").otherwise("ok").alias("generation_status"),
        F.when(F.col("l_linenumber") == 4, "unparsed").otherwise("parsed").alias("parse_status"),
        F.when(F.col("l_linenumber") >= 4, "unknown").when(F.col("l_linestatus") == "F", "correct").otherwise("incorrect").alias("correctness"),
    )


@query("""WITH r AS (SELECT unnest(['A', 'N', 'R', 'Z']) AS run_id)
SELECT run_id, count(*) FILTER (l_linenumber < 4 AND l_linestatus = 'F') AS correct_rows, count(*) FILTER (l_linenumber < 4 AND l_linestatus <> 'F') AS incorrect_rows, count(*) FILTER (l_linenumber = 4) AS unparsed_rows,
    count(*) FILTER (l_linenumber IN (5, 6)) AS error_rows, count(l_orderkey) AS matched_rows FROM r LEFT JOIN lineitem ON l_returnflag = run_id GROUP BY 1""")
def scoreboard(spark, sf_dir):
    return evaluate.scoreboard(reports.levels(spark, "run_id", ["A", "N", "R", "Z"]), _answers(spark, sf_dir))


@query("""SELECT CASE l_linenumber WHEN 6 THEN 'error' WHEN 5 THEN 'empty' WHEN 4 THEN 'unparsed' ELSE CASE WHEN l_linenumber > 6 THEN 'unknown' WHEN l_linestatus = 'F' THEN 'correct' ELSE 'incorrect' END END AS status, count(*) AS n FROM lineitem GROUP BY 1""")
def shown_status(spark, sf_dir):
    shown = evaluate.status(F.col("generation_status"), F.col("parse_status"), F.col("correctness"))
    return _answers(spark, sf_dir).groupBy(shown.alias("status")).agg(F.count("*").alias("n"))


@query("""SELECT count(*) AS n, count(*) FILTER (l_linenumber = 4) AS unread, count(*) FILTER (l_linenumber IN (5, 6)) AS failed FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber >= 4""")
def unknown_badcases(spark, sf_dir):
    rows = evaluate.badcases(_answers(spark, sf_dir), "R", "unknown")
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col("parse_status") == "unparsed").alias("unread"), F.count_if(F.col("generation_status") != "ok").alias("failed"))


@query("""SELECT event_type, count(k) AS parsed, sum(k)::BIGINT AS total FROM (SELECT event_type, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1""")
def json_fields(spark, sf_dir):
    k = text.nonnegative(F.get_json_object("props", "$.k"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(k).alias("parsed"), F.sum(k).alias("total"))


@query("""SELECT o_orderstatus, count(*) AS n, round_even(100.0 * count(*) / (SELECT count(*) FROM orders), 4) AS percent FROM orders GROUP BY 1""")
def status_shares(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    out = orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")).crossJoin(orders.agg(F.count("*").alias("t")))
    return out.select("o_orderstatus", "n", text.percent(F.col("n"), F.col("t")).alias("percent"))


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def missing_calls(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return cluster.missing(table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("""SELECT source, lang, count(*) AS members, count(DISTINCT "text") AS answers, min(doc_id) AS first_index, max(doc_id) AS last_index FROM documents GROUP BY ALL""")
def template_members(spark, sf_dir):
    return evaluate.template_summary(table(spark, sf_dir, "documents").select("source", "lang", "doc_id", F.xxhash64("text").alias("a")), ["source", "lang"], "a", "doc_id")


@query("""SELECT * FROM (SELECT p_brand, p_type, count(*) AS count, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS rank FROM part GROUP BY p_brand, p_type) WHERE rank <= 12""")
def top_answers(spark, sf_dir):
    return evaluate.top_answers(table(spark, sf_dir, "part"), ["p_brand"], "p_type")


@query("""WITH a AS (SELECT doc_id, lang AS source, source AS source_name, doc_id AS source_index, sha256("text") AS digest FROM documents),
b AS (SELECT source, CASE WHEN source_index % 3 = 0 THEN source_index + 1000000 ELSE source_index END AS label_index, digest FROM a WHERE source_name <> 'src1'),
d AS (SELECT a.source, a.source_index, b.label_index, 'taxonomy_direct_hash' AS join_method FROM a JOIN b ON a.source = b.source AND a.source_index = b.label_index AND a.digest = b.digest),
l AS (SELECT source, source_index, digest, row_number() OVER (PARTITION BY source, digest ORDER BY source_index) AS k FROM a WHERE (source, source_index) NOT IN (SELECT (source, source_index) FROM d)),
s AS (SELECT source, label_index, digest, row_number() OVER (PARTITION BY source, digest ORDER BY label_index) AS k FROM b WHERE (source, label_index) NOT IN (SELECT (source, label_index) FROM d))
SELECT * FROM d UNION ALL SELECT l.source, l.source_index, s.label_index, CASE WHEN s.label_index IS NULL THEN 'missing' ELSE 'taxonomy_digest_recovery' END FROM l LEFT JOIN s USING (source, digest, k)""")
def label_matching(spark, sf_dir):
    """Labels of all documents but those of one crawl, a third of them at another place."""
    docs = table(spark, sf_dir, "documents").select(F.col("lang").alias("source"), F.col("source").alias("name"), F.col("doc_id").alias("source_index"), F.sha2("text", 256).alias("digest"))
    rows = docs.drop("name")
    moved = F.when(F.col("source_index") % 3 == 0, F.col("source_index") + 1000000).otherwise(F.col("source_index"))
    labels = docs.filter("name <> 'src1'").select("source", moved.alias("source_index"), "digest")
    return merge.matched(rows, labels).select("source", "source_index", "label_index", "join_method")


@query("""SELECT vec_id, round(list_sum(list_transform(e, lambda v: abs(greatest(-3, least(3, (v - m) / s))))), 6) AS total FROM (
    SELECT vec_id, e, m, sqrt(list_sum(list_transform(e, lambda v: (v - m) * (v - m))) / len(e)) AS s FROM (SELECT vec_id, e, list_sum(e) / len(e) AS m FROM (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS e FROM embeddings)))""")
def scaled_series(spark, sf_dir):
    z = series.scaled(F.col("embedding"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.aggregate(z, F.lit(0.0), lambda s, v: s + F.abs(v)), 6).alias("total"))


def _load() -> None:
    """The other modules of queries register their own here."""
    from . import file_queries, more_queries, text_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
