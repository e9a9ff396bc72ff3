"""Queries that run conversion, rules, forms and places over the tables' own whole texts, with SQL of another make."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import merge
from .queries import PROMPTS, TASKS, pick, query, sql_list, table


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rule_sql() -> str:
    """Scores by rows of patterns: hits, best score by label, ranks; nothing of it is the Columns' way to decide."""
    patterns = [(i, label, score, p) for i, (label, score, _, own) in enumerate(rules.KEYWORDS) for p in own]
    keyword = ", ".join(f"({len(rules.PRIORS) + i}, {_text(label)}, {score}, {_text(p)})" for i, label, score, p in patterns)
    prior = ", ".join(f"({i}, {_text(s)}, {_text(t)}, {_text(label)}, {score}, {_text(fit) if fit else 'NULL'})" for i, (s, tasks, label, score, _, fit) in enumerate(rules.PRIORS) for t in tasks)
    tasks = [t.split("|") for t in TASKS]
    prompts = sql_list([p for p, _ in PROMPTS])
    return rf"""
WITH d AS (SELECT doc_id, {sql_list([s for s, _ in tasks] + ["any"])}[(doc_id % 5)::INT + 1] AS src, {sql_list([t for _, t in tasks] + [""])}[(doc_id % 5)::INT + 1] AS task,
    CASE WHEN doc_id % 7 = 0 THEN '1. ' || {prompts}[(doc_id % {len(PROMPTS)})::INT + 1] || chr(10) || '2) ' || {prompts}[((doc_id // 7) % {len(PROMPTS)})::INT + 1] ELSE {prompts}[(doc_id % {len(PROMPTS)})::INT + 1] END
        || chr(10) || coalesce("text", '') AS asked FROM documents),
k(ord, label, score, pattern) AS (VALUES {keyword}), p(ord, src, task, label, score, forced) AS (VALUES {prior}),
hits AS (SELECT doc_id, label, score FROM d JOIN k ON regexp_matches(lower(asked), '(?is)' || pattern) UNION ALL SELECT doc_id, label, score FROM d JOIN p USING (src, task)),
best AS (SELECT doc_id, label, max(score) AS score FROM hits GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS r, max(score) OVER (PARTITION BY doc_id) AS top FROM best),
seconds AS (SELECT doc_id, list(label ORDER BY r) AS second FROM ranked WHERE r > 1 AND score >= {rules.SECOND} AND round(top - score, 9) <= {rules.GAP} GROUP BY 1),
e AS (SELECT d.*, f.label AS closest, f.score, coalesce(s.second, []) AS second, (SELECT p.forced FROM p WHERE p.src = d.src AND p.task = d.task AND p.forced IS NOT NULL) AS forced,
    greatest(1, len(regexp_extract_all(asked, '(?:^|\n)\s*[0-9]+[.)]\s+'))) AS asks FROM d LEFT JOIN ranked f ON f.doc_id = d.doc_id AND f.r = 1 LEFT JOIN seconds s ON s.doc_id = d.doc_id),
t AS (SELECT *, asks > 1 AND len(second) > 0 AS compound FROM e),
u AS (SELECT *, CASE WHEN closest IS NULL THEN 'out_of_scope' ELSE coalesce(forced, CASE WHEN compound THEN 'mixed' ELSE 'exact' END) END AS fit FROM t)
SELECT doc_id, CASE WHEN closest IS NOT NULL AND fit <> 'out_of_scope' THEN closest END AS primary_label, closest AS closest_label, CASE WHEN closest IS NULL THEN '' ELSE array_to_string(second, ',') END AS secondary_labels, fit AS taxonomy_fit,
    coalesce(score, 0.0)::DOUBLE AS confidence, CASE WHEN closest IS NOT NULL AND fit = 'exact' AND score >= {rules.ACCEPT} AND NOT compound THEN 'auto_accept' ELSE 'review' END AS status
FROM u"""


@query(_rule_sql())
def document_rules(spark, sf_dir):
    """The rule decision of a prompt, or two numbered ones, and every whole text after it, with sources and tasks of which
    some have priors."""
    prompts = [p for p, _ in PROMPTS]
    one, other = pick(prompts, F.col("doc_id")), pick(prompts, F.floor(F.col("doc_id") / 7))
    asked = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("1. "), one, F.lit("\n2) "), other)).otherwise(one)
    tasks = F.split(pick([*TASKS, "any|"], F.col("doc_id")), "\\|")
    docs = table(spark, sf_dir, "documents").select("doc_id", tasks[0].alias("src"), tasks[1].alias("task"), F.concat(asked, F.lit("\n"), F.coalesce("text", F.lit(""))).alias("asked"))
    d = docs.select("doc_id", rules.decide(F.col("src"), F.col("task"), F.col("asked")).alias("d"))
    return d.select("doc_id", "d.primary_label", "d.closest_label", F.array_join("d.secondary_labels", ",").alias("secondary_labels"), "d.taxonomy_fit", "d.confidence", "d.status")


@query(r"""WITH t AS (SELECT conv_id, turn, role, coalesce("text", '') || CASE turn % 4 WHEN 0 THEN chr(10) || 'You MUST' || chr(9) || 'conclude with your' || chr(10) || 'Answer :' WHEN 1 THEN ' What does the plot say?' ELSE '' END AS prompt,
    lead(coalesce("text", '')) OVER w || CASE WHEN conv_id % 3 = 0 THEN ' As the Chart shows.' WHEN conv_id % 3 = 1 THEN ' As it is charted.' ELSE '' END AS reply FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST)),
f AS (SELECT conv_id, turn, regexp_matches(prompt, '(?is)must\s+(?:end|conclude).*?answer\s*:') OR regexp_matches(prompt, '(?i)final sentence must conclude with|correct answer (?:is|must be)') AS leak,
    regexp_matches(coalesce(reply, ''), '(?i)\b(?:graph|plot|chart|x-axis|y-axis|visual(?:ization)?)\b') AND NOT regexp_matches(prompt, '(?i)\b(?:graph|plot|chart|x-axis|y-axis|visual(?:ization)?)\b') AS visual FROM t)
SELECT conv_id, turn, concat_ws(',', CASE WHEN leak THEN 'answer_leakage' END, CASE WHEN visual THEN 'visual_grounding_mismatch' END) AS flags FROM f""")
def turn_issues(spark, sf_dir):
    """The issues of every turn and what follows it, whole texts, some with phrases that are an issue."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("said"))
    # Turns are numbered in blocks and joined with the number before: no conversation is gathered.
    own = merge.numbered(rows, "k", by=["conv_id"], order="turn")
    after = own.select("conv_id", (F.col("k") - 1).alias("k"), F.col("said").alias("next"))
    each = own.join(after, ["conv_id", "k"], "left")
    prompt = F.concat("said", F.when(F.col("turn") % 4 == 0, "\nYou MUST\tconclude with your\nAnswer :").when(F.col("turn") % 4 == 1, " What does the plot say?").otherwise(""))
    reply = F.concat(F.col("next"), F.when(F.col("conv_id") % 3 == 0, " As the Chart shows.").when(F.col("conv_id") % 3 == 1, " As it is charted.").otherwise(""))
    return each.select("conv_id", "turn", F.array_join(text.issues(prompt, F.coalesce(reply, F.lit(""))), ",").alias("flags"))


# The forms of values made of each line's own columns, and what each is by its making.
@query(r"""WITH l AS (SELECT l_orderkey, l_linenumber, l_returnflag AS flag, printf('%.2f', l_quantity) AS q, printf('%.2f', l_discount) AS d, printf('%.2f', l_tax) AS t, strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem),
s AS (SELECT CASE l_linenumber WHEN 1 THEN 'scalar' WHEN 2 THEN 'time_series' WHEN 3 THEN 'text' WHEN 4 THEN CASE WHEN flag IN ('A', 'B', 'C', 'D') THEN 'choice_label' ELSE 'tagged_answer' END
    WHEN 5 THEN 'multiline_text' WHEN 6 THEN 'reasoning_with_answer' ELSE 'tagged_time_series' END AS form FROM l)
SELECT form, count(*) AS n FROM s GROUP BY 1""")
def value_forms(spark, sf_dir):
    """The form of answers that hold the lines' own numbers, flags and days."""
    number = lambda c: F.format_string("%.2f", c)
    q, d, t, flag, day = number("l_quantity"), number("l_discount"), number("l_tax"), F.col("l_returnflag"), F.date_format("l_shipdate", "yyyy-MM-dd")
    k = F.col("l_linenumber")
    said = (
        F.when(k == 1, q)
        .when(k == 2, F.concat(F.lit("["), q, F.lit(", "), d, F.lit(" ,-"), t, F.lit(", 1e5]")))
        .when(k == 3, F.concat(F.lit("shipped on "), day, F.lit(" for "), q))
        .when(k == 4, F.concat(F.lit("<answer> ("), flag, F.lit(") </answer>")))
        .when(k == 5, F.concat(day, F.lit("\n"), flag, F.lit(" of "), q))
        .when(k == 6, F.concat(F.lit("<think>"), day, F.lit("</think>\n<answer>"), q, F.lit("</answer>")))
        .otherwise(F.concat(F.lit("<answer><ts><ts/> "), q, F.lit("</answer>")))
    )
    return table(spark, sf_dir, "lineitem").groupBy(text.structure(said).alias("form")).agg(F.count("*").alias("n"))


@query(r"""WITH t AS (SELECT conv_id, turn, trim(regexp_replace(coalesce("text", '') || CASE turn % 5 WHEN 0 THEN chr(10) || 'Final answer: ' || chr(65 + (conv_id % 7)::INT) || '.' WHEN 1 THEN ' <answer> ' || chr(97 + (conv_id % 7)::INT) || ' </answer>'
    WHEN 2 THEN ' {"answer": "' || chr(65 + (conv_id % 7)::INT) || '"}' WHEN 3 THEN ' no letter' ELSE '' END, '^\s+|\s+$', '', 'g')) AS said FROM conversations)
SELECT conv_id, turn, upper(coalesce(nullif(regexp_extract(said, '(?i)<answer>\s*([A-G])\s*</answer>', 1), ''), nullif(regexp_extract(said, '(?i)["'']?answer["'']?\s*[:=]\s*["'']?([A-G])', 1), ''),
    nullif(regexp_extract(said, '(?i)(?:^|\n)\s*(?:final\s+answer\s*[:：]?\s*)?([A-G])[.)]', 1), ''), nullif(regexp_extract(said, '(?i)^\s*([A-G])\s*(?:\r?\n|$)', 1), ''))) AS letter FROM t""")
def turn_letters(spark, sf_dir):
    """The letter that every turn's whole text names, with an answer after most of them."""
    letter = lambda first: F.char(F.lit(first) + F.col("conv_id") % 7)
    k = F.col("turn") % 5
    end = F.when(k == 0, F.concat(F.lit("\nFinal answer: "), letter(65), F.lit("."))).when(k == 1, F.concat(F.lit(" <answer> "), letter(97), F.lit(" </answer>"))).when(k == 2, F.concat(F.lit(' {"answer": "'), letter(65), F.lit('"}'))).when(k == 3, " no letter").otherwise("")
    rows = table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", text.choice(F.concat(F.coalesce("text", F.lit("")), end)).alias("letter"))
