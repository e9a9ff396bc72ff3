"""The merge driver, labelling and translation."""

from __future__ import annotations

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F
from quarry.functions import records, rules, text
from quarry.operators import calls, prompts
from quarry.plans import labelling, merging


def line(n, **more):
    return json.dumps({"record_id": f"r{n}", "line_number": n, "input_hash": "h", "template_id": "t", "quality": "good", "difficulty": "easy", "reason": "x", "model": "m", "prompt_version": "p"} | more)


def test_quality_labels(spark):
    def load(*lines):
        labels, stats = merging.quality_labels(spark.createDataFrame([(x,) for x in lines], "raw string"), "m", "p")
        return sorted(r.line_number for r in labels.collect()), stats.first().asDict()

    assert load(line(1), line(2), line(2), line(2, quality="weak", model="other")) == ([1, 2], {"file_rows": 4, "ignored_other_model_or_prompt": 1, "usable_rows": 2, "duplicate_identical": 1})
    assert load()[0] == []
    for wrong, what in (([line(1), line(1, quality="weak")], "conflicting"), ([line(1, quality="fine")], "unknown level"), ([line(1, reason=" ")], "no reason"), (["{broken"], "no JSON"), ([line(None)], "no line number")):
        with pytest.raises(Exception, match=what):
            load(*wrong)


def test_taxonomy_rows(spark):
    p = spark.createDataFrame([("a", 1), ("b", 2)], "sample_id string, x int")
    f = spark.createDataFrame([("a", ("AD",)), ("b", ("PR",))], "sample_id string, final struct<primary_label:string>")
    assert sorted((r.sample_id, r.x, r.final.primary_label) for r in merging.taxonomy_rows(p, f).collect()) == [("a", 1, "AD"), ("b", 2, "PR")]
    for a, b in ((p, f.limit(1)), (p.limit(1), f), (p, f.union(f)), (p.union(p), f)):
        with pytest.raises(Exception, match="final labels|a sample twice"):
            merging.taxonomy_rows(a, b).collect()


def test_manifests_agree():
    taxonomy = {label: "x" for label in rules.LABELS}
    one = {"taxonomy": taxonomy, "sources": [{"name": "a", "path": "/a"}]}
    assert merging.consistent([one, one]) == (taxonomy, {"a": "/a"})
    for wrong in ([], [{"taxonomy": {}}], [one, {"taxonomy": taxonomy | {"AD": "y"}}], [one, {"taxonomy": taxonomy, "sources": [{"name": "a", "path": "/b"}]}]):
        with pytest.raises(ValueError):
            merging.consistent(wrong)


def inputs(spark):
    rows = [("s", i, f"d{i}", f"What is {i} {'x' * i}?", "A") for i in range(5)]
    samples = spark.createDataFrame(rows, "source string, source_index long, digest string, input string, output string")
    samples = samples.withColumn("audit", F.when(F.col("source_index") == 4, F.struct(F.lit("CA").alias("primary_label"), F.lit("checked").alias("status"), F.lit("sub").alias("reasoning_subtype"))))
    decision = "struct<primary_label:string,secondary_labels:array<string>,taxonomy_fit:string,confidence:double,status:string>"
    taxonomy = spark.createDataFrame(
        [("s", 0, "d0", "i0", "c0", ("PR", [], "exact", 0.9, "auto_accept"), ("AD", ["PR"], "exact", 1.0, "accepted")), ("s", 7, "d1", "i1", "c1", ("PR", ["CA"], "exact", 0.9, "review"), (None, [], None, None, "human_review")), ("s", 2, "d2", "i2", "c2", (None, [], "out_of_scope", 0.0, "review"), (None, [], None, None, "excluded")), ("s", 9, "d3", "i3", "c3", ("PR", [], "exact", 0.8, "review"), ("NR", [], "exact", 0.7, "accepted"))],
        f"source string, source_index long, digest string, sample_id string, cluster_id string, provisional {decision}, final {decision}",
    )
    t = samples.select("source", (F.col("source_index") + 1).alias("line_number"), text.template(F.col("input"), F.col("output")).alias("t"))
    quality = t.select("source", "line_number", "t.template_id", "t.input_hash", F.lit("good").alias("quality"), F.lit("hard").alias("difficulty"), F.lit("r").alias("reason"), F.lit("m").alias("model"), F.lit("p").alias("prompt_version"))
    return samples, taxonomy, quality


def test_annotated(spark, tmp_path):
    samples, taxonomy, quality = inputs(spark)
    out = merging.annotated(samples, taxonomy, quality)
    got = {r.source_index: r.annotation for r in out.collect()}
    told = {i: (a.ability_label, a.ability_label_source, a.ability_join_method, a.ability_status, a.taxonomy_sample_id, a.ability_secondary_labels) for i, a in got.items()}
    assert told == {
        0: ("AD", "final", "taxonomy_direct_hash", "accepted", "i0", ["PR"]),
        1: ("PR", "provisional", "taxonomy_digest_recovery", "human_review", "i1", ["CA"]),
        2: (None, "unmapped", "taxonomy_direct_hash", "out_of_scope", "i2", []),
        3: ("NR", "final", "taxonomy_digest_recovery", "accepted", "i3", []),
        4: ("CA", "audit_fallback", "audit_fallback", "checked", None, []),
    }
    assert (got[4].annotation_id, got[4].reasoning_subtype, got[0].ability_name is not None, got[2].ability_bucket, got[1].difficulty) == ("s:5", "sub", True, "UNMAPPED", "hard")
    rows = merging.write_annotated(out, ["input", "output"], str(tmp_path / "o"))
    assert spark.read.json(str(tmp_path / "o/annotated")).count() == spark.read.json(str(tmp_path / "o/annotations")).count() == 5
    with pytest.raises(ValueError, match="collision"):
        merging.write_annotated(out, ["input", "line_number"], str(tmp_path / "o2"))
    summary = merging.write_reports(rows, str(tmp_path / "rep"))
    assert summary["sources"] == [{"source": "s", "total_rows": 5, "quality_labeled_rows": 5, "ability_15d_rows": 4, "ability_unmapped_rows": 1}]
    assert summary["marginals"]["ability_bucket"] == {"AD": 1, "CA": 1, "NR": 1, "PR": 1, "UNMAPPED": 1}
    assert "# Abilities" in (tmp_path / "rep/report.md").read_text()
    assert json.loads((tmp_path / "rep/summary.json").read_text())["tables"]
    cells = spark.read.parquet(str(tmp_path / "rep/cells"))
    assert merging.write_summaries(cells, str(tmp_path / "sum"))["datasets"] == ["s"]
    with pytest.raises(ValueError, match="unknown dataset"):
        merging.write_summaries(cells, str(tmp_path / "sum2"), ["t"])
    both = cells.union(cells.withColumn("source", F.lit("s_"))).union(cells.withColumn("source", F.lit("_s_.")))
    with pytest.raises(ValueError, match="folder name"):
        merging.write_summaries(both, str(tmp_path / "sum3"))


def test_what_must_hold(spark):
    samples, taxonomy, quality = inputs(spark)
    last = F.col("line_number") == 5
    for q, what in ((quality.filter(~last), "unmatched row"), (quality.union(quality.filter(last).withColumn("line_number", F.lit(9).cast("long"))), "unmatched row"), (quality.withColumn("input_hash", F.lit("z")), "another template")):
        with pytest.raises(Exception, match=what):
            merging.annotated(samples, taxonomy, q).collect()
    loose = merging.annotated(samples, taxonomy, quality.filter(~last), merging.Strict(quality=False)).collect()
    assert {r.source_index: r.annotation.quality for r in loose}[4] is None
    with pytest.raises(Exception, match="no ability label"):
        merging.annotated(samples.drop("audit"), taxonomy, quality).collect()
    lax = merging.annotated(samples.drop("audit"), taxonomy, quality, merging.Strict(ability=False)).collect()
    assert {r.source_index: r.annotation.ability_join_method for r in lax}[4] == "missing"
    with pytest.raises(Exception, match="unknown ability label"):
        merging.annotated(samples, taxonomy.withColumn("final", F.col("final").withField("primary_label", F.lit("XX"))), quality).collect()


@pytest.mark.parametrize("strict", [True, False])
def test_texts_are_dealt_once(spark, strict):
    """Of the merge's exchanges only one carries the samples' texts, and only labelled rows' templates are made."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.debug.maxToStringFields": "1000"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        samples, taxonomy, _ = inputs(spark)
        quality = spark.createDataFrame([], "source string, line_number long, template_id string, input_hash string, quality string, difficulty string, reason string, model string, prompt_version string")
        out = merging.annotated(samples, taxonomy, quality, merging.Strict(strict, strict))
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = out._jdf.queryExecution().explainString(mode)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    dealt = re.findall(r"\) Exchange[^\n]*\nInput \[\d+\]: \[([^\n]*)\]", plan)
    assert len(dealt) > 1 and len([x for x in dealt if re.search(r"\binput#", x)]) == 1
    assert not [x for x in dealt if "_t#" in x]


def test_guarded_patterns(spark):
    """Patterns that run only where their signs are: as if they ran on every text."""
    r = random.Random(5)
    bits = ["1", "-2.5", "+.5", "3.", "1e5", "\u0663", "a", "é", " ", "  ", "\n", "\t", "\x1c", "\x1f", "\u00a0", "\u0085", "\u2003", ",", ";", "|", "[", "]", "<ts>", "<TS/>", "<t\u017f>", "<ts />", "<", "1,2,3,4", "[1, 2, 3, 4]", ", 5", "word", ".", "_", "-", "+"]
    df = spark.createDataFrame([("".join(r.choice(bits) for _ in range(r.randint(0, 30))),) for _ in range(3000)] + [(None,), ("",)], "x string")
    x = F.col("x")
    spaced = F.translate(x, "\x1c\x1d\x1e\x1f", "    ")
    single = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    plain = F.regexp_replace(spaced, text.SERIES_TOKEN, "<ts>")
    for pattern in (text.BRACKETED, text.UNBRACKETED.replace(r"(?=[-+.\d])", ""), text.NESTED) * 3:
        plain = F.regexp_replace(plain, pattern, "<ts>")
    masked = F.regexp_replace(x, text.SCALAR.replace(r"(?=[-+.\d])", ""), "<num>")
    got = df.select(text.fold_series(x).alias("f"), single(plain).alias("wf"), text.compact(x).alias("c"), single(spaced).alias("wc"), text.mask_scalars(x).alias("m"), masked.alias("wm"))
    assert got.filter("NOT (f <=> wf AND c <=> wc AND m <=> wm)").count() == 0
    assert got.filter("contains(f, '<ts>')").count() > 1000


def test_clean_copies(spark):
    samples, taxonomy, quality = inputs(spark)
    samples = samples.drop("audit").withColumn("canonical", F.col("input"))
    raw = samples.select("source", (F.col("source_index") * 2).alias("source_index"), F.lit(True).alias("valid"), "canonical").union(spark.createDataFrame([("s", 1, False, "")], "source string, source_index long, valid boolean, canonical string"))
    labels = spark.range(9).crossJoin(taxonomy.limit(1)).withColumn("source_index", F.col("id")).drop("id")
    got = {r.source_index: r.annotation.ability_join_method for r in merging.annotated(samples, labels, quality, raw=raw).collect()}
    assert got == dict.fromkeys(range(5), "taxonomy_clean_sequence")
    with pytest.raises(Exception, match="differ|no label"):
        merging.annotated(samples, labels, quality, raw=raw.withColumn("canonical", F.lit("z"))).collect()


def test_dry_run(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    got = merging.missing_inputs(spark, {"s": {"input": str(tmp_path / "a"), "audit": None, "quality": str(tmp_path / "b")}})
    assert got[0]["exists"] == {"input": True, "audit": True, "quality": False}


def test_labelling_resumes(spark, tmp_path):
    rows = [(i, None, f"What is {i}?", "A", None) for i in range(1, 8)] + [(8, "own", "Why?", "because", None), (9, None, None, None, "JSONDecodeError")]
    df = spark.createDataFrame(rows, "line_number long, record_id string, question string, answer string, reason string")
    to = labelling.Labels(str(tmp_path / "labels"))
    calls_dir = tmp_path / "calls"
    calls_dir.mkdir()
    folder = str(calls_dir)

    def client(payloads):
        import os
        import uuid

        for p in payloads:
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(p)
        return [RuntimeError("busy") if "Why?" in p and len(os.listdir(folder)) < 100 else calls.offline([p])[0] for p in payloads]

    plan = labelling.label(df, client, to, "m", dry_run=True)
    assert (plan["input_rows"], plan["invalid_rows"], plan["pending_rows"], plan["unique_templates"], plan["api_requests_needed"], plan["template_compression_ratio"]) == (9, 1, 8, 2, 2, 4.0)
    first = labelling.label(df, client, to, "m", retries=0)
    assert (first["api_requests"], first["failed_templates"], first["labels_written"]) == (2, 1, 7)
    assert len(list(calls_dir.iterdir())) == 2
    assert sorted(r.error for r in spark.read.parquet(to.errors).collect()) == ["JSONDecodeError", "busy"]
    again = labelling.label(df, calls.offline, to, "m")
    assert (again["resume_skipped_rows"], again["pending_rows"], again["api_requests"], again["labels_written"]) == (7, 1, 1, 1)
    assert {r.record_id for r in spark.read.parquet(to.rows).collect()} == {"own", *(f"line:{i}" for i in range(1, 8))}
    assert labelling.label(df, calls.offline, to, "m", dry_run=True)["pending_rows"] == 0
    assert labelling.label(df, calls.offline, labelling.Labels(str(tmp_path / "other")), "m", limit=3, dry_run=True)["pending_rows"] == 3
    sent = json.loads(next(iter(calls_dir.iterdir())).read_text())
    assert sent["response_format"] and json.loads(sent["messages"][1]["content"])["answer_structure"]


def test_prompts(spark):
    said = prompts.taxonomy_prompt()
    assert all(f"- {label} (" in said for label in rules.LABELS)
    row = spark.range(1).select(prompts.taxonomy_payload("m", F.lit('a "quoted"\nline é'), effort="high").alias("p")).first().p
    got = json.loads(row)
    assert got["messages"][1] == {"role": "user", "content": 'a "quoted"\nline é'}
    assert got["thinking"] == {"type": "enabled"} and "temperature" not in got


def test_translation(spark, tmp_path):
    df = spark.createDataFrame([(1, {"b": "two", "a": "one"}), (2, {"a": "one", "b": "two", "c": " "}), (3, {"a": " "}), (4, {"a": "bad"}), (5, None)], "i int, texts map<string,string>")

    def client(payloads):
        out = []
        for p in map(json.loads, payloads):
            if "response_format" in p:
                out.append(labelling.BadRequest("no such field"))
                continue
            assert p["max_tokens"] == 1024
            texts = json.loads(p["messages"][1]["content"])
            out.append("sorry" if texts.get("a") == "bad" else "```json\n" + json.dumps({k: v.upper() for k, v in texts.items() if k != "b"}) + "\n```")
        return out

    cache = str(tmp_path / "cache")
    got = {r.i: (r.translations, r.cached) for r in labelling.translated(df, F.col("texts"), client, "m", cache, retries=0).collect()}
    assert got == {1: ({"a": "ONE", "b": ""}, False), 2: ({"a": "ONE", "b": ""}, False), 3: (None, None), 4: (None, None), 5: (None, None)}
    again = {r.i: r.cached for r in labelling.translated(df, F.col("texts"), lambda p: [RuntimeError("down")] * len(p), "m", cache, retries=0).collect()}
    assert again == {1: True, 2: True, 3: None, 4: None, 5: None}
    key = spark.range(1).select(prompts.translation_key("m", F.create_map(F.lit("b"), F.lit("é"), F.lit("a"), F.lit("x"))).alias("k")).first().k
    assert key == hashlib.sha256('m\n{"a":"x","b":"é"}'.encode()).hexdigest()


def test_merge_resumes(spark, tmp_path):
    samples, taxonomy, quality = inputs(spark)
    (tmp_path / "in").write_text("1")
    make = lambda: merging.merge_all(samples, taxonomy, quality, str(tmp_path / "o"), ["input", "output"], [str(tmp_path / "in")])
    assert make() == make()
    assert [p.name for p in (tmp_path / "o").iterdir() if p.name.startswith("merge-")] == ["merge-1"]
    (tmp_path / "in").write_text("12")
    assert make()["sources"][0]["total_rows"] == 5
    assert sorted(p.name for p in (tmp_path / "o").iterdir() if p.name.startswith("merge-")) == ["merge-1", "merge-2"]


def test_raw_rows(spark):
    lines = [{"question": "q", "answer": "a", "context": "c"}, {"input": "i", "output": "o", "context": "c", "id": 7}, {"question": " ", "answer": "a"}, {"query": "q"}, "x"]
    raw = spark.createDataFrame([(k, json.dumps(x)) for k, x in enumerate(lines, 1)] + [(9, "{broken")], "line_number long, raw string")
    got = {r.line_number: (r.record_id, r.question, r.answer, r.reason) for r in labelling.rows_of(raw).collect()}
    assert got[1] == (None, "Context:\nc\n\nQuestion:\nq", "a", None)
    assert got[2] == ("7", "i", "o", None)
    assert [got[k][3] for k in (3, 4, 5, 9)] == ["missing question", "missing answer", "not an object", "JSONDecodeError"]


def test_details_of_replies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, payload string")

    def client(payloads):
        return [{"content": p, "reasoning": "long" if p == "a" else "", "usage": {"prompt": 2, "completion": 1}} if p != "c" else p for p in payloads]

    out = calls.answered(df, client, "k", "payload", concurrency=1, details=True)
    assert sorted((r.k, r.reply, r.reasoned, r.usage is None) for r in out.collect()) == [(1, "a", True, False), (2, "b", False, False), (3, "c", False, True)]
    assert {r.kind: r.tokens for r in calls.token_usage(out).collect()} == {"prompt": 4, "completion": 2}


def test_records(spark):
    raw = spark.createDataFrame([('{"b": 1.0, "a": [1e5, "é"]}',), ("{broken",), (None,), ('{"a": NaN}',)], "raw string")
    got = raw.select(records.canonical(F.col("raw")).alias("c"), records.canonical(F.col("raw"), True).alias("f"), records.compact(F.col("raw")).alias("k"), records.record_hash(F.col("raw")).alias("h")).collect()
    assert [r.c for r in got] == ['{"a":[100000.0,"é"],"b":1.0}', None, None, '{"a":NaN}']
    assert [r.f for r in got][3] is None and got[0].k == '{"b":1.0,"a":[100000.0,"é"]}'
    assert got[0].h == hashlib.sha256(got[0].k.encode()).hexdigest() and got[1].h is None
    letters = spark.range(1).select(*(text.choice(F.lit(x)).alias(f"c{i}") for i, x in enumerate(("{'answer': \"B\"}", '{"answer": "C"}', "{'answer': 'd'}")))).first()
    assert list(letters) == ["B", "C", "D"]
