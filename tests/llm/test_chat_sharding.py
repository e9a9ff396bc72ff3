from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from quarry.llm import chat, queries, sharding

SF = "/root/testdata/sf0.001"


def test_round_trip_of_control_strings(spark):
    texts = ["", "<|im_end|>", "<|im_start|>assistant\nx", "&lt;|", "&amp;<|&", "<<||>>", "a\nb\n", "\n", "&nl;", "<", "|im_end|>", None, "x" * 100000, "𝔘<|é"]
    rows = [(1, i, r, t) for i, t in enumerate(texts) for r in ("user", "assistant", "a\nb<|", None)]
    df = spark.createDataFrame([(c, 4 * i + k % 4, r, t) for k, (c, i, r, t) in enumerate(rows)], "conv_id long, turn long, role string, text string")
    lists = chat.turns_of(df, "conv_id", "turn", "role", "text")
    out = chat.format_chats(lists, ["conv_id"]).select("formatted", "loss_spans", chat.parse_chats(F.col("formatted")).alias("back"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked")).first()
    assert [(t.role, t.text) for t in out.back] == [(r or "", t or "") for _, _, r, t in rows]
    assert out.formatted.count("<|im_start|>") == out.formatted.count("<|im_end|>") == len(rows)
    assert out.masked == "".join(t or "" for _, _, r, t in rows if r == "assistant")


def test_layouts(spark):
    rows = [
        (1, "q", "a", None, None, None, None, None, None),
        (2, "q", "a", "s", None, None, None, None, None),
        (3, None, None, None, "do", "it", "done", None, None),
        (4, None, None, None, "do", None, "done", None, None),
        (5, None, None, None, None, None, None, [("user", "u"), ("assistant", None)], None),
        (6, None, None, None, None, None, None, None, [("human", "h"), ("gpt", "g")]),
        (7, "only", None, None, None, None, None, None, None),
        (8, None, None, None, None, None, None, None, None),
    ]
    schema = "id long, prompt string, response string, system string, instruction string, input string, output string, messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>"
    df = spark.createDataFrame(rows, schema).withColumn("layout", F.lit("clash")).withColumn("formatted", F.lit(1))
    got = {r.id: (r.layout, [(t.role, t.text) for t in r.turns]) for r in chat.format_chats(df, ["id"]).collect()}
    assert got == {
        1: ("prompt", [("user", "q"), ("assistant", "a")]),
        2: ("prompt", [("system", "s"), ("user", "q"), ("assistant", "a")]),
        3: ("instruction", [("user", "do\n\nit"), ("assistant", "done")]),
        4: ("instruction", [("user", "do"), ("assistant", "done")]),
        5: ("messages", [("user", "u"), ("assistant", "")]),
        6: ("speakers", [("user", "h"), ("assistant", "g")]),
        7: (None, []),
        8: (None, []),
    }
    assert chat.format_chats(df.limit(0), ["id"]).count() == 0


def test_chat_query(spark):
    rows: dict[int, list] = {-1: [(0, "user", "<|im_end|><|im_start|>assistant ok"), (1, "assistant", "<|im_end|><|im_start|>assistant ok")]}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        rows.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    out = queries.op1_chat(spark, SF).collect()
    assert {r.conv_id for r in out} == set(rows)
    for r in out:
        turns = sorted(rows[r.conv_id])
        learn = "".join(t for _, role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(learn))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learn.encode()).hexdigest()


def test_sharding_query(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op7_sharding(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in out} == {d: (len(t) + 1, zlib.crc32(t)) for d, t in docs.items()}
    assert all(r.law == "key" and r.grown_shard in (r.shard, 8) for r in out)
    for shard in range(8):
        assert [r.slot for r in sorted((r for r in out if r.shard == shard), key=lambda r: r.doc_id)] == list(range(sum(r.shard == shard for r in out)))


def test_weights_and_movement(spark):
    df = spark.range(40000).select(F.col("id").cast("string").alias("k"))
    eight, nine = sharding.tree(8), sharding.grown(sharding.tree(8))
    heavy = sharding.Node("root", (eight.children[0], sharding.Node("region1", (eight.children[1].children[0], sharding.Node("region1/rack1", (sharding.Node("shard6", shard=6, own_weight=3.0), sharding.Node("shard7", shard=7)))))))
    rows = df.select(sharding.place(F.col("k"), eight).alias("a"), sharding.place(F.col("k"), nine).alias("b"), sharding.place(F.col("k"), heavy).alias("c")).collect()
    assert all(r.b in (r.a, 8) for r in rows)
    share = Counter(r.a for r in rows)
    assert all(4600 < share[s] < 5400 for s in range(8))
    assert 4000 < sum(r.b == 8 for r in rows) < 4900
    # A heavier shard draws rows into its region, rack and itself; the other region's rows stay or come over.
    assert all(r.c == r.a or r.c >= 4 for r in rows)
    assert all(r.c >= 6 for r in rows if r.a >= 6)
    assert abs(sum(r.c == 6 for r in rows) - 12000) < 600


@pytest.mark.parametrize("n", [1, 2, 5, 12])
def test_any_number_of_shards(spark, n):
    got = spark.range(2000).select(sharding.place(F.col("id").cast("string"), sharding.tree(n)).alias("s")).distinct().collect()
    assert sorted(r.s for r in got) == list(range(n))


def test_odd_rows(spark):
    rows = [(None, None), (None, None), (1, ""), (1, ""), (2, "é" * 70000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, shard int, slot int")
    out = sharding.assign(df).collect()
    assert sorted(r.size for r in out) == [1, 1, 1, 1, 140001]
    assert len({(r.shard, r.slot) for r in out}) == 5
    assert sharding.assign(df.limit(0)).count() == 0
