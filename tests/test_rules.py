"""The literal prefilter changes no decision; prompts of many copies are decided once."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from quarry.functions import rules

ODD = ["Noiſe level?", "Kind of outlier", "TRENDı", "trenıd", "noısy", "PERİODIC", "seaſonal", "what  might", None, "", "signal\nto\nnoise", "snr,", "xsnr", "if a\nthen b", "predict next  values", "predict the next é3 points"]


def test_needed_literals():
    assert rules.needed(r"backtest(?:ing|ed)?") == {"backtest"}
    assert rules.needed(r"maximum drawdown|best return") == {"maximum drawdown", "best return"}
    assert rules.needed(r"\w+\s*[ab]") is None
    assert rules.needed(r"(?:a|\d) b") == {" b"}
    for _, _, _, patterns in rules.KEYWORDS:
        for p in patterns:
            assert rules.needed(p)


def test_what_is_found_holds_a_literal():
    """Strings made of the patterns' own words: wherever a pattern is found, a needed literal is there after folding."""
    words = sorted({w for _, _, _, own in rules.KEYWORDS for p in own for w in re.findall(r"[a-z]{2,}", p)})
    texts = [" ".join(words[i : i + 6]) for i in range(len(words))] + [" ".join(words[i::17]) for i in range(17)]
    for _, _, _, own in rules.KEYWORDS:
        for p in own:
            for x in texts:
                if re.search(p, x, re.I | re.S):
                    assert any(n in x for n in rules.needed(p)), (p, x)


def test_the_prefilter_changes_nothing(spark):
    words = sorted({w for _, _, _, own in rules.KEYWORDS for p in own for w in re.findall(r"[a-z]{2,}", p)})
    texts = ODD + [" ".join(words[i : i + 9]).upper() if i % 2 else " ".join(words[i::13]) for i in range(60)]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    low = F.lower(F.coalesce("t", F.lit("")))
    folded = F.translate(low, rules.FOLDED, rules.PLAIN)
    cols = [(rules.has_any(low, own) == rules.has_any(low, own, folded)).alias(label) for label, _, _, own in rules.KEYWORDS]
    for r in df.select("t", *cols).collect():
        assert all(list(r)[1:]), r


def test_copies_are_decided_once(spark):
    rows = [(i, ("any", "time_mqa", None)[i % 3], ("", "imputation", None)[i % 3], ("Locate the anomalous segment.", None, "1. trend?\n2. which noise level?")[i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, source string, task string, prompt string").withColumns({"_s": F.lit(1)}).drop("_s")
    a = df.withColumn("provisional", rules.decide(F.col("source"), F.col("task"), F.col("prompt")))
    b = rules.decided(df, F.col("source"), F.col("task"), F.col("prompt"))
    assert b.columns == a.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
