from __future__ import annotations

from pyspark.sql import functions as F
from quarry.operators import resolve, views
from quarry.sources import results


def test_choices(spark):
    df = spark.createDataFrame([(["x", "B) y", "c) z"], {"B": "2", "A": "1"}), (None, None)], "a array<string>, m map<string,string>")
    assert [tuple(r) for r in df.select(views.choices(F.col("a")), views.named_choices(F.col("m"))).collect()] == [("A. x\nB) y\nc) z", "A. 1\nB. 2"), ("", "")]


def test_views(spark):
    schema = "context struct<history_events:array<string>,history_times:array<string>,future_events:array<string>,future_times:array<string>>, multiple_choice_question struct<question:string,choices:array<string>,answer:string>, series array<struct<name:string,history:array<double>,future:array<double>>>"
    row = (([f"e{i}" for i in range(12)], [f"t{i}" for i in range(12)], ["f"], ["u", "v"]), ("why?", ["x", "y"], "A"), [("s", [1.0], [2.0]), ("none", None, None), ("r", [3.0], None)])
    r = views.abductive_view(spark.createDataFrame([row], schema)).first()
    assert r.input.startswith("Past Events (History):\n- t2: e2\n")
    assert r.input.endswith("Future Events:\n- u: f\n\nQuestion: why?")
    assert (r.series_names, r.timeseries, r.output) == (["s", "r"], [[1.0, 2.0], [3.0]], "A")
    r = views.standard_view(spark.createDataFrame([("q", "B", ["x"])], "question string, answer string, choices array<string>"), "perception").first()
    assert (r.input, r.output, r.category, r.timeseries) == ("q", "B", "perception", [])


def test_identity(spark):
    def told(path, model=None):
        return spark.range(1).select(results.identity(F.lit(path), "/r", model).alias("i")).first().i

    assert told("/r/m1/perception/generated_answer.json") == ("perception", "m1", "m1")
    assert told("/r/event_forecast_org/model-8b/x.json") == ("event_prediction", "org/model-8b", ".")
    assert told("/r/perception/x.json") == ("perception", "r", ".")
    assert told("/r/other/x.json") is None
    assert told("/r/a/causal_reasoning_m/x.json", "given") == ("causal_reasoning", "given", "a")
    assert told("file:///r/perception/causal_reasoning/x.json") == ("causal_reasoning", "perception", "perception")
    assert told("/elsewhere/m/perception/x.json") == ("perception", "m", "/elsewhere/m")


def test_small_views(spark):
    df = spark.range(100)
    assert views.random_member(df, ["id"], 3).collect() == views.random_member(df.repartition(7), ["id"], 3).collect()
    names = spark.createDataFrame([("Alpha", "x"), ("beta", "y")], "name string, family string")
    assert [r.name for r in views.catalogue(names, "x", "ALP").collect()] == ["Alpha"]
    assert views.preview(spark.createDataFrame([("x" * 300, [1, 2])], "a string, b array<int>")).first() == ("x" * 200, "[1,2]")
    vote = spark.range(1).select(resolve.parsed_vote(F.lit('{"primary_label": null, "taxonomy_fit": "closest"}')).alias("v")).first().v
    assert (vote.primary_label, vote.taxonomy_fit, vote.confidence) == (None, "closest", 0.0)
