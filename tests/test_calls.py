"""Calls in flight: a window, a clock for each item, and a journal that keeps replies over failures."""

from __future__ import annotations

import asyncio
import threading
import time

import pytest
from pyspark.sql import functions as F
from quarry.operators import calls


def test_a_window_of_calls_takes_its_share_of_the_time():
    now = [0, 0]

    async def slow(payload):
        now[0] += 1
        now[1] = max(now)
        await asyncio.sleep(0.05)
        now[0] -= 1
        return payload.upper()

    begun = time.time()
    got = dict((i[0], r) for i, r in calls.in_flight(((k, f"p{k}") for k in range(64)), slow, 8, 0, 0.01, 0.01, None))
    took = time.time() - begun
    assert got == {k: f"P{k}" for k in range(64)}
    assert now[1] == 8 and took < 64 * 0.05 / 4  # an eighth, with room for a busy machine


def test_waiting_items_leave_their_place():
    tried: dict[str, list[float]] = {}
    begun = time.time()

    def client(payload):
        tried.setdefault(payload, []).append(time.time() - begun)
        if payload == "bad" or (payload == "late" and len(tried[payload]) < 3):
            raise OSError("down")
        return payload

    order = [(i[0], r) for i, r in calls.in_flight([("bad", "bad"), ("late", "late"), *((str(k), str(k)) for k in range(20))], client, 1, 2, 0.2, 0.3, 5)]
    assert [k for k, _ in order[:20]] == [str(k) for k in range(20)]  # others don't wait for them
    assert str(dict(order)["bad"]) == "down" and dict(order)["late"] == "late"
    assert len(tried["bad"]) == 3 and tried["bad"][1] - tried["bad"][0] >= 0.2 and tried["bad"][2] - tried["bad"][1] >= 0.3


def test_a_call_that_hangs_is_an_error():
    async def hangs(payload):
        await asyncio.sleep(60)

    ((_, reply),) = calls.in_flight([("k", "p")], hangs, 2, 0, 0.1, 0.1, 0.05)
    assert isinstance(reply, TimeoutError)


def frame(spark, n=40):
    return spark.range(n).select("id", F.concat(F.lit("p"), "id").alias("payload"))


def test_a_killed_job_asks_nothing_twice(spark, tmp_path):
    journal, asked, flag = str(tmp_path / "journal"), str(tmp_path / "asked"), str(tmp_path / "alive")

    def client(payload):
        import os

        with open(asked, "a") as f:
            f.write(payload + "\n")
        if payload == "p33" and not os.path.exists(flag):
            time.sleep(0.5)
            os._exit(1)  # the worker dies
        return {"content": payload.upper(), "usage": {"tokens": 2}, "reasoning": "r"}

    options = {"partitions": 2, "width": 1, "journal": journal, "details": True}
    with pytest.raises(Exception):  # noqa: B017, PT011
        calls.asked(frame(spark), client, "id", "payload", **options).collect()
    open(flag, "w").close()
    got = {r.id: (r.reply, r.error, r.reasoned, r.usage) for r in calls.asked(frame(spark), client, "id", "payload", **options).collect()}
    assert got == {k: (f"P{k}", None, True, '{"tokens": 2}') for k in range(40)}
    said = open(asked).read().split()
    assert sorted(set(said)) == sorted(f"p{k}" for k in range(40))
    assert [p for p in set(said) if said.count(p) > 1] == ["p33"]  # only the call whose reply never came
    assert calls.asked(frame(spark), client, "id", "payload", **options).count() == 40
    assert len(open(asked).read().split()) == 41


def test_errors_are_asked_again(spark, tmp_path):
    def client(payload):
        if payload == "p1":
            raise OSError("down")
        return payload

    lock = threading.Lock()
    assert lock
    options = {"partitions": 2, "retries": 0, "journal": str(tmp_path / "j")}
    first = {r.id: (r.reply, r.error) for r in calls.asked(frame(spark, 4), client, "id", "payload", **options).collect()}
    assert first[1] == (None, "down") and first[0] == ("p0", None)
    again = {r.id: (r.reply, r.error) for r in calls.asked(frame(spark, 4), lambda p: p + "!", "id", "payload", **options).collect()}
    assert again == {0: ("p0", None), 1: ("p1!", None), 2: ("p2", None), 3: ("p3", None)}
