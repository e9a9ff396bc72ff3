"""Repairs against a plain search over all edits, blocks against whole conversations, and the query against SQL."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from quarry.llm import repair

SF = "/root/testdata/sf0.001"
GRAMMAR = re.compile("(s?(ua)+)?")


def brute(codes, begin=repair.START, ends=repair.ACCEPTED):
    """The cheapest edits by uniform cost over (cost, audit) of single paths, least audit first."""
    heap, seen = [(0, "", 0, begin, "")], set()
    while heap:
        cost, audit, i, q, plan = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        if i == len(codes) and q in ends:
            return cost, audit, plan
        seen.add((i, q))
        for c in "ua":
            if c in repair.NEXT[q]:
                heapq.heappush(heap, (cost + 2, audit + "I", i, repair.NEXT[q][c], plan + c))
        if i < len(codes):
            initial, fault = divmod(repair.CODES.index(codes[i]), 3)
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q, plan + "D"))
            if fault < 2:
                if initial < 3 and "sua"[initial] in repair.NEXT[q]:
                    heapq.heappush(heap, (cost + fault, audit + "K", i + 1, repair.NEXT[q]["sua"[initial]], plan + "K"))
                for c in "ua":
                    if c in repair.NEXT[q]:
                        heapq.heappush(heap, (cost + 2 + fault, audit + "R", i + 1, repair.NEXT[q][c], plan + c.upper()))
    return None


def exhaustive(codes):
    """The least (cost, audit) over all edit strings of a bounded length, without any search."""
    best = None

    def go(i, roles, cost, audit):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(codes) and GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best):
            best = cost, audit
        if audit.count("I") < 3:
            for c in "ua":
                go(i, roles + c, cost + 2, audit + "I")
        if i < len(codes):
            initial, fault = divmod(repair.CODES.index(codes[i]), 3)
            go(i + 1, roles, cost + 3, audit + "D")
            if fault < 2:
                go(i + 1, roles + "sua?"[initial], cost + fault, audit + "K")
                for c in "ua":
                    go(i + 1, roles + c, cost + 2 + fault, audit + "R")

    go(0, "", 0, "")
    return best


def test_all_short_conversations():
    rng = random.Random(5)
    cases = [""] + [a for a in repair.CODES] + [a + b for a in repair.CODES for b in repair.CODES]
    cases += ["".join(rng.choice(repair.CODES) for _ in range(3)) for _ in range(150)]
    for codes in cases:
        if codes:
            assert repair.repair(codes)[:2] == exhaustive(codes) == brute(codes)[:2], codes


def test_long_conversations_from_any_state():
    rng = random.Random(6)
    for _ in range(150):
        codes = "".join(rng.choice("DDDGGGADEFGHJL") for _ in range(rng.randrange(1, 30)))
        for q in range(4):
            for ends in (repair.ACCEPTED, (0,), (1,), (2,), (3,)):
                assert repair.repair(codes, q, ends) == brute(codes, q, ends)


def test_blocks_make_the_same_whole():
    rng = random.Random(7)
    for _ in range(120):
        codes = "".join(rng.choice("DDDDGGGGADEFGHJL") for _ in range(rng.randrange(1, 60)))
        size = rng.randrange(1, 9)
        chain = repair.Chain()
        for a in range(0, len(codes), size):
            chain.add(repair.segments(codes[a : a + size]))
        cost, parts = chain.result()
        assert (cost, "".join(x for x, _ in parts), "".join(x for _, x in parts)) == repair.repair(codes)


def plain(rows):
    """What the contract says of (conv_id, turn, role, text) rows, in Python."""
    said = lambda x: " " if x is None else str(x)
    talks = {}
    for c, t, r, x in rows:
        talks.setdefault(c, []).append((t, said(r), said(x)))
    white, out = " \t\n\x0b\x0c\r", {}
    for c, own in talks.items():
        kept = []
        for t, r, x in own:
            fate = zlib.crc32(f"{said(c)}:{said(t)}".encode()) % 20
            x = "" if fate == 1 else re.sub("[.!?]", "", x) if fate == 2 else x
            kept += [(t, "user" if fate == 4 else r, x)] * (0 if fate == 0 else 2 if fate == 3 else 1)
        kept.sort(key=lambda k: (k[0] is not None, k[0] or 0, k[1], hashlib.sha256(k[2].encode()).hexdigest()))
        codes, seen, faults = "", set(), []
        for _, r, x in kept:
            bare = x.strip(white)
            fault = "blank" if not bare else "duplicate" if (r, x) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((r, x))
            faults.append(fault)
            codes += repair.CODES["sua?".index(r[:1] if r[:1] in ("s", "u", "a") else "?") * 3 + {"": 0, "truncated": 1}.get(fault, 2)]
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, audit, plan = brute(codes) if codes else (0, "", "")
        lines, i = [], 0
        for p in plan:
            if p in "ua":
                lines.append(("user:", "assistant:")[p == "a"])
            else:
                if p != "D":
                    lines.append({"K": kept[i][1], "U": "user", "A": "assistant"}[p] + ":" + kept[i][2])
                i += 1
        out[c] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def odd_rows():
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["Yes.", "No", "", None, "A b?", "x!\n", "same.", "é."])) for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(c, None, "user", f"t{k}.") for c in (None, 3, 5) for k in range(3)] + [(None, t, ("user", "assistant")[t % 2], "Well.") for t in range(40)]
    rows += [(777, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", "No", f"{t}.", f"{t}"])) for t in range(300)] + [(5, 2, "user", "again."), (5, 2, "user", "again.")]
    return rows


@pytest.mark.parametrize("block", [repair.BLOCK, 16])
def test_query_against_a_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = odd_rows() + [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").filter("conv_id > 100").collect()]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"conv": F.lit(1), "pos": F.lit("x"), "code": F.lit(2), "block": F.lit(3)})
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_damaged(df).collect()}
    want = plain(rows)
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == want[c], c


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_damaged(df).count() == 0
