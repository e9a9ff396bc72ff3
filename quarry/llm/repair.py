"""Repair of conversations: the cheapest edits that make the roles ``(s?(ua)+)?``.

Rows are taken in order of conversation and turn. Each has a fault at most: blank (nothing but white space), duplicate
(role and text seen earlier in the conversation), truncated (the last character that isn't white space ends no
sentence). Edits: Keep (0), Rerole to user or assistant (2), Delete (3; blank and duplicate rows must go), Insert an empty
row of user or assistant (2); a truncated row that stays costs 1. The edit lattice has a node for each number of rows
done and each state of the pattern; an edit is an edge. Dijkstra's search runs from the start and from the accepted ends
at once, always on the side with the nearer node; when the two nearest nodes together cost as much as the best crossing,
all crossings of that cost are finished and the one with the least concatenated audit (edits' initials, ASCII) is taken.
Nodes are settled in the rows' order where costs are equal, so a node's least audit is known when it is settled; audits
to one node at one cost aren't prefixes of each other, as an edit string tells its node, so the least parts make the least
whole.

No conversation is gathered with its texts. Rows are numbered by ranges, a row counts as one character (role's initial and
fault), and BLOCK of them are a block. A conversation of one block is searched as it is. Of longer ones each block is
searched by itself, from each state to each other, in any task; then the blocks of a conversation, a few bytes a row, are
chained in one pass. A conversation's audit is one value of the result, a byte a row, so that much of it is held in a task;
its digest is fed row by row.

Defined results: nulls are one space (role, text, and in the damage's key); a null conversation is one; rows of equal
turns stand in order of role and text's digest, copies next to each other; roles count by their first character, and an
empty role has none, so such a row can't be kept; conversations of which no row is left have zeros, an empty audit and
the digest of nothing; an empty table gives an empty result; columns that aren't named are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import materialize, partitions, with_ranks

#: Rows a block.
BLOCK = 512
#: What Keep, Rerole, Delete and Insert cost, and a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: White space, and what ends a sentence.
WHITE, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: States: nothing yet, after a system row, after a user's, after an assistant's; by initial the next state.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ACCEPTED = (START, ASSISTANT)
#: A row as a character: its initial (s, u, a, other), in its order, three each: sound, truncated, blank or duplicate.
INITIALS, CODES = "sua", "ABCDEFGHIJKL"

Node = tuple[int, int]


def edges(code: str, state: int) -> Iterator[tuple[str, str, int, int]]:
    """Edits of one row in a state: letter of the audit, of the plan (Keep, Delete, user, assistant), cost, next state."""
    initial, fault = divmod(CODES.index(code), 3)
    yield "D", "D", DELETE, state
    if fault < 2:
        extra = TRUNCATED if fault else 0
        then = NEXT[state].get(INITIALS[initial]) if initial < 3 else None
        if then is not None:
            yield "K", "K", KEEP + extra, then
        for c in "ua":
            if c in NEXT[state]:
                yield "R", c.upper(), REROLE + extra, NEXT[state][c]


def inserts(state: int) -> Iterator[tuple[str, str, int, int]]:
    for c in "ua":
        if c in NEXT[state]:
            yield "I", c, INSERT, NEXT[state][c]


#: The edges that leave a state for each code, and those that enter it: (letter, plan, cost, other state).
OUT = {code: [list(edges(code, q)) for q in range(4)] for code in CODES}
INTO = {code: [[(x, p, c, q) for q in range(4) for x, p, c, to in OUT[code][q] if to == r] for r in range(4)] for code in CODES}
INSERT_OUT = [list(inserts(q)) for q in range(4)]
INSERT_INTO = [[(x, p, c, q) for q in range(4) for x, p, c, to in INSERT_OUT[q] if to == r] for r in range(4)]


class Search:
    """One direction: nearest open nodes, and of each node the cost and the least audit (with its plan) so far."""

    def __init__(self, codes: str, sources: Iterable[Node], back: bool) -> None:
        self.codes, self.back, self.heap = codes, back, []
        self.best: dict[Node, tuple[int, str, str]] = {}
        self.settled: set[Node] = set()
        for node in sources:
            self.reach(node, (0, "", ""))

    def reach(self, node: Node, found: tuple[int, str, str]) -> None:
        if node not in self.settled and (node not in self.best or found < self.best[node]):
            if node not in self.best or found[0] < self.best[node][0]:
                heapq.heappush(self.heap, (found[0], -node[0] if self.back else node[0], node[1]))
            self.best[node] = found

    def nearest(self) -> int | None:
        while self.heap:
            cost, i, q = self.heap[0]
            node = (-i if self.back else i, q)
            if node not in self.settled and self.best[node][0] == cost:
                return cost
            heapq.heappop(self.heap)
        return None

    def settle(self) -> tuple[Node, list[tuple[Node, str, str, int]]]:
        """Takes the nearest node; its edges: other node, letter, plan, cost."""
        _, i, q = heapq.heappop(self.heap)
        node = i, q = (-i if self.back else i, q)
        self.settled.add(node)
        cost, audit, plan = self.best[node]
        if self.back:
            met = [((i, r), x, p, c) for x, p, c, r in INSERT_INTO[q]]
            if i:
                met += [((i - 1, r), x, p, c) for x, p, c, r in INTO[self.codes[i - 1]][q]]
            for to, x, p, c in met:
                self.reach(to, (cost + c, x + audit, p + plan))
        else:
            met = [((i, r), x, p, c) for x, p, c, r in INSERT_OUT[q]]
            if i < len(self.codes):
                met += [((i + 1, r), x, p, c) for x, p, c, r in OUT[self.codes[i]][q]]
            for to, x, p, c in met:
                self.reach(to, (cost + c, audit + x, plan + p))
        return node, met


def repair(codes: str, begin: int = START, ends: tuple[int, ...] = ACCEPTED) -> tuple[int, str, str] | None:
    """Cost, audit and plan of the best edits of these rows from a state to one of others; None if there are none."""
    ahead, behind = Search(codes, [(0, begin)], False), Search(codes, [(len(codes), q) for q in ends], True)
    most: int | None = None  # the least cost of a crossing so far
    crossings: list[tuple[Node, str, str, int, Node]] = []  # edges from a node settled ahead to one settled behind

    def cross(cost: int, found: tuple) -> None:
        nonlocal most
        if most is None or cost < most:
            most = cost
            crossings.clear()
        if cost == most:
            crossings.append(found)

    while (near := ahead.nearest()) is not None and (far := behind.nearest()) is not None:
        if most is not None and near + far > most:
            break
        side, other = (ahead, behind) if near <= far else (behind, ahead)
        node, met = side.settle()
        if node in other.settled:
            cross(side.best[node][0] + other.best[node][0], (node, "", "", 0, node))
        for to, x, p, c in met:
            if to in other.settled:
                left, right = (node, to) if side is ahead else (to, node)
                cross(side.best[node][0] + c + other.best[to][0], (left, x, p, c, right))
    if most is None:
        return None
    whole = [(ahead.best[u][1] + x + behind.best[v][1], ahead.best[u][2] + p + behind.best[v][2]) for u, x, p, _, v in crossings]
    return most, *min(whole)


def segments(codes: str) -> list[tuple[int, str, str] | None]:
    """A block's best edits from each state to each other one (from 4 x to 4 states, in order)."""
    return [repair(codes, q, (r,)) for q in range(4) for r in range(4)]


class Chain:
    """Blocks of one conversation, one after another: of each state the best cost, and the block's edits on the way."""

    def __init__(self) -> None:
        self.cost: list[int | None] = [0, None, None, None]
        self.steps: list[list[tuple[int, str, str] | None]] = []  # of each block and state: the state before, audit, plan

    def _less(self, a: tuple[int, str], b: tuple[int, str]) -> bool:
        """Whether the way to state a[0], then audit a[1], is less than b's: compared from where the two ways part."""
        (q, x), (r, y), k = a, b, len(self.steps)
        left, right = [x], [y]
        while q != r:
            k -= 1
            (q, x, _), (r, y, _) = self.steps[k][q], self.steps[k][r]
            left.append(x)
            right.append(y)
        return "".join(reversed(left)) < "".join(reversed(right))

    def add(self, found: list[tuple[int, str, str] | None]) -> None:
        cost: list[int | None] = [None] * 4
        step: list[tuple[int, str, str] | None] = [None] * 4
        for r in range(4):
            for q in range(4):
                edge = found[4 * q + r]
                if self.cost[q] is None or edge is None:
                    continue
                total = self.cost[q] + edge[0]
                if cost[r] is None or total < cost[r] or (total == cost[r] and self._less((q, edge[1]), step[r][:2])):
                    cost[r], step[r] = total, (q, edge[1], edge[2])
        self.cost = cost
        self.steps.append(step)

    def result(self) -> tuple[int, list[tuple[str, str]]]:
        """The cost, and each block's audit and plan."""
        ends = [q for q in ACCEPTED if self.cost[q] is not None]
        least = min(self.cost[q] for q in ends)
        ends = [q for q in ends if self.cost[q] == least]
        q = ends[1] if len(ends) == 2 and self._less((ends[1], ""), (ends[0], "")) else ends[0]
        out = []
        for step in reversed(self.steps):
            q, audit, plan = step[q]
            out.append((audit, plan))
        return least, out[::-1]


def damage(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, twice (0, of a copy 1) after the damage that crc32 of ``conversation:turn`` names."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said(conversation), F.lit(":"), said(turn)).cast("binary")) % 20
    rows = df.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text"), fate.alias("fate")).filter("fate <> 0")
    new = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    twice = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), new.alias("text"), twice.alias("twice"))


def faults(rows: DataFrame) -> DataFrame:
    """Numbered rows with ``code``. The first row of each role and text is told by a count, and marked by its place."""
    first = rows.filter("not blank").groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos")).select("conv", "pos", F.lit(True).alias("first"))
    initial = F.substring("role", 1, 1)
    kind = F.coalesce(*(F.when(initial == c, i) for i, c in enumerate(INITIALS)), F.lit(3))
    fault = F.when(F.col("blank") | F.col("first").isNull(), 2).when(F.col("cut"), 1).otherwise(0)
    told = rows.alias("r").join(first.alias("f"), F.expr("r.conv <=> f.conv and r.pos = f.pos"), "left").select("r.*", "f.first")
    return told.withColumn("code", F.substring(F.lit(CODES), kind * 3 + fault + 1, F.lit(1)))


def counts(rows: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated."""
    number = lambda x: F.count(F.when(x, 1))
    fault = (F.ascii("code") - F.lit(ord(CODES[0]))) % 3
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    return rows.groupBy("conv").agg(gaps.alias("gaps"), number(F.col("blank")).alias("blank"), number((fault == 2) & ~F.col("blank")).alias("duplicate"), number(fault == 1).alias("truncated"))


def _illegal(codes: str, before: str = "") -> int:
    kinds = ["sua?"[CODES.index(c) // 3] for c in before + codes]
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(kinds, kinds[1:], strict=False))


#: One searched path: cost, audit, plan.
PATH = T.StructType([T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("plan", T.StringType())])


def searched(rows: DataFrame) -> DataFrame:
    """conv, block, cost, illegal, audit, plan: each block's part of its conversation's best edits; cost and illegal stand
    in the first one."""
    kind = rows.schema["conv"].dataType
    blocks = rows.groupBy("conv", F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "").alias("codes"))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for number, codes in zip(batch.column("block").to_pylist(), batch.column("codes").to_pylist(), strict=True):
                alone = number == 0 and len(codes) < BLOCK  # the whole conversation
                found = [repair(codes)] if alone else segments(codes)
                paths.append([x and dict(zip(PATH.names, x, strict=True)) for x in found])
            shape = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("plan", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, shape)], names=["conv", "block", "codes", "paths"])

    key = [T.StructField("conv", kind), T.StructField("block", T.LongType())]
    found = blocks.mapInArrow(search, T.StructType([*key, T.StructField("codes", T.StringType()), T.StructField("paths", T.ArrayType(PATH))]))
    dealt = found.repartition(partitions(rows.sparkSession), "conv").sortWithinPartitions("conv", "block")

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None  # the conversation that is open: key, chain, illegal, last code

        def out(keys: list[pa.Array], told: list[tuple]) -> pa.RecordBatch:
            names = ["block", "cost", "illegal", "audit", "plan"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array([x[i] for x in told], k) for i, k in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([pa.concat_arrays(keys), *columns], names=["conv", *names])

        def closed() -> tuple[list[pa.Array], list[tuple]]:
            key, held, illegal, _ = now
            cost, parts = held.result()
            told = [(i, cost if not i else 0, illegal if not i else 0, *x) for i, x in enumerate(parts)]
            return [pa.concat_arrays([key] * len(told))], told

        for batch in batches:
            keys: list[pa.Array] = []
            told: list[tuple] = []
            for i in range(batch.num_rows):
                block, codes, paths = (batch.column(c)[i].as_py() for c in ("block", "codes", "paths"))
                paths = [x and tuple(x.values()) for x in paths]
                if block == 0:
                    if now is not None:
                        for held, more in zip((keys, told), closed(), strict=True):
                            held += more
                        now = None
                    if len(paths) == 1:
                        keys.append(batch.column("conv").slice(i, 1))
                        told.append((0, paths[0][0], _illegal(codes), *paths[0][1:]))
                        continue
                    now = (batch.column("conv").slice(i, 1), Chain(), 0, "")
                key, held, illegal, last = now
                held.add(paths)
                now = (key, held, illegal + _illegal(codes, last), codes[-1])
            if told:
                yield out(keys, told)
        if now is not None:
            yield out(*closed())

    schema = T.StructType([*key, T.StructField("cost", T.LongType()), T.StructField("illegal", T.LongType()), *PATH.fields[1:]])
    return materialize(dealt.mapInArrow(chain, schema), few=True)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv, pos, lines: each row's lines after its edits (role:text, inserted rows before it; those at the end stand in
    the row after the last one). Rows of which nothing is left aren't there."""
    edits = F.posexplode(F.regexp_extract_all("plan", F.lit("[ua]*[KDUA]|[ua]+$"), 0))
    told = found.select("conv", "block", edits).select("conv", (F.col("block") * BLOCK + F.col("pos")).alias("pos"), F.col("block").alias("of"), F.col("col").alias("edit"))
    # Inserts at a block's end stand at the place of the next block's first row: they go before it.
    told = told.groupBy("conv", "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("of", "edit"))), lambda x: x["edit"]), "").alias("edit"))
    both = rows.select("conv", "pos", "role", "text").alias("r").join(told.alias("e"), F.expr("r.conv <=> e.conv and r.pos = e.pos"), "right")
    inserted = F.transform(F.filter(F.split(F.regexp_replace("edit", "[A-Z]", ""), ""), lambda c: c != ""), lambda c: F.when(c == "u", "user:").otherwise("assistant:"))
    done = F.regexp_extract("edit", "[A-Z]$", 0)
    role = F.when(done == "U", "user").when(done == "A", "assistant").otherwise(F.col("r.role"))
    own = F.when(done.isin("K", "U", "A"), F.array(F.concat(role, F.lit(":"), F.col("r.text")))).otherwise(F.array().cast("array<string>"))
    lines = F.concat(inserted, own)
    return both.select(F.col("e.conv").alias("conv"), F.col("e.pos").alias("pos"), lines.alias("lines")).filter(F.size("lines") > 0).withColumn("lines", F.array_join("lines", "\n"))


def digests(lines: DataFrame) -> DataFrame:
    """conv, repaired_sha256. A conversation's lines are fed to its digest in order, not held."""
    dealt = lines.repartition(partitions(lines.sparkSession), "conv").sortWithinPartitions("conv", "pos")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        for batch in batches:
            keys, told = [], []
            for i in range(batch.num_rows):
                key = batch.column("conv")[i]
                if now is None or not (now[0].equals(key)):
                    if now is not None:
                        keys.append(now[1])
                        told.append(now[2].hexdigest())
                    now = (key, batch.column("conv").slice(i, 1), hashlib.sha256())
                else:
                    now[2].update(b"\n")
                now[2].update(batch.column("lines")[i].as_py().encode())
            if told:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(keys), pa.array(told)], names=["conv", "repaired_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([now[1], pa.array([now[2].hexdigest()])], names=["conv", "repaired_sha256"])

    schema = T.StructType([lines.schema["conv"], T.StructField("repaired_sha256", T.StringType())])
    return dealt.select("conv", "lines").mapInArrow(run, schema)


#: Columns of the result beside the conversation.
RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with their place in their conversation, and what their text says of itself: blank, cut, digest."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    told = rows.withColumns({"blank": bare == "", "cut": ~F.substring(bare, -1, 1).isin(*ENDS), "digest": F.sha2("text", 256)})
    return with_ranks(told, ["conv"], ["conv", "turn", "role", "digest", "twice"], "pos")


def mend(df: DataFrame, original: DataFrame, conversation: str = "conv_id", name: str = "conv") -> DataFrame:
    """df: conv, turn, role, text, twice; original: all conversations (``conv``). One row a conversation."""
    rows = materialize(faults(numbered(df)))
    found = searched(rows)
    lines = repaired(rows, found)
    whole = found.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    told = counts(rows)
    out = original.select("conv").distinct().alias("o")
    for other, tag in ((told, "t"), (whole, "w"), (digests(lines), "d")):
        out = out.join(other.alias(tag), F.expr(f"o.conv <=> {tag}.conv"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(F.col("o.conv").alias(conversation), *(zero(c) for c in RESULT[:6]), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))


def repair_damaged(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damages the conversations and mends them: conversation, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256."""
    return mend(damage(df, conversation, turn, role, text), df.select(F.col(conversation).alias("conv")), conversation)
