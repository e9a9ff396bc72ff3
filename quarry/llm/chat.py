"""Chat formatting by schema fingerprints.

Records of several layouts (prompt and response, instruction and output, lists of messages) lie in one frame whose
columns are the union of the layouts' fields. A row's fingerprint is the hash of the nested field paths that it fills.
Each declared mapping lists its required and optional paths, which gives the fingerprints that select it, and an
expression for the canonical turns. All of it is Column expressions.

Defined results: a row whose fingerprint no mapping declares gets layout null and no turns (an empty formatted text),
so that it can be set aside; null roles and texts inside a selected layout are empty; very long texts are kept whole;
repeated rows are formatted each for itself; an empty table gives an empty result; columns that are neither the key
nor a field of a mapping are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TURN = "struct<role:string,text:string>"


def escape(text: Column) -> Column:
    """Leaves no control string in a text: ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|``."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    """Undoes ``escape``."""
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


@dataclass(frozen=True)
class Layout:
    """A declared mapping. ``turns`` builds array<struct<role,text>> from the columns of the frame."""

    name: str
    required: tuple[str, ...]
    turns: Callable[[], Column]
    optional: tuple[str, ...] = field(default=())

    def fingerprints(self) -> list[str]:
        subsets = (set(self.required) | set(x) for k in range(len(self.optional) + 1) for x in combinations(self.optional, k))
        return sorted({hashlib.sha256("\n".join(sorted(s)).encode()).hexdigest() for s in subsets})


def _if_set(name: str, role: str) -> Column:
    one = F.array(turn(F.lit(role), F.col(name)))
    return F.when(F.col(name).isNotNull(), one).otherwise(F.array().cast(f"array<{TURN}>"))


def _with_input() -> Column:
    return F.concat_ws("\n\n", F.col("instruction"), F.col("input"))


def _list_of(column: str, role: str, text: str, names: dict[str, str] | None = None) -> Column:
    def one(m: Column) -> Column:
        said = m[role]
        for old, new in (names or {}).items():
            said = F.when(m[role] == old, F.lit(new)).otherwise(said)
        return turn(said, m[text])

    return F.transform(F.col(column), one)


LAYOUTS = (
    Layout("prompt", ("prompt", "response"), lambda: F.concat(_if_set("system", "system"), F.array(turn(F.lit("user"), F.col("prompt")), turn(F.lit("assistant"), F.col("response")))), ("system",)),
    Layout("instruction", ("instruction", "output"), lambda: F.concat(_if_set("system", "system"), F.array(turn(F.lit("user"), _with_input()), turn(F.lit("assistant"), F.col("output")))), ("system", "input")),
    Layout("messages", ("messages[].role",), lambda: _list_of("messages", "role", "content"), ("messages[].content",)),
    Layout("texts only", ("messages[].content",), lambda: _list_of("messages", "role", "content")),
    Layout("speakers", ("conversations[].from",), lambda: _list_of("conversations", "from", "value", {"human": "user", "gpt": "assistant"}), ("conversations[].value",)),
)


def field_paths(schema: T.StructType) -> dict[str, Callable[[Column], Column]]:
    """Each nested leaf path and, given the value that holds it, whether it is filled."""
    found: dict[str, Callable[[Column], Column]] = {}

    def walk(path: str, kind: T.DataType, reach: Callable[[Callable[[Column], Column]], Callable[[Column], Column]]) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f"{path}.{f.name}" if path else f.name, f.dataType, lambda test, f=f: reach(lambda v: test(v[f.name])))
        elif isinstance(kind, T.ArrayType):
            walk(f"{path}[]", kind.elementType, lambda test: reach(lambda v: F.coalesce(F.exists(v, test), F.lit(False))))
        else:
            found[path] = reach(lambda v: v.isNotNull())

    for f in schema.fields:
        walk(f.name, f.dataType, lambda test: test)
    return {p.replace("[].", "[]."): t for p, t in found.items()}


def fingerprint(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of the sorted nested field paths that a row fills, one path a line."""
    named = {}
    for c in columns:
        for path, test in field_paths(T.StructType([df.schema[c]])).items():
            named[path] = test(F.col(c))
    parts = [F.when(named[p], F.lit(p)) for p in sorted(named)]
    return F.sha2(F.concat_ws("\n", *parts), 256)


def canonical_turns(df: DataFrame, keys: list[str], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """keys, fingerprint, layout (null: none declared) and turns (array of role and text)."""
    fields = {p.split("[")[0].split(".")[0] for x in layouts for p in (*x.required, *x.optional)}
    have = [c for c in df.columns if c in fields and c not in keys]
    df = df.select(*keys, *have)
    known = {p for c in have for p in field_paths(T.StructType([df.schema[c]]))}
    df = df.withColumn("fingerprint", fingerprint(df, have))
    for c in sorted({p for x in layouts for p in (*x.required, *x.optional) if "[" not in p and "." not in p} - set(have)):
        df = df.withColumn(c, F.lit(None).cast("string"))
    layout, turns = F.lit(None).cast("string"), F.array().cast(f"array<{TURN}>")
    for x in reversed(layouts):
        if set(x.required) <= known:
            hit = F.col("fingerprint").isin(x.fingerprints())
            layout, turns = F.when(hit, F.lit(x.name)).otherwise(layout), F.when(hit, x.turns()).otherwise(turns)
    return df.select(*keys, "fingerprint", layout.alias("layout"), turns.alias("turns"))


def format_chats(df: DataFrame, keys: list[str], layouts: tuple[Layout, ...] = LAYOUTS, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """keys, fingerprint, layout, turns, formatted, loss_spans.

    formatted: for each turn ``<|im_start|>role\\ntext<|im_end|>\\n``, roles and texts escaped. loss_spans: start and
    length, in code points of ``formatted``, of the text of each turn whose role is in ``learn``.
    """
    out = canonical_turns(df, keys, layouts)
    parts = F.transform("turns", lambda t: F.struct(t["role"].isin(*learn).alias("learn"), F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body")))
    tail = END + "\n"
    out = out.withColumn("_parts", parts).withColumn("formatted", F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), ""))
    spans = "array<struct<start:int,length:int>>"

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        size = F.length(p["body"])
        span = F.struct(start.alias("start"), size.alias("length"))
        return F.struct((start + size + F.lit(len(tail))).alias("at"), F.when(p["learn"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).cast(spans).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("spans"))
    return out.select(*keys, "fingerprint", "layout", "turns", "formatted", F.aggregate("_parts", begin, step, lambda a: a["spans"]).alias("loss_spans"))


def parse_chats(formatted: Column) -> Column:
    """The turns, read back from a formatted text."""
    pieces = F.split(formatted, START.replace("|", "\\|"))
    tail = len(END) + 1

    def one(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - tail)
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), one)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def turns_of(rows: DataFrame, key: str, order: str, role: str, text: str) -> DataFrame:
    """Gathers a table of one turn a row into records of the list layout: key, messages."""
    one = F.struct(F.col(order).alias("at"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("content"))
    return rows.groupBy(F.col(key)).agg(F.sort_array(F.collect_list(one)).alias("m")).select(key, F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))
