"""Calls of a model: one call a template, behind a client that is passed in, resumed from a cache.

A client is a picklable function from a list of payloads (JSON strings) to a list of replies (strings, or exceptions).
There is none in this library; ``offline`` stands in for tests. Cluster-wide concurrency is the number of partitions.

``asked`` keeps a window of single calls in flight in each task: a client of it is a coroutine function (or a plain one,
which then runs in a thread) of one payload. Each item has its own clock for retries and leaves its place in the window
while it waits. With a journal each reply is on disk before it is handed on, so a task that is run again, or a job that
is started again, asks only what has no reply yet.
"""

from __future__ import annotations

import asyncio
import inspect
import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import records
from .cluster import missing

Client = Callable[[list[str]], list]


def offline(payloads: list[str]) -> list[str]:
    """A fixed reply to everything."""
    return [json.dumps({"quality": "acceptable", "difficulty": "moderate", "reason": "offline"}) for _ in payloads]


def payload(model: str, system: str, user: str, most: int, thinking: str | None = None, effort: str | None = None, json_mode: bool = False) -> dict:
    """One request. An effort turns thinking on where it isn't set; with thinking on there is no temperature."""
    if effort and thinking == "disabled":
        raise ValueError("an effort needs thinking")
    if effort and thinking is None:
        thinking = "enabled"
    out: dict = {"model": model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}], "max_tokens": most}
    if thinking != "enabled":
        out["temperature"] = 0
    if json_mode:
        out["response_format"] = {"type": "json_object"}
    if thinking:
        out["thinking"] = {"type": thinking}
    if effort:
        out["reasoning_effort"] = effort
    return out


def answered(df: DataFrame, client: Client, key: str, payload: str, concurrency: int = 8, batch: int = 8, retries: int = 2, longest_wait: float = 4.0, details: bool = False) -> DataFrame:
    """key, reply and error (one of them null), with retries after 1, 2, 4 ... seconds, bounded.

    A client may reply by a dictionary of content, reasoning and usage. With details there are also reasoned (whether the
    model gave its reasoning, which itself is never kept) and usage (JSON).
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, batch):
                part = b.slice(a, batch)
                asked = part.column(1).to_pylist()
                got: list = [None] * len(asked)
                left = list(range(len(asked)))
                for k in range(retries + 1):
                    try:
                        replies = client([asked[i] for i in left])
                    except Exception as e:  # noqa: BLE001  a client may fail in any way; it is told as an error
                        replies = [e] * len(left)
                    for i, r in zip(left, replies, strict=True):
                        got[i] = r
                    left = [i for i in left if isinstance(got[i], Exception)]
                    if not left:
                        break
                    if k < retries:
                        time.sleep(min(2.0**k, longest_wait))
                told = [r if isinstance(r, dict) else {"content": r} for r in got]
                reply = [None if isinstance(r, Exception) else t.get("content") for r, t in zip(got, told, strict=True)]
                error = [str(r) if isinstance(r, Exception) else None for r in got]
                columns = [part.column(0), pa.array(reply, pa.string()), pa.array(error, pa.string())]
                if details:
                    columns.append(pa.array([bool(t.get("reasoning")) for t in told], pa.bool_()))
                    columns.append(pa.array([json.dumps(t["usage"], sort_keys=True) if t.get("usage") else None for t in told], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[key, "reply", "error", *(["reasoned", "usage"] if details else [])])

    more = ", reasoned boolean, usage string" if details else ""
    return df.select(key, payload).repartition(concurrency, key).mapInArrow(run, f"{key} {kind}, reply string, error string{more}")


class Journal:
    """Replies of one part of the keys, as lines of small files in a folder. Local and shared folders have each line as
    soon as it is written; in other stores a file can be read once it is closed, so there each ``every`` lines are a file."""

    def __init__(self, folder: str, part: int, every: int = 8) -> None:
        self.system, place = records.opened(folder)
        self.place, self.every, self.lines, self.stream = f"{place.rstrip('/')}/{part:06d}", every, 0, None
        self.local = isinstance(self.system, fs.LocalFileSystem)
        self.system.create_dir(self.place, recursive=True)

    def replies(self) -> dict[str, dict]:
        """What earlier tries have written, by key; a line that was cut off is none."""
        out = {}
        for info in self.system.get_file_info(fs.FileSelector(self.place)):
            if info.type == fs.FileType.File:
                with self.system.open_input_stream(info.path) as f:
                    for line in f.read().split(b"\n")[:-1]:
                        told = json.loads(line)
                        out[told["key"]] = told
        return out

    def add(self, key: str, reply: dict) -> None:
        if self.stream is None:
            self.stream = self.system.open_output_stream(f"{self.place}/{uuid.uuid4().hex}.jsonl")
        self.stream.write(json.dumps(reply | {"key": key}, ensure_ascii=False).encode() + b"\n")
        self.lines += 1
        if self.local:
            self.stream.flush()
        elif self.lines % self.every == 0:
            self.close()

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def in_flight(items: Iterable[tuple], client: Callable, width: int, retries: int, first_wait: float, longest_wait: float, timeout: float | None) -> Iterator[tuple]:
    """(item, reply or exception) of items (key, payload, ...) as they are done: at most width calls at a time, and at most
    four times as many items that wait for their next try."""
    loop, pool = asyncio.new_event_loop(), ThreadPoolExecutor(width)
    slots = asyncio.Semaphore(width)
    made = inspect.iscoroutinefunction(client) or inspect.iscoroutinefunction(getattr(client, "__call__", None))

    async def one(item: tuple) -> tuple:
        for k in range(retries + 1):
            try:
                async with slots:
                    call = client(item[1]) if made else loop.run_in_executor(pool, client, item[1])
                    reply = await asyncio.wait_for(call, timeout)
            except Exception as e:  # noqa: BLE001  a client may fail in any way; it is told as an error
                reply = e
            if not isinstance(reply, Exception):
                break
            if k < retries:
                await asyncio.sleep(min(first_wait * 2.0**k, longest_wait))
        return item, reply

    left, open_ = iter(items), set()
    try:
        more = True
        while more or open_:
            while more and len(open_) < 4 * width:
                item = next(left, None)
                more = item is not None
                if more:
                    open_.add(loop.create_task(one(item)))
            if open_:
                done, open_ = loop.run_until_complete(asyncio.wait(open_, return_when=asyncio.FIRST_COMPLETED))
                yield from (t.result() for t in done)
    finally:
        for t in open_:
            t.cancel()
        if open_:
            loop.run_until_complete(asyncio.gather(*open_, return_exceptions=True))
        pool.shutdown(wait=False, cancel_futures=True)
        loop.close()


def asked(df: DataFrame, client: Callable, key: str, payload: str, partitions: int = 8, width: int = 8, retries: int = 2, first_wait: float = 1.0, longest_wait: float = 4.0, timeout: float | None = 120.0, journal: str | None = None, keep_errors: bool = False, details: bool = False) -> DataFrame:
    """key, reply and error (one of them null), as ``answered``; width calls in flight in each of so many partitions.

    journal: a folder that driver and executors share. Keys are dealt by their hash, so a key's replies stand in one part of
    it whatever else is asked; the same number of partitions finds them again. Errors aren't kept, unless told so: a job
    that is started again asks for them again. Repeated keys are asked once each row.
    """
    kind = df.schema[key].dataType.simpleString()
    names = ["reply", "error", *(["reasoned", "usage"] if details else [])]

    def told(reply: object) -> dict:
        if isinstance(reply, Exception):
            return {"reply": None, "error": str(reply) or type(reply).__name__, "reasoned": False, "usage": None}
        x = reply if isinstance(reply, dict) else {"content": reply}
        return {"reply": x.get("content"), "error": None, "reasoned": bool(x.get("reasoning")), "usage": json.dumps(x["usage"], sort_keys=True) if x.get("usage") else None}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log = Journal(journal, TaskContext.get().partitionId()) if journal else None
        have = log.replies() if log else {}
        kinds = {"reasoned": pa.bool_()}

        def out(keys: list[pa.Array], rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.concat_arrays(keys), *(pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in names)], names=[key, *names])

        def wanted() -> Iterator[tuple]:
            for b in batches:
                for i, (name, body) in enumerate(zip(b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True)):
                    if name in have:
                        known.append((b.column(0).slice(i, 1), have[name]))
                    else:
                        yield name, body, b.column(0).slice(i, 1)

        known: list[tuple] = []
        try:
            for item, reply in in_flight(wanted(), client, width, retries, first_wait, longest_wait, timeout):
                row = told(reply)
                if log and (row["error"] is None or keep_errors):
                    log.add(item[0], row)
                known.append((item[2], row))
                if len(known) >= width:
                    yield out(*map(list, zip(*known, strict=True)))
                    known.clear()
            if known:
                yield out(*map(list, zip(*known, strict=True)))
        finally:
            if log:
                log.close()

    more = ", reasoned boolean, usage string" if details else ""
    rows = df.select(key, payload, F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"))
    return rows.repartition(partitions, "name").mapInArrow(run, f"{key} {kind}, reply string, error string{more}")


def token_usage(replies: DataFrame) -> DataFrame:
    """Tokens by kind over all replies (of ``answered`` with details)."""
    pairs = F.explode(F.map_entries(F.from_json("usage", "map<string,long>")))
    return replies.select(pairs.alias("u")).groupBy(F.col("u.key").alias("kind")).agg(F.sum("u.value").alias("tokens"))


def resumed(df: DataFrame, cache: DataFrame, client: Client, key: str, payload: str, **options) -> DataFrame:
    """Replies for the keys that the cache lacks: each different key is asked once."""
    wanted = df.groupBy(key).agg(F.any_value(payload).alias(payload))
    return answered(missing(wanted, cache, [key]), client, key, payload, **options)


def write_logs(replies: DataFrame, good: str, bad: str) -> None:
    """Appends answers and errors to their own tables."""
    replies.filter("error IS NULL").drop("error").write.mode("append").parquet(good)
    replies.filter("error IS NOT NULL").drop("reply").write.mode("append").parquet(bad)
