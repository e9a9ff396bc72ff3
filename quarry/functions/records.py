"""Canonical forms and hashes of JSON records. Python writes the numbers, as the ids that depend on them were made so."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _written(raw: Column, write: Callable[[object], str]) -> Column:
    def one(text: str | None) -> str | None:
        try:
            return None if text is None else write(json.loads(text))
        except ValueError:
            return None

    @F.arrow_udf("string")
    def written(batch: pa.Array) -> pa.Array:
        return pa.array([one(x) for x in batch.to_pylist()], pa.string())

    return written(raw)


def canonical(raw: Column, finite: bool = False) -> Column:
    """A record with sorted keys, without spaces; null where it is no JSON or, if finite, holds a number that isn't."""
    return _written(raw, lambda x: json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=not finite))


def compact(raw: Column) -> Column:
    """A record without spaces, its keys in their own order."""
    return _written(raw, lambda x: json.dumps(x, ensure_ascii=False, separators=(",", ":")))


def record_hash(raw: Column) -> Column:
    """SHA-256 of the compact record: tells whether a reviewed record is still the same."""
    return F.sha2(compact(raw), 256)
