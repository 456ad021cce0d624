"""Column expressions that several operators use."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_open(column: str | Column, start: datetime, end: datetime) -> Column:
    """start <= column < end, in a form that Parquet can be pruned by."""
    column = F.col(column) if isinstance(column, str) else column
    return (column >= F.lit(start)) & (column < F.lit(end))


def lookback(column: str, cutoff: datetime, days: int) -> Column:
    """The ``days`` before a cutoff, the cutoff itself excluded."""
    return half_open(column, cutoff - timedelta(days=days), cutoff)


def clip(column: str | Column, low: float | Column, high: float | Column) -> Column:
    """The value, or the nearer bound; null stays null."""
    column = F.col(column) if isinstance(column, str) else column
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.when(column.isNotNull(), F.least(high, F.greatest(low, column)))


def lookup(key: str | Column, values: Mapping[str, float], default: float) -> Column:
    """The entry of a small literal map, or a default; a null key has the default."""
    key = F.col(key) if isinstance(key, str) else key
    if not values:
        return F.lit(default)
    pairs = [F.lit(x) for item in sorted(values.items()) for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(default))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, null where the bottom is not positive."""
    return F.when(bottom > 0, top / bottom)


def payload_digest(columns: list[str]) -> Column:
    """A digest of some columns with their names, for comparing versions of a row."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def ordered_hash(seed: int, *columns: str) -> Column:
    """A seeded hash that orders rows alike on every run and engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in columns)))


def batch_id(lower: Column, upper: Column) -> Column:
    """A name for the batch between two watermarks."""
    return F.substring(F.sha2(F.concat_ws("|", lower, upper), 256), 1, 32)
