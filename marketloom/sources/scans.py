"""Scans: typed raw files, pruned windows of facts, bounded batches, merges."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.functions.expressions import half_open
from marketloom.sources.contracts import Contract, Field

BAD = "_invalid__"


def _typed(field: Field) -> Column:
    text = F.nullif(F.trim(F.col(field.name)), F.lit(""))
    if field.kind == "timestamp":
        return F.try_to_timestamp(text)
    return text if field.kind == "string" else text.try_cast("int" if field.kind == "integer" else "double")


def _invalid(field: Field, typed: Column) -> Column:
    text = F.nullif(F.trim(F.col(field.name)), F.lit(""))
    bad = text.isNotNull() & typed.isNull()
    if field.kind == "double":
        bad = bad | F.coalesce(F.isnan(typed) | (F.abs(typed) == float("inf")), F.lit(False))
    if not field.nullable:
        bad = bad | text.isNull()
    if field.allowed:
        bad = bad | F.coalesce(~typed.isin(*field.allowed), F.lit(False))
    return bad


def typed_columns(raw: DataFrame, contract: Contract) -> DataFrame:
    """Trimmed, cast columns of a contract and one flag per field that it breaks.

    Casts never raise: a value that can't be cast is null and flagged.
    """
    contract.require_columns(raw.columns)
    typed = {f.name: _typed(f) for f in contract.fields}
    return raw.select(
        *(typed[f.name].alias(f.name) for f in contract.fields),
        *(_invalid(f, typed[f.name]).alias(BAD + f.name) for f in contract.fields),
    )


def typed_scan(spark: SparkSession, path: str, contract: Contract, ingested_at: datetime) -> DataFrame:
    """Read a CSV file of a contract as strings and type it; malformed lines fail."""
    header = spark.read.option("header", True).csv(path).columns
    contract.require_columns(header)
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    return typed_columns(raw, contract).withColumns(
        {"ingest_ts": F.lit(ingested_at).cast("timestamp"), "source_file": F.lit(path.rsplit("/", 1)[-1])}
    )


def without_flags(frame: DataFrame) -> DataFrame:
    return frame.drop(*(c for c in frame.columns if c.startswith(BAD)))


def dimension_ingest(frames: dict[str, DataFrame], base: str, ingest_date: str, names: Iterable[str]) -> None:
    """Write chosen dimensions as partitions of one date."""
    for name in names:
        without_flags(frames[name]).write.mode("errorifexists").parquet(f"{base}/{name}/ingest_date={ingest_date}")


def month_of(column: str) -> Column:
    return F.date_format(column, "yyyy-MM")


def select_months(facts: DataFrame, time_col: str, months: Iterable[str] | None = None) -> DataFrame:
    """Facts with their month, all or those of some months; a month without rows is an error."""
    with_month = facts.withColumn("purchase_month", month_of(time_col))
    if months is None:
        return with_month
    wanted = sorted(set(months))
    chosen = with_month.where(F.col("purchase_month").isin(*wanted))
    found = {r[0] for r in chosen.select("purchase_month").distinct().collect()}  # at most the months asked for
    if missing := [m for m in wanted if m not in found]:
        raise ValueError(f"no rows for {missing}")
    return chosen


def fact_ingest_by_month(facts: DataFrame, time_col: str, base: str, months: Iterable[str] | None = None, rows_per_file: int = 1_000_000) -> None:
    """Write facts partitioned by month, with bounded files."""
    chosen = select_months(facts, time_col, months)
    chosen.write.partitionBy("purchase_month").option("maxRecordsPerFile", rows_per_file).mode("errorifexists").parquet(base)


def overlapping_months(start: datetime, end: datetime) -> list[str]:
    """The months that intersect [start, end)."""
    out, at = [], start.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    while at < end:
        out.append(at.strftime("%Y-%m"))
        at = (at + timedelta(days=32)).replace(day=1)
    return out


def interval_scan(facts: DataFrame, time_col: str, cutoff: datetime, days: int) -> DataFrame:
    """Rows of [cutoff - days, cutoff); with a month column, only its partitions are read."""
    return _window_scan(facts, time_col, cutoff - timedelta(days=days), cutoff)


def label_scan(facts: DataFrame, time_col: str, cutoff: datetime, days: int) -> DataFrame:
    """Rows of [cutoff, cutoff + days)."""
    return _window_scan(facts, time_col, cutoff, cutoff + timedelta(days=days))


def _window_scan(facts: DataFrame, time_col: str, start: datetime, end: datetime) -> DataFrame:
    if "purchase_month" in facts.columns:
        facts = facts.where(F.col("purchase_month").isin(*overlapping_months(start, end)))
    return facts.where(half_open(time_col, start, end))


def event_date_scan(events: DataFrame | None, cutoff: datetime, days: int, required: Iterable[str]) -> DataFrame | None:
    """Events by their date partition, the cutoff's day included; an absent table is None."""
    if events is None:
        return None
    if missing := sorted(set(required) - set(events.columns)):
        raise ValueError(f"events lack {missing}")
    first = (cutoff - timedelta(days=days)).date()
    return events.where((F.col("event_date") >= F.lit(first)) & (F.col("event_date") <= F.lit(cutoff.date())))


def behind(events: DataFrame, after: tuple[datetime, int] | None, time_col: str = "received_at", id_col: str = "event_id") -> DataFrame:
    """The rows behind a watermark of time and id."""
    if after is None:
        return events
    at, last = after
    return events.where((F.col(time_col) > F.lit(at)) | ((F.col(time_col) == F.lit(at)) & (F.col(id_col) > F.lit(last))))


def incremental_batch(events: DataFrame, after: tuple[datetime, int] | None, size: int, time_col: str = "received_at", id_col: str = "event_id") -> DataFrame:
    """The next rows behind a watermark of time and id, in order, at most ``size``."""
    return behind(events, after, time_col, id_col).orderBy(time_col, id_col).limit(size)


def merge_events(existing: DataFrame, incoming: DataFrame, id_col: str = "event_id", mark_col: str = "event_fingerprint") -> DataFrame:
    """One row per event of both; equal rows collapse, the later arrival's row stays, on a tie the incoming one.

    ``conflicts`` tells events with several fingerprints; the caller must refuse them.
    """
    others = [c for c in incoming.columns if c != id_col]
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return (
        both.groupBy(id_col)
        .agg(F.max_by(F.struct(*others), F.struct("received_at", "_new", mark_col)).alias("_r"), (F.countDistinct(mark_col) > 1).alias("conflicts"))
        .select(id_col, "_r.*", "conflicts")
    )


def latest_version(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order)))
    return frame.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
