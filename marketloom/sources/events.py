"""Events in date partitions, with a table that says on which date each event is stored.

Three tables belong together: the events at ``path``, by date; the ids at ``path-ids``, by
a hash of the id in a fixed number of buckets; and the ledger at ``path-ledger``, one row a
published batch. A batch reads and rewrites the dates and buckets that it touches and
no others.

They are written in this order: events, ids, ledger. A batch that is cut off in between and
runs again finds the same events and does the same once more, as merging a row that is
there already changes nothing; only a batch whose row is in the ledger is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.distributed import running
from marketloom.sources.scans import behind, merge_events
from marketloom.sources.shared import delete, discard, materialise

#: Buckets of the table of ids. It is part of the stored layout: another number needs a new table.
BUCKETS = 64
LEDGER = "batch_id string, lower_at timestamp, lower_id long, upper_at timestamp, upper_id long, n_rows long"


class ConflictingEvents(ValueError):
    """One event id came with several fingerprints."""


def stored(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table that may not be there yet; its partition columns are typed as in the schema."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def _overwrite(frame: DataFrame, path: str, by: str) -> None:
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def _ids(frame: DataFrame, id_col: str, mark_col: str, buckets: int) -> DataFrame:
    return frame.select(F.col(id_col).cast("long").alias("id"), F.col(mark_col).alias("mark"), "event_date", F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(buckets)).cast("int").alias("bucket"))


def merge_partitions(
    incoming: DataFrame, path: str, rejects: str | None = None, id_col: str = "event_id", mark_col: str = "event_fingerprint", buckets: int = BUCKETS
) -> int:
    """Merge a batch of events into date partitions; returns how many distinct events it published.

    An event that is stored on another date with the same fingerprint moves to the date of the row that
    arrived last. Where an event has several fingerprints, in the batch or against what is stored, whatever the
    dates, nothing is published and ``ConflictingEvents`` is raised; with a path for ``rejects``
    the batch's rows of such events are written there instead, and the others are published.
    """
    spark = incoming.sparkSession
    batch = materialise(incoming)
    kinds = "id long, mark string, event_date date, bucket int"
    came = materialise(_ids(batch, id_col, mark_col, buckets).distinct())
    # At most one entry a bucket.
    touched = [r[0] for r in came.select("bucket").distinct().collect()]
    known = stored(spark, f"{path}-ids", kinds).where(F.col("bucket").isin(touched))
    before = materialise(known.join(came.select("id").distinct(), "id", "left_semi").select("id", "mark", "event_date", "bucket"))
    versions = before.union(came.select("id", "mark", "event_date", "bucket")).groupBy("id").agg(F.countDistinct(F.struct("mark")).alias("n"))
    bad = materialise(versions.where("n > 1").select("id"))
    good = batch
    if not bad.isEmpty():
        if rejects is None:
            discard(batch, came, before, bad)
            raise ConflictingEvents("one event id has several fingerprints")
        same = batch[id_col].cast("long") == bad["id"]
        batch.join(bad, same, "left_semi").write.mode("overwrite").parquet(rejects)
        good = batch.join(bad, same, "left_anti")
        before = before.join(bad, "id", "left_anti")
    # At most one entry a date folder; the driver lists those of the table to plan any scan.
    old_dates = {r[0] for r in before.select("event_date").distinct().collect()}
    dates = old_dates | {r[0] for r in good.select("event_date").distinct().collect()}
    existing = stored(spark, path, good.schema).where(F.col("event_date").isin(list(dates))).select(*good.columns)
    merged = materialise(merge_events(existing, good, id_col, mark_col).drop("conflicts"))
    _overwrite(merged, path, "event_date")
    left = {r[0] for r in merged.select("event_date").distinct().collect()}
    for date in old_dates - left:
        delete(spark, f"{path}/event_date={date}")  # all its events have moved
    ours = _ids(merged, id_col, mark_col, buckets).join(came.select("id").distinct(), "id", "left_semi").select("id", "mark", "event_date", "bucket")
    ids = materialise(ours.union(known.join(ours.select("id"), "id", "left_anti").select("id", "mark", "event_date", "bucket")))
    _overwrite(ids, f"{path}-ids", "bucket")
    published = ours.count()
    discard(batch, came, bad, merged, ids)
    return published


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The published batches: batch_id, the watermarks before and behind each, and its rows."""
    return stored(spark, f"{path}-ledger", LEDGER)


def batch_id(lower: tuple[datetime, int] | None, upper: tuple[datetime, int]) -> str:
    """The name of the batch behind one watermark up to another."""
    marks = [*(lower or ("", "")), *upper]
    return hashlib.sha256("|".join(x.isoformat() if isinstance(x, datetime) else str(x) for x in marks).encode()).hexdigest()[:32]


def _record(spark: SparkSession, path: str, *rows: tuple) -> None:
    spark.createDataFrame(list(rows), LEDGER).coalesce(1).write.mode("append").parquet(f"{path}-ledger")


def publish_once(batch: DataFrame, path: str, lower: tuple[datetime, int] | None, upper: tuple[datetime, int], rejects: str | None = None) -> bool:
    """Merge a batch and record it in the ledger; False, and nothing done, if it is recorded already."""
    spark, name = batch.sparkSession, batch_id(lower, upper)
    if not ledger(spark, path).where(F.col("batch_id") == name).isEmpty():
        return False
    rows = merge_partitions(batch, path, rejects)
    _record(spark, path, (name, *(lower or (None, None)), *upper, rows))
    return True


def last_watermark(spark: SparkSession, path: str) -> tuple[datetime, int] | None:
    """Up to where the ledger says that events are published."""
    top = ledger(spark, path).agg(F.max(F.struct("upper_at", "upper_id")).alias("m")).first()["m"]
    return None if top is None else (top["upper_at"], top["upper_id"])


def _publish(rows: DataFrame, path: str, lower: tuple[datetime, int] | None, bounds: list[tuple], rejects: Callable[[str], str] | None) -> None:
    """Publish batches that follow each other (number, upper watermark, rows) in one merge.

    Where events are in conflict the batches are halved, down to the one that has the conflict, so the others are published as one by one.
    """
    mine = rows.where(F.col("_batch").between(bounds[0][0], bounds[-1][0])).drop("_batch")
    if len(bounds) == 1:
        upper = bounds[0][1]
        publish_once(mine, path, lower, upper, rejects(batch_id(lower, upper)) if rejects else None)
        return
    try:
        merge_partitions(mine, path)
    except ConflictingEvents:
        half = len(bounds) // 2
        _publish(rows, path, lower, bounds[:half], rejects)
        _publish(rows, path, bounds[half - 1][1], bounds[half:], rejects)
        return
    lowers = [lower, *(upper for _, upper, _ in bounds[:-1])]
    _record(rows.sparkSession, path, *((batch_id(a, b), *(a or (None, None)), *b, n) for a, (_, b, n) in zip(lowers, bounds)))


def export_batches(events: DataFrame, path: str, size: int, rejects: Callable[[str], str] | None = None, most: int | None = None, together: int = 1_000_000) -> int:
    """Publish what is behind the last watermark in batches of ``size`` rows, in the order of arrival and id; returns their number.

    ``rejects`` gives the path for the conflicts of a batch by its name. At most ``most`` batches are made. All rows are numbered at once, and
    batches of about ``together`` rows in all are merged at once; each has its own row in the ledger. Those that are
    cut off before their rows are written run again.
    """
    spark, lower = events.sparkSession, last_watermark(events.sparkSession, path)
    fresh = materialise(behind(events, lower).withColumn("_at", F.unix_micros(F.col("received_at").cast("timestamp"))))
    if fresh.isEmpty():
        discard(fresh)
        return 0
    placed = running(fresh, "_at", [F.asc("_at"), F.asc("event_id")], {"_batch": F.lit(1)}, second=F.col("event_id"), stored=True)
    rows = materialise(placed.withColumn("_batch", F.floor((F.col("_batch") - 1) / size).cast("long")).drop("_at"))
    discard(fresh)
    last = rows.agg(F.max("_batch")).first()[0] + 1
    count, step = last if most is None else min(most, last), max(1, together // size)
    for first in range(0, count, step):
        part = rows.where(F.col("_batch").between(first, min(first + step, count) - 1))
        top = F.max(F.struct(F.col("received_at").cast("timestamp").alias("at"), "event_id"))
        # At most one row for each ``size`` of ``together`` rows.
        found = part.groupBy("_batch").agg(top.alias("top"), F.countDistinct("event_id").alias("n")).orderBy("_batch").collect()
        bounds = [(r["_batch"], tuple(r["top"]), r["n"]) for r in found]
        _publish(rows, path, lower, bounds, rejects)
        lower = bounds[-1][1]
    discard(rows)
    return count
