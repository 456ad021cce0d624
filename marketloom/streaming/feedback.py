"""The feedback loop as streams: bounded ingestion, de-duplication, verification, merge."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marketloom.sources import events as store

SHOWN = T.ArrayType(T.StructType([T.StructField("product_id", T.LongType()), T.StructField("discount", T.DoubleType())]))


def stream_feedback_ingest(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 8) -> DataFrame:
    """New event files in bounded batches; progress moves on only when a batch is done."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _timed(events: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermark a time column, which must be an instant."""
    return events.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def stream_dedup(events: DataFrame, delay: str = "2 hours") -> DataFrame:
    """One row per event and fingerprint; state is dropped behind the watermark.

    An id with another fingerprint passes, to be found as a conflict by the merge.
    """
    return _timed(events, "received_at", delay).dropDuplicatesWithinWatermark(["event_id", "event_fingerprint"])


#: The ids of a bucket as an Arrow file: id, first fingerprint, rows so far, and when each is dropped (milliseconds).
STATE = "held binary"
VERSIONS = "event_id long, event_fingerprint string, received_at timestamp, status string, n_seen long"
#: Buckets of ids in the state of ``stream_versions``.
BUCKETS = 1024
HELD = pa.schema([("first", pa.string()), ("seen", pa.int64()), ("expires", pa.int64()), ("event_id", pa.int64())])
_STORE, _ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, which keyed state with timers needs.

    A stream takes the setting when it starts, and from its checkpoint when it starts again.
    """
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


class Versions:
    """Per event id the first fingerprint, how many rows came, and when the last one arrived.

    An id is dropped once the watermark is ``keep`` behind its last arrival, so the state holds only ids that
    came within that time, wherever days and batches begin. Ids are kept by bucket, as a call of Python for each id costs
    over a hundred times what its rows do.
    """

    def __init__(self, keep: timedelta) -> None:
        self.keep = int(keep.total_seconds() * 1000)

    def __call__(self, key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else pd.DataFrame({"first": pd.Series(dtype=object), "seen": pd.Series(dtype="int64"), "expires": pd.Series(dtype="int64")}, index=pd.Index([], dtype="int64", name="event_id"))
        if not state.hasTimedOut:
            # Within a batch, in the order of arrival; ties in that of the fingerprint.
            came = pd.concat(list(rows)).sort_values(["event_id", "received_at", "event_fingerprint"], kind="stable", na_position="last", ignore_index=True)
            ids = came["event_id"]
            before, turn = held.reindex(ids.to_numpy()), came.groupby("event_id").cumcount().to_numpy()
            known = before["seen"].notna().to_numpy()
            mark = came["event_fingerprint"].astype(object).where(came["event_fingerprint"].notna(), None).to_numpy()
            starts = np.maximum.accumulate(np.where(turn == 0, np.arange(len(came)), 0))
            first = np.where(known, before["first"].astype(object).where(before["first"].notna(), None).to_numpy(), mark[starts])
            seen = before["seen"].fillna(0).to_numpy().astype("int64") + turn + 1
            status = np.where(~known & (turn == 0), "new", np.where(mark == first, "duplicate", "conflict"))
            expires = np.maximum(before["expires"].fillna(0).to_numpy().astype("int64"), came["_ms"].fillna(0).to_numpy().astype("int64") + self.keep)
            last = np.append(starts[1:] != starts[:-1], True)
            now = pd.DataFrame({"first": first[last], "seen": seen[last], "expires": np.maximum.reduceat(expires, np.flatnonzero(turn == 0))}, index=pd.Index(ids.to_numpy()[last], name="event_id"))
            held = now if held.empty else pd.concat([held[~held.index.isin(now.index)], now])
            yield pd.DataFrame({"event_id": ids, "event_fingerprint": mark, "received_at": came["received_at"], "status": status, "n_seen": seen})
        held = held[held["expires"] > state.getCurrentWatermarkMs()]
        if held.empty:
            if state.exists:
                state.remove()
            return
        batch = pa.RecordBatch.from_pandas(held, HELD)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        state.update((sink.getvalue().to_pybytes(),))
        state.setTimeoutTimestamp(int(held["expires"].min()))


def stream_versions(events: DataFrame, delay: str = "2 hours", keep: timedelta = timedelta(days=30), buckets: int = BUCKETS) -> DataFrame:
    """Every row with what it is: new, a duplicate of the first row of its id, or in conflict with it.

    Appended as rows come; see ``VERSIONS``. Rows whose arrival is behind the watermark (``delay``) are late and left
    out; an id that did not come for ``keep`` is new when it comes again. Start it inside ``keyed_state``. The number of buckets
    belongs to a checkpoint; with more ids in the state, take more of them, as each is read and written whole when one of its ids comes.
    """
    number = F.coalesce(F.col("event_id").cast("long"), F.raise_error(F.lit("an event has no id")).cast("long"))
    rows = _timed(events, "received_at", delay).select(number.alias("event_id"), "event_fingerprint", "received_at", F.unix_millis("received_at").alias("_ms"))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64("event_id"), F.lit(buckets))).groupBy("_bucket")
    return dealt.applyInPandasWithState(Versions(keep), VERSIONS, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def stream_conflicts(events: DataFrame, delay: str = "2 hours", keep: timedelta = timedelta(days=30)) -> DataFrame:
    """The rows whose fingerprint differs from the first one of their event id."""
    return stream_versions(events, delay, keep).where("status = 'conflict'")


def _status(found: Column, shown: Column) -> Column:
    """What a match of an event with a list is: ``found`` is the list's client, ``shown`` its entries."""
    fits = F.exists(shown, lambda x: (x["product_id"] == F.col("product_id")) & (x["discount"] == F.col("shown_discount")))
    return (
        F.when(found.isNull(), "UNVERIFIED_MISSING_REQUEST")
        .when((found == F.col("client_id")) & F.coalesce(fits, F.lit(False)), "VERIFIED")
        .otherwise("REJECTED_MISMATCH")
    )


def verify(events: DataFrame, predictions: DataFrame) -> DataFrame:
    """Match events to the lists that were shown, by request, client, product and exact discount."""
    shown = predictions.select("request_id", F.col("client_id").alias("_client"), F.from_json("payload", SHOWN).alias("_shown"))
    joined = events.join(shown, "request_id", "left")
    return joined.withColumn("status", _status(F.col("_client"), F.col("_shown"))).drop("_client", "_shown")


def stream_verify(events: DataFrame, predictions: DataFrame, within: str = "1 day", delay: str = "2 hours", shown_col: str = "shown_at") -> DataFrame:
    """The same where the lists are a stream too (request_id, client_id, payload, and when each was shown).

    An event matches a list that was shown at most ``within`` before it was created. Both streams have a watermark, so the
    state holds what came within these times: an event that comes before its list waits for it, and one whose list never comes
    is given out as missing once the watermarks have passed. Rows that are late by more than ``delay`` are left out. Each request has one list.
    """
    left = _timed(events, "created_at", delay).alias("e")
    right = _timed(predictions, shown_col, delay).select(
        F.col("request_id").alias("_request"), F.col("client_id").alias("_client"), F.from_json("payload", SHOWN).alias("_shown"), F.col(shown_col).alias("_at")
    )
    near = (F.col("_at") <= F.col("created_at")) & (F.col("_at") >= F.col("created_at") - F.expr(f"INTERVAL {within}"))
    joined = left.join(right, (F.col("request_id") == F.col("_request")) & near, "left_outer")
    return joined.withColumn("status", _status(F.col("_client"), F.col("_shown"))).drop("_request", "_client", "_shown", "_at")


def stream_late_audit(events: DataFrame, cutoff: datetime, days: int, delay: str = "12 hours") -> DataFrame:
    """Events created in the window, by whether they arrived before the cutoff."""
    start = cutoff - timedelta(days=days)
    rows = _timed(events, "created_at", delay).where((F.col("created_at") >= F.lit(start)) & (F.col("created_at") < F.lit(cutoff)))
    return rows.groupBy((F.col("received_at") >= F.lit(cutoff)).alias("is_late")).agg(F.count(F.lit(1)).alias("n_events"))


def stream_partition_merge(events: DataFrame, path: str, checkpoint: str, rejects: str | None = None) -> StreamingQuery:
    """Merge every batch into date partitions, once.

    Each batch is recorded in the ledger under its first and last arrival, after its events are stored: one
    that runs again is recognised, and one that was cut off before that is merged again, which changes
    nothing. Where one event id has several fingerprints, in a batch or against what is stored on any date, nothing
    of the batch is published and an error is raised. With a ``rejects`` path, the batch's rows of
    such ids go there instead, under the number of the batch, and the others are merged.
    """

    def merge(batch: DataFrame, number: int) -> None:
        held = batch.drop("event_date").withColumn("event_date", F.to_date("created_at"))
        mark = F.struct(F.col("received_at").cast("timestamp").alias("at"), F.col("event_id").cast("long").alias("id"))
        first, last = held.agg(F.min(mark), F.max(mark)).first()
        if first is not None:
            store.publish_once(held, path, tuple(first), tuple(last), f"{rejects}/batch={number}" if rejects else None)

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(frame: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over all that is there and write Parquet, or the last state of an aggregate."""
    writer = frame.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        with keyed_state(frame.sparkSession):
            query = writer.format("parquet").option("path", path).outputMode("append").start()
    else:
        query = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).outputMode(mode).start()
    query.awaitTermination()
