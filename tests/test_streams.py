"""The feedback streams: conflicts, restarts, verification against a stream of lists, the merge."""

from __future__ import annotations

import datetime

import pytest

from marketloom.sources import contracts
from marketloom.streaming import feedback

EVENT = "event_id long, event_fingerprint string, created_at timestamp, received_at timestamp"
START = datetime.datetime(2024, 1, 1)


def write(spark, folder, rows):
    """Rows (id, fingerprint, days) as one file."""
    at = lambda k: START + datetime.timedelta(days=k)
    spark.createDataFrame([(i, f, at(k), at(k)) for i, f, k in rows], EVENT).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, rejects=None):
    stream = feedback.stream_feedback_ingest(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, 1)
    feedback.stream_partition_merge(stream, f"{tmp_path}/out", f"{tmp_path}/ck", rejects).awaitTermination()


def versions(spark, tmp_path, delay="40 days", keep=20):
    stream = feedback.stream_feedback_ingest(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, 1)
    feedback.run_to_table(feedback.stream_versions(stream, delay, datetime.timedelta(days=keep)), f"{tmp_path}/out", f"{tmp_path}/ck")
    return sorted((r.event_id, r.event_fingerprint, r.status, r.n_seen) for r in spark.read.parquet(f"{tmp_path}/out").collect())


def test_versions_across_midnight_batches_and_restarts(spark, tmp_path):
    half_hour = 1 / 48
    write(spark, f"{tmp_path}/in", [(1, "a", 1 - half_hour), (1, "b", 1 + half_hour), (2, "a", 0), (2, "a", 0.5), (3, None, 0)])
    first = [(1, "a", "new", 1), (1, "b", "conflict", 2), (2, "a", "duplicate", 2), (2, "a", "new", 1), (3, None, "new", 1)]
    assert versions(spark, tmp_path) == sorted(first, key=str)
    write(spark, f"{tmp_path}/in", [(2, "c", 3), (3, None, 3), (4, "d", 3)])
    write(spark, f"{tmp_path}/in", [(1, "a", 4), (4, "e", 4)])
    # A new query goes on from the checkpoint.
    more = [(2, "c", "conflict", 3), (3, None, "duplicate", 2), (4, "d", "new", 1), (1, "a", "duplicate", 3), (4, "e", "conflict", 2)]
    assert sorted(versions(spark, tmp_path), key=str) == sorted(first + more, key=str)
    assert sorted(versions(spark, tmp_path), key=str) == sorted(first + more, key=str)


def test_versions_are_dropped_after_their_time(spark, tmp_path):
    # With a watermark of an hour and ten days to keep: day 30 drops id 1, and not id 2, which came again.
    for rows in ([(1, "a", 0), (2, "a", 0)], [(2, "a", 9)], [(3, "a", 18)], [(4, "a", 18.5)], [(1, "b", 18.6), (2, "b", 18.6)]):
        write(spark, f"{tmp_path}/in", rows)
        found = versions(spark, tmp_path, "1 hour", 10)
    assert (1, "b", "new", 1) in found
    assert (2, "b", "conflict", 3) in found


def test_conflicts_publish_nothing(spark, tmp_path):
    write(spark, f"{tmp_path}/in", [(1, "a", 0), (2, "b", 1)])
    run(spark, tmp_path)
    write(spark, f"{tmp_path}/in", [(1, "other", 5), (3, "c", 2)])
    with pytest.raises(Exception, match="several fingerprints"):
        run(spark, tmp_path)
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]


def test_conflicts_can_be_set_aside(spark, tmp_path):
    write(spark, f"{tmp_path}/in", [(1, "a", 0), (2, "b", 1)])
    run(spark, tmp_path, f"{tmp_path}/bad")
    write(spark, f"{tmp_path}/in", [(1, "other", 3), (3, "c", 2), (4, "d", 2), (4, "e", 2)])
    run(spark, tmp_path, f"{tmp_path}/bad")
    stored = {(r.event_id, r.event_fingerprint) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert stored == {(1, "a"), (2, "b"), (3, "c")}
    bad = {(r.event_id, r.event_fingerprint) for r in spark.read.parquet(f"{tmp_path}/bad").collect()}
    assert bad == {(1, "other"), (4, "d"), (4, "e")}


LIST = "request_id string, client_id long, payload string, shown_at timestamp"
CLICK = "event_id long, request_id string, client_id long, product_id long, shown_discount double, created_at timestamp"


def test_lists_that_arrive_as_a_stream(spark, tmp_path):
    at = lambda h: START + datetime.timedelta(hours=h)
    shown = '[{"product_id": 7, "discount": 0.1}]'
    put = lambda kind, schema, *rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{kind}")

    def result():
        read = lambda kind, schema: spark.readStream.schema(schema).parquet(f"{tmp_path}/{kind}")
        found = feedback.stream_verify(read("clicks", CLICK), read("lists", LIST), "1 day", "2 hours")
        feedback.run_to_table(found.select("event_id", "status"), f"{tmp_path}/out", f"{tmp_path}/ck")
        return {r.event_id: r.status for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    # Event 1 after its list, event 2 before its list is there, 3 never, 4 with another product, 5 too long after its list.
    put("lists", LIST, ("a", 1, shown, at(0)), ("d", 1, shown, at(0)), ("e", 1, shown, at(0)))
    put("clicks", CLICK, (1, "a", 1, 7, 0.1, at(1)), (2, "b", 1, 7, 0.1, at(1)), (3, "c", 1, 7, 0.1, at(1)), (4, "d", 1, 8, 0.1, at(1)), (5, "e", 1, 7, 0.1, at(25)))
    found = result()
    assert found == {1: "VERIFIED", 4: "REJECTED_MISMATCH"}
    put("lists", LIST, ("b", 1, shown, at(0.5)))
    assert result() == found | {2: "VERIFIED"}
    # Both watermarks pass, and what has no list is given out; the state of all of them is gone.
    put("lists", LIST, ("z", 1, shown, at(100)))
    put("clicks", CLICK, (9, "z", 2, 7, 0.1, at(100)))
    result()
    put("lists", LIST, ("y", 1, shown, at(101)))
    put("clicks", CLICK, (10, "y", 1, 7, 0.1, at(101)))
    done = result()
    assert {k: done[k] for k in (1, 2, 3, 4, 5)} == {1: "VERIFIED", 2: "VERIFIED", 3: "UNVERIFIED_MISSING_REQUEST", 4: "REJECTED_MISMATCH", 5: "UNVERIFIED_MISSING_REQUEST"}


def test_broken_contracts_raise():
    with pytest.raises(ValueError):
        contracts.REGISTRY["uplift_train"].require_columns(["client_id"])
