"""Batches of events into date partitions: dates that change, conflicts, and batches that run again."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from marketloom.sources import events as store

EVENT = "event_id long, event_fingerprint string, event_date date, received_at timestamp"


def day(k):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=k)


def batch(spark, *rows):
    """Rows (id, fingerprint, day); the arrival is noon of the day unless a fourth value gives another day."""
    at = lambda k: datetime.datetime.combine(day(k), datetime.time(12))
    return spark.createDataFrame([(r[0], r[1], day(r[2]), at(r[-1])) for r in rows], EVENT)


def rows(spark, path):
    found = spark.read.schema(EVENT).parquet(path).select("event_id", "event_fingerprint", "event_date").collect()
    return sorted((r[0], r[1], (r[2] - day(0)).days) for r in found)


def files(path):
    return {os.path.join(at, f): os.path.getmtime(os.path.join(at, f)) for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merge_keeps_rows_of_many_dates(spark, tmp_path):
    date = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") % 60).cast("int"))
    all_rows = spark.range(240).select(F.col("id").alias("event_id"), F.lit("x").alias("event_fingerprint"), date.alias("event_date"), F.current_timestamp().alias("received_at"))
    for part in ("event_id < 120", "event_id >= 120"):
        store.merge_partitions(all_rows.where(part), f"{tmp_path}/e")
    found = spark.read.parquet(f"{tmp_path}/e")
    assert found.count() == found.distinct().count() == 240
    assert found.select("event_date").distinct().count() == 60


def test_an_event_moves_to_its_new_date(spark, tmp_path):
    path = f"{tmp_path}/e"
    store.merge_partitions(batch(spark, (1, "a", 0), (2, "b", 0), (3, "c", 1)), path)
    # Event 3 was alone on its date, so the folder of that date goes.
    store.merge_partitions(batch(spark, (1, "a", 5), (3, "c", 6)), path)
    assert rows(spark, path) == [(1, "a", 5), (2, "b", 0), (3, "c", 6)]
    assert sorted(x for x in os.listdir(path) if x.startswith("event_date")) == [f"event_date={day(k)}" for k in (0, 5, 6)]
    # A row that arrived earlier than what is stored moves nothing.
    store.merge_partitions(batch(spark, (1, "a", 2, 2)), path)
    assert rows(spark, path)[0] == (1, "a", 5)


def test_a_changed_event_is_refused_on_any_date(spark, tmp_path):
    path = f"{tmp_path}/e"
    store.merge_partitions(batch(spark, (1, "a", 0)), path)
    with pytest.raises(store.ConflictingEvents):
        store.merge_partitions(batch(spark, (1, "b", 5), (2, "c", 5)), path)
    assert rows(spark, path) == [(1, "a", 0)]
    assert store.merge_partitions(batch(spark, (1, "b", 5), (2, "c", 5), (3, None, 5), (3, "x", 6)), path, f"{tmp_path}/bad") == 1
    assert rows(spark, path) == [(1, "a", 0), (2, "c", 5)]
    bad = spark.read.parquet(f"{tmp_path}/bad")
    assert sorted((r.event_id, r.event_fingerprint or "") for r in bad.collect()) == [(1, "b"), (3, ""), (3, "x")]


def test_files_of_untouched_dates_and_ids_stay(spark, tmp_path):
    path = f"{tmp_path}/e"
    store.merge_partitions(batch(spark, *((k, "a", k % 5) for k in range(500))), path)
    before = files(path) | files(path + "-ids")
    # What is not touched is not read either: a scan of these would fail.
    kept = [f for f in before if "event_date=2024-01-03" in f]
    for f in kept:
        os.chmod(f, 0o644)
        with open(f, "wb") as out:
            out.write(b"not a parquet file")
    before = files(path) | files(path + "-ids")
    store.merge_partitions(batch(spark, (0, "a", 1), (1000, "a", 0)), path)
    after = files(path) | files(path + "-ids")
    same = {f for f in before if before[f] == after.get(f)}
    assert set(kept) <= after.keys()
    assert {f.split("event_date=")[1][:10] for f in same if "event_date" in f} == {str(day(k)) for k in (2, 3, 4)}
    assert len({f for f in same if "bucket=" in f}) >= 2 * len({f for f in before if "bucket=" in f}) // 3


def test_a_batch_that_is_cut_off_is_published_once(spark, tmp_path, monkeypatch):
    path, source = f"{tmp_path}/e", batch(spark, *((k, "a", k // 4) for k in range(12)))
    assert store.export_batches(source, path, 5, most=1) == 1
    record = store._record
    monkeypatch.setattr(store, "_record", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        store.export_batches(source, path, 5)  # events and ids are stored, the ledger is not
    assert store.ledger(spark, path).count() == 1
    monkeypatch.setattr(store, "_record", record)
    # More has arrived before it runs again.
    assert store.export_batches(source.union(batch(spark, (12, "a", 3))), path, 5) == 2
    assert [r[0] for r in rows(spark, path)] == list(range(13))
    found = store.ledger(spark, path).orderBy("upper_at", "upper_id").collect()
    assert [(r.lower_id, r.upper_id, r.n_rows) for r in found] == [(None, 4, 5), (4, 9, 5), (9, 12, 3)]
    lower, upper = (found[0].upper_at, 4), (found[1].upper_at, 9)
    assert found[1].batch_id == store.batch_id(lower, upper)
    assert not store.publish_once(source, path, lower, upper)  # recognised


def test_batches_are_merged_together_and_conflicts_fall_out(spark, tmp_path, monkeypatch):
    """Batches share merges; a conflict is set aside for its own batch, and without a place for it stops there."""
    source = batch(spark, *((k, "a", k // 4) for k in range(40)), (3, "other", 6, 6))
    merges, merge = [], store.merge_partitions
    monkeypatch.setattr(store, "merge_partitions", lambda *a, **k: merges.append(1) or merge(*a, **k))
    assert store.export_batches(source.where("event_fingerprint = 'a'"), f"{tmp_path}/plain", 5) == 8
    assert len(merges) == 1
    found = store.ledger(spark, f"{tmp_path}/plain").orderBy("upper_at", "upper_id").collect()
    assert [(r.lower_id, r.upper_id, r.n_rows) for r in found] == [(k - 1 if k else None, k + 4, 5) for k in range(0, 40, 5)]
    # Row (3, other) is the first of day 6, so it is in the fifth batch.
    assert store.export_batches(source, f"{tmp_path}/e", 5, rejects=lambda name: f"{tmp_path}/bad-{name}") == 9
    assert [r[:2] for r in rows(spark, f"{tmp_path}/e")] == [(k, "a") for k in range(40)]
    bad = [x for x in os.listdir(tmp_path) if x.startswith("bad-")]
    assert len(bad) == 1 and [r.event_fingerprint for r in spark.read.parquet(f"{tmp_path}/{bad[0]}").collect()] == ["other"]
    assert store.ledger(spark, f"{tmp_path}/e").orderBy("upper_at", "upper_id").collect()[4].n_rows == 4
    with pytest.raises(store.ConflictingEvents):
        store.export_batches(source, f"{tmp_path}/s", 5)
    assert store.ledger(spark, f"{tmp_path}/s").count() == 4
