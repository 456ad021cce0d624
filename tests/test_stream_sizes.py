"""Streams over many ids and over years."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from conftest import SF
from marketloom.plans import registry
from marketloom.streaming import feedback
from test_oracle import connect


def test_versions_keep_ids_by_bucket(spark, tmp_path):
    rows = spark.range(300).select(F.col("id").alias("event_id"), (F.col("id") % 5).cast("string").alias("event_fingerprint"), F.lit(datetime.datetime(2024, 1, 1)).alias("received_at"))
    again = rows.where("event_id % 3 = 0").withColumns({"event_fingerprint": F.lit("1"), "received_at": F.lit(datetime.datetime(2024, 1, 2))})
    for part in (rows, again):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = feedback.stream_feedback_ingest(spark, f"{tmp_path}/in", rows.schema, 1)
    feedback.run_to_table(feedback.stream_versions(stream, "40 days", datetime.timedelta(days=20), buckets=4), f"{tmp_path}/out", f"{tmp_path}/ck")
    found = sorted((r.event_id, r.n_seen, r.status) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    want = [(k, 1, "new") for k in range(300)] + [(k, 2, "duplicate" if k % 5 == 1 else "conflict") for k in range(0, 300, 3)]
    assert found == sorted(want)
    assert spark.read.format("statestore").load(f"{tmp_path}/ck").count() <= 4


def test_lists_of_events_over_years(spark, tmp_path):
    """The last events come out too where the tables span more than the later rows reach."""
    events = spark.read.parquet(f"{SF}/events.parquet").limit(300)
    shifted = [events.withColumns({"event_id": F.col("event_id") + k * 1_000_000, "ts": F.col("ts") + F.make_interval(years=F.lit(2 * k))}) for k in (-1, 1)]
    shifted[0].unionByName(shifted[1]).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = sorted((r.event_id, r.status) for r in registry.QUERIES["stream_verify_lists"](spark, str(tmp_path)).collect())
    duck = connect(SF)
    duck.execute(f"create or replace view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert got == sorted(duck.execute(registry.SQL["stream_verify_lists"]).fetchall())
