"""Sinks: Parquet, rejects, checked snapshots, lineage, run records, served lists."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_sink(frame: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Write snappy Parquet; an existing target is an error."""
    frame.write.mode("errorifexists").option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def lineage_stamp(frame: DataFrame, run_id: str, at: datetime, **more: Any) -> DataFrame:
    """Add the run, its time and further literals."""
    return frame.withColumns(
        {"run_id": F.lit(run_id), "processed_at": F.lit(at).cast("timestamp")} | {k: F.lit(v) for k, v in more.items()}
    )


def reject_rows(frame: DataFrame, reasons: Column, run_id: str, at: datetime) -> DataFrame:
    """Rows that have a reason, with the array of all their reasons and the run."""
    marked = frame.withColumn("reason_codes", reasons)
    return lineage_stamp(marked.where(F.size("reason_codes") > 0), run_id, at)


def reject_sink(rejects: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    rejects.write.mode("append").partitionBy(*partition_by).parquet(path)


def snapshot_publish(frame: DataFrame, base: str, snapshot: str, keys: list[str], run_id: str, at: datetime) -> str:
    """Write a snapshot aside, check it, and then point to it.

    The data of a run has a path of its own. A row in the pointer table, written last,
    makes it the current one, so a run that fails leaves the old snapshot in place.
    """
    spark = frame.sparkSession
    path = f"{base}/data/{snapshot}/{run_id}-{uuid.uuid4().hex[:8]}"
    frame.write.mode("errorifexists").parquet(path)
    written = spark.read.parquet(path)
    rows, distinct = written.agg(F.count(F.lit(1)), F.countDistinct(F.struct(*keys))).first()
    if rows == 0 or rows != distinct:
        raise ValueError(f"{snapshot}: {rows} rows, {distinct} keys")
    pointer = spark.createDataFrame([(snapshot, path, run_id, rows, at)], "snapshot string, path string, run_id string, n_rows long, published_at timestamp")
    pointer.coalesce(1).write.mode("append").parquet(f"{base}/pointers")
    return path


def current_snapshot(spark: SparkSession, base: str, snapshot: str) -> DataFrame:
    """The data that the newest pointer of a snapshot names."""
    pointers = spark.read.parquet(f"{base}/pointers").where(F.col("snapshot") == snapshot)
    return spark.read.parquet(pointers.orderBy(F.desc("published_at"), F.desc("run_id")).first()["path"])


def run_metadata(spark: SparkSession, path: str, run_id: str, inputs: Mapping[str, str], params: Mapping[str, str], metrics: Mapping[str, float]) -> DataFrame:
    """One JSON record per run."""
    row = [(run_id, dict(inputs), dict(params), {k: float(v) for k, v in metrics.items()})]
    record = spark.createDataFrame(row, "run_id string, inputs map<string,string>, params map<string,string>, metrics map<string,double>")
    record.coalesce(1).write.mode("append").json(path)
    return record


def serving_payload(ranked: DataFrame, client: str, rank: str, fields: list[str]) -> DataFrame:
    """One JSON list per client, in the order of the rank."""
    items = F.sort_array(F.collect_list(F.struct(rank, *fields)))
    listed = F.transform(items, lambda x: F.struct(*(x[f].alias(f) for f in fields), x[rank].alias("rank")))
    return ranked.groupBy(client).agg(F.to_json(listed).alias("payload"), F.count(F.lit(1)).alias("n_items"))


def payload_sizes(ranked: DataFrame, client: str, rank: str, fields: list[str], top: int) -> DataFrame:
    """Bytes of all payloads when lists are cut at 1 to ``top``; one pass, one row per cut."""
    items = ranked.where(F.col(rank) <= top).groupBy(client).agg(F.sort_array(F.collect_list(F.struct(rank, *fields))).alias("_i"))
    listed = F.transform("_i", lambda x: F.struct(*(x[f].alias(f) for f in fields), x[rank].alias("rank")))
    sizes = [F.sum(F.octet_length(F.to_json(F.slice("_l", 1, n)))).alias(str(n)) for n in range(1, top + 1)]
    return items.select(listed.alias("_l")).agg(*sizes).unpivot([], [str(n) for n in range(1, top + 1)], "top_n", "bytes").select(F.col("top_n").cast("int").alias("top_n"), "bytes")


def fit_top_n_budget(ranked: DataFrame, client: str, rank: str, fields: list[str], top: int, limit: int, overhead: float = 1.0) -> DataFrame:
    """Every cut with its bytes, whether it fits, and the largest that does."""
    sizes = payload_sizes(ranked, client, rank, fields, top).withColumn("estimated", (F.col("bytes") * overhead).cast("long"))
    chosen = sizes.agg(F.max(F.when(F.col("estimated") <= limit, F.col("top_n"))).alias("chosen"))
    return sizes.join(F.broadcast(chosen), how="cross").select("top_n", "bytes", (F.col("estimated") <= limit).alias("fits"), (F.col("top_n") == F.col("chosen")).alias("is_chosen"))


def fallback_list(items: DataFrame, n: int) -> DataFrame:
    """The most popular unrestricted items, with a score that falls from 1 in equal steps."""
    top = items.where("is_alcohol = 0").orderBy(F.desc("unique_buyers"), F.desc("total_sales_qty"), "product_id").limit(n)
    listed = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("unique_buyers")).alias("a"), (-F.col("total_sales_qty")).alias("b"), "product_id"))).alias("l"))
    return listed.select(F.posexplode("l").alias("i", "x")).select(
        F.col("x.product_id").alias("product_id"), (F.col("i") + 1).alias("rank"), (1 - F.col("i") / F.lit(float(n))).alias("score")
    )
