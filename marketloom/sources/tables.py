"""The logical inputs of the library, taken from the star-schema tables of a data directory."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUTOFF = datetime(2001, 1, 1)
EVENT_CUTOFF = datetime(2024, 1, 25)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("client_id"), F.col("c_acctbal").alias("age"), F.col("c_mktsegment").alias("gender")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("level_2"),
        F.col("p_brand").alias("level_3"),
        (F.col("p_size") == 50).cast("int").alias("is_alcohol"),
        F.col("p_size").alias("level_4"),
        F.col("p_retailprice").alias("netto"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase lines; measures are exact decimals, so sums do not depend on their order."""
    lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    points = F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice") * F.col("l_discount")).otherwise(0.0)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_orderdate").alias("transaction_datetime"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("purchase_sum"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("decimal(18,2)").alias("product_quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("trn_sum_from_iss"),
        points.cast("decimal(18,4)").alias("points_spent"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_discount").alias("line_discount"),
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click, cart (from views) and purchase events with an arrival time and a status."""
    k = F.get_json_object("props", "$.k").cast("int")
    events = read(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view", "purchase"))
    return events.select(
        "event_id",
        F.col("user_id").alias("client_id"),
        F.when(F.col("event_type") == "view", "cart").otherwise(F.col("event_type")).alias("event_type"),
        ((k % 4) * F.lit(0.05)).cast("decimal(5,4)").alias("shown_discount"),
        F.when(F.col("event_type") == "purchase", F.col("value").cast("decimal(12,2)")).alias("purchase_value"),
        F.col("ts").alias("created_at"),
        (F.col("ts") + F.make_dt_interval(hours=k % 7)).alias("received_at"),
        F.when(k % 10 == 0, "UNVERIFIED_MISSING_REQUEST").otherwise("VERIFIED").alias("verification_status"),
        F.md5(F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "props")).alias("event_fingerprint"),
        F.to_date("ts").alias("event_date"),
        k.alias("k"),
    )


#: The same inputs in SQL, to be put before a query.
PURCHASES_SQL = """purchases AS (
  SELECT o_custkey AS client_id, o_orderkey AS transaction_id, o_orderdate AS transaction_datetime,
    CAST(o_totalprice AS DECIMAL(18,2)) AS purchase_sum, l_partkey AS product_id,
    CAST(l_quantity AS DECIMAL(18,2)) AS product_quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS trn_sum_from_iss,
    CAST(CASE WHEN l_discount > 0.05 THEN l_extendedprice * l_discount ELSE 0.0 END AS DECIMAL(18,4)) AS points_spent,
    l_suppkey AS store_id, l_discount AS line_discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
ELIGIBLE_SQL = PURCHASES_SQL + """,
eligible AS (
  SELECT * FROM purchases
  WHERE transaction_datetime >= TIMESTAMP '2001-01-01' - INTERVAL 180 DAY AND transaction_datetime < TIMESTAMP '2001-01-01')"""
PRODUCTS_SQL = """products AS (
  SELECT p_partkey AS product_id, p_type AS level_2, p_brand AS level_3,
    CAST(p_size = 50 AS INTEGER) AS is_alcohol, p_size AS level_4, p_retailprice AS netto FROM part)"""
CLIENTS_SQL = """clients AS (SELECT c_custkey AS client_id, c_acctbal AS age, c_mktsegment AS gender FROM customer)"""
FEEDBACK_SQL = """feedback AS (
  SELECT event_id, user_id AS client_id, CASE WHEN event_type = 'view' THEN 'cart' ELSE event_type END AS event_type,
    CAST((k % 4) * CAST(0.05 AS DOUBLE) AS DECIMAL(5,4)) AS shown_discount,
    CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) END AS purchase_value,
    ts AS created_at, ts + to_hours(k % 7) AS received_at,
    CASE WHEN k % 10 = 0 THEN 'UNVERIFIED_MISSING_REQUEST' ELSE 'VERIFIED' END AS verification_status,
    md5(concat_ws('|', CAST(event_id AS VARCHAR), e.event_type, props)) AS event_fingerprint,
    CAST(ts AS DATE) AS event_date, k
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events) e
  WHERE event_type IN ('click', 'view', 'purchase'))"""
