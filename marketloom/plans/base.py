"""Registration of queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import features
from marketloom.sources import scans, tables
from marketloom.sources.shared import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if there is one."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            SQL[key] = sql
        return f

    return add


def eligible(spark: SparkSession, sf_dir: str, cutoff: datetime = tables.CUTOFF) -> DataFrame:
    """Purchase lines of the 180 days before the cutoff."""
    return scans.interval_scan(tables.purchases(spark, sf_dir), "transaction_datetime", cutoff, 180)


def lines(spark: SparkSession, sf_dir: str, cutoff: datetime = tables.CUTOFF, purchases: DataFrame | None = None) -> DataFrame:
    """Eligible lines with their category and the flag of usable prices; ``purchases``, if given, holds all lines of that time."""
    priced = (F.col("trn_sum_from_iss") > 0) & (F.col("product_quantity") > 0)
    items = tables.products(spark, sf_dir).select("product_id", "level_2")
    found = eligible(spark, sf_dir, cutoff) if purchases is None else scans.interval_scan(purchases, "transaction_datetime", cutoff, 180)
    return found.withColumn("is_valid_for_price", priced).join(items, "product_id")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.item_features(tables.products(spark, sf_dir), lines(spark, sf_dir).drop("level_2"), MARGINS, 0.25)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.user_features(tables.clients(spark, sf_dir), lines(spark, sf_dir), tables.CUTOFF)


def stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines and items, each written once, for queries that read them many times."""
    found = materialise(lines(spark, sf_dir))
    return found, materialise(features.item_features(tables.products(spark, sf_dir), found.drop("level_2"), MARGINS, 0.25))


MARGINS = {"ECONOMY": 0.18, "PROMO": 0.12}

LINES_SQL = f"""{tables.ELIGIBLE_SQL},
{tables.PRODUCTS_SQL},
{tables.CLIENTS_SQL},
lines AS (
  SELECT e.*, p.level_2, p.level_3, trn_sum_from_iss > 0 AND product_quantity > 0 AS is_valid_for_price
  FROM eligible e JOIN products p USING (product_id))"""

RECEIPTS_SQL = """receipts AS (
  SELECT client_id, transaction_id, max(transaction_datetime) AS transaction_datetime, max(purchase_sum) AS receipt_sum,
    count(DISTINCT purchase_sum) AS purchase_sum_variants, max(points_spent) AS points_spent
  FROM lines GROUP BY client_id, transaction_id)"""

RECEIPT_FEATURES_SQL = RECEIPTS_SQL + """,
receipt_sums AS (
  SELECT client_id, count(*) AS total_transactions, CAST(sum(receipt_sum) AS DOUBLE) AS total_spent,
    max(transaction_datetime) AS last_at, CAST(sum(greatest(points_spent, 0)) AS DOUBLE) AS points,
    CAST(sum(greatest(receipt_sum, 0)) AS DOUBLE) AS positive,
    count(*) FILTER (transaction_datetime >= TIMESTAMP '2000-12-25') AS purchases_7d,
    count(*) FILTER (transaction_datetime >= TIMESTAMP '2000-12-02') AS purchases_30d,
    count(*) FILTER (transaction_datetime >= TIMESTAMP '2000-10-03') AS purchases_90d,
    count(DISTINCT CASE WHEN transaction_datetime >= TIMESTAMP '2000-12-02' THEN CAST(transaction_datetime AS DATE) END) AS days30,
    count(*) FILTER (points_spent > 0) AS with_points
  FROM receipts GROUP BY client_id),
receipt_features AS (
  SELECT client_id, total_transactions, total_spent, purchases_7d, purchases_30d, purchases_90d,
    with_points / total_transactions AS promo_sensitivity_proxy, total_spent / total_transactions AS avg_check,
    date_diff('day', CAST(last_at AS DATE), DATE '2001-01-01') AS days_since_last_purchase,
    CASE WHEN days30 > 0 THEN purchases_30d / days30 END AS purchase_frequency_30d,
    CASE WHEN positive + points > 0 THEN least(1.0, points / (positive + points)) ELSE 0.0 END AS redeemed_points_share
  FROM receipt_sums)"""

LINE_FEATURES_SQL = """line_features AS (
  SELECT client_id, CAST(sum(product_quantity) AS DOUBLE) AS total_items, count(DISTINCT level_2) AS category_diversity,
    CASE WHEN sum(product_quantity) FILTER (is_valid_for_price) > 0
      THEN CAST(sum(trn_sum_from_iss) FILTER (is_valid_for_price) AS DOUBLE) / CAST(sum(product_quantity) FILTER (is_valid_for_price) AS DOUBLE) END AS avg_item_price
  FROM lines GROUP BY client_id)"""

CATEGORY_SQL = """category_quantities AS (
  SELECT client_id, level_2, sum(product_quantity) AS category_quantity FROM lines WHERE level_2 IS NOT NULL GROUP BY client_id, level_2),
favourite AS (
  SELECT client_id, level_2 AS favorite_category_l2 FROM category_quantities
  QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY category_quantity DESC, level_2) = 1),
affinity AS (
  SELECT client_id, level_2, CAST(category_quantity AS DOUBLE) / CAST(sum(category_quantity) OVER (PARTITION BY client_id) AS DOUBLE) AS affinity
  FROM category_quantities)"""

AGE_SQL = """bounds AS (SELECT quantile_disc(age, 0.01) AS lo, quantile_disc(age, 0.99) AS hi FROM clients),
ages AS (SELECT client_id, gender, CASE WHEN age IS NOT NULL THEN least(hi, greatest(lo, age)) END AS age FROM clients, bounds)"""

USERS_SQL = f"""{LINES_SQL},
{RECEIPT_FEATURES_SQL},
{LINE_FEATURES_SQL},
{CATEGORY_SQL},
{AGE_SQL},
users AS (
  SELECT client_id, gender, age, coalesce(total_transactions, 0) AS total_transactions, coalesce(total_spent, 0.0) AS total_spent,
    coalesce(purchases_7d, 0) AS purchases_7d, coalesce(purchases_30d, 0) AS purchases_30d, coalesce(purchases_90d, 0) AS purchases_90d,
    promo_sensitivity_proxy, avg_check, days_since_last_purchase, purchase_frequency_30d,
    coalesce(redeemed_points_share, 0.0) AS redeemed_points_share, coalesce(total_items, 0.0) AS total_items,
    coalesce(category_diversity, 0) AS category_diversity, avg_item_price, favorite_category_l2
  FROM ages LEFT JOIN receipt_features USING (client_id) LEFT JOIN line_features USING (client_id) LEFT JOIN favourite USING (client_id))"""

PRICES_SQL = """price_observations AS (
  SELECT product_id, CAST(trn_sum_from_iss AS DOUBLE) / CAST(product_quantity AS DOUBLE) AS unit_price, level_2, level_3
  FROM lines WHERE is_valid_for_price AND CAST(trn_sum_from_iss AS DOUBLE) / CAST(product_quantity AS DOUBLE) > 0),
price_bounds AS (
  SELECT level_2, quantile_disc(unit_price, 0.01) AS lo, quantile_disc(unit_price, 0.99) AS hi FROM price_observations GROUP BY level_2),
filtered AS (
  SELECT o.* FROM price_observations o JOIN price_bounds b USING (level_2) WHERE unit_price BETWEEN lo AND hi)"""

ITEMS_SQL = f"""{LINES_SQL},
{PRICES_SQL},
sales AS (
  SELECT product_id, CAST(sum(product_quantity) AS DOUBLE) AS qty, count(DISTINCT client_id) AS unique_buyers, count(DISTINCT transaction_id) AS transaction_count
  FROM lines GROUP BY product_id),
repeats AS (
  SELECT product_id, count(*) FILTER (n > 1) / count(*) AS repeat_rate
  FROM (SELECT product_id, client_id, count(DISTINCT transaction_id) AS n FROM lines GROUP BY ALL) x GROUP BY product_id),
m1 AS (SELECT product_id, quantile_disc(unit_price, 0.5) AS median_unit_price FROM filtered GROUP BY product_id),
m3 AS (SELECT level_2, level_3, quantile_disc(unit_price, 0.5) AS p3 FROM filtered WHERE level_3 IS NOT NULL GROUP BY ALL),
m2 AS (SELECT level_2, quantile_disc(unit_price, 0.5) AS p2 FROM filtered GROUP BY level_2),
items AS (
  SELECT p.product_id, p.level_2, p.level_3, p.level_4, p.is_alcohol, p.netto,
    coalesce(qty, 0.0) AS total_sales_qty, coalesce(unique_buyers, 0) AS unique_buyers, coalesce(transaction_count, 0) AS transaction_count,
    coalesce(repeat_rate, 0.0) AS repeat_rate, median_unit_price,
    row_number() OVER (PARTITION BY p.level_2 ORDER BY coalesce(qty, 0.0) DESC, coalesce(unique_buyers, 0) DESC, p.product_id) AS popularity_rank_l2,
    coalesce(median_unit_price, p3, p2) AS unit_price,
    CASE WHEN median_unit_price IS NOT NULL THEN 'item' WHEN p3 IS NOT NULL THEN 'level_3' WHEN p2 IS NOT NULL THEN 'level_2' ELSE 'missing' END AS price_source,
    CASE p.level_2 WHEN 'ECONOMY' THEN 0.18 WHEN 'PROMO' THEN 0.12 ELSE 0.25 END::DOUBLE AS margin_rate,
    coalesce(median_unit_price, p3, p2) IS NOT NULL AS is_price_available
  FROM products p LEFT JOIN sales USING (product_id) LEFT JOIN repeats USING (product_id) LEFT JOIN m1 USING (product_id)
    LEFT JOIN m3 ON p.level_2 = m3.level_2 AND p.level_3 = m3.level_3 LEFT JOIN m2 ON p.level_2 = m2.level_2)"""
