"""Quantiles against sorted lists: many values, common ones, missing ones and groups of one row."""

from __future__ import annotations

import random
from fractions import Fraction
from math import ceil

from pyspark.sql import functions as F

from marketloom.operators import evaluation, features, quality
from marketloom.operators.distributed import quantiles


def disc(values, q):
    held = sorted(v for v in values if v is not None)
    return held[max(1, ceil(len(held) * Fraction(q))) - 1] if held else None


def test_quantiles_of_groups(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, 1.0, 1.0, rnd.random()])) for _ in range(4000)] + [("c", 5.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.low, r.mid, r.high) for r in quantiles(df, "v", {"low": "0.01", "mid": "0.5", "high": "0.99"}, ["g"]).collect()}
    assert got == {g: tuple(disc([v for k, v in rows if k == g], q) for q in ("0.01", "0.5", "0.99")) for g in ("a", "b", "c", None)}
    assert [tuple(r) for r in quantiles(df.where("v IS NULL"), "v", {"x": "0.5"}).collect()] == [(None,)]


def test_bounds_of_many_values_are_exact(spark):
    """Summaries with 10,000 places are off here by some places."""
    values = [float(k * 7919 % 300_007) for k in range(300_007)]
    df = spark.range(0, 300_007, numPartitions=16).select(F.col("id").alias("product_id"), (F.col("id") * 7919 % 300_007).cast("double").alias("v"))
    low, high = disc(values, "0.01"), disc(values, "0.99")
    assert df.transform(features.winsorize, "v").agg(F.min("v"), F.max("v")).first() == (low, high)
    prices = df.select("product_id", F.col("v").alias("unit_price"), F.lit("x").alias("level_2"), (F.col("product_id") % 2).cast("string").alias("level_3"))
    kept = features.price_outlier_filter(prices)
    assert kept.agg(F.min("unit_price"), F.max("unit_price")).first() == (low, high)
    medians = {(r._set, r.level_3): r.median_price for r in features.hierarchical_median_price(prices).where("_set > 3").collect()}
    assert medians == {(5, None): disc(values, "0.5"), (4, "0"): disc(values[::2], "0.5"), (4, "1"): disc(values[1::2], "0.5")}
    found = evaluation.overlap_diagnostics(df.select((F.col("v") / 300_007).alias("score"))).first()
    assert found.p05 == disc(values, "0.05") / 300_007


def test_quality_deals_rows_to_partitions_that_follow_them(spark, monkeypatch):
    monkeypatch.setattr(quality, "BUCKET_ROWS", 100)
    rows = spark.range(2000).selectExpr("id", "timestamp'2000-01-01' AS transaction_datetime", "array() AS reason_codes", "true AS is_valid_for_price").union(spark.range(1).selectExpr("id", "timestamp'2000-01-01'", "array()", "true"))
    out = quality.quality_by_month(rows.withColumn("reason_codes", F.col("reason_codes").cast("array<string>")), ["A"])
    assert "hashpartitioning(id" in (plan := out._jdf.queryExecution().executedPlan().toString()) and ", 21), REPARTITION_BY_NUM" in plan
    assert (r := out.first()).rows_in == 2001 and r.duplicate_rows == 1
