"""Literal cases of the operators, and random cases against plain loops."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketloom.operators import datasets, distributed, evaluation, pricing, quality, ranking
from marketloom.sources import contracts, scans, sinks


def greedy(rows, budget, cap):
    spent, held, out = 0, {}, []
    for r in sorted(rows, key=lambda r: (-r[2], -r[3], r[4], r[0], r[1])):
        if held.get(r[0], 0) >= cap:
            d = "USER_CAP_REJECTED"
        elif spent + r[4] <= budget:
            d, spent, held[r[0]] = "DISCOUNT_ACCEPTED", spent + r[4], held.get(r[0], 0) + 1
        else:
            d = "BUDGET_REJECTED"
        out.append((r[0], r[1], d, len(out) + 1, float(spent)))
    return sorted(out)


def allocate(spark, rows, budget, cap):
    df = spark.createDataFrame(rows, "client_id long, product_id long, roi double, incremental_profit double, cost double")
    out = distributed.budget_allocation(df, budget, cap).collect()
    return sorted((r.client_id, r.product_id, r.optimizer_decision, r.allocation_rank, float(r.budget_spent_after)) for r in out)


def test_budget_literal(spark):
    rows = [(1, 1, 4.0, 1.0, 6.0), (1, 2, 3.0, 1.0, 4.0), (2, 3, 2.0, 1.0, 5.0), (3, 4, 1.0, 1.0, 3.0)]
    got = allocate(spark, rows, 10.0, 1)
    assert [g[2] for g in sorted(got, key=lambda g: g[3])] == ["DISCOUNT_ACCEPTED", "USER_CAP_REJECTED", "BUDGET_REJECTED", "DISCOUNT_ACCEPTED"]
    assert [g[4] for g in sorted(got, key=lambda g: g[3])] == [6.0, 6.0, 6.0, 9.0]


@pytest.mark.parametrize("seed", [1, 2])
def test_budget_random(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(12), i, float(rnd.randrange(5)), float(rnd.randrange(4)), float(rnd.randrange(1, 30))) for i in range(80)]
    assert allocate(spark, rows, 150.0, 2) == greedy(rows, 150.0, 2)


def test_budget_rejects_bad_cost(spark):
    with pytest.raises(ValueError):
        allocate(spark, [(1, 1, 1.0, 1.0, -1.0)], 10.0, 1)


@pytest.mark.parametrize("values", [[5.0], [1.0, 1.0, 1.0], [3.0, 1.0, 2.0, 2.0, None]])
def test_percent_rank(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    df.createOrReplaceTempView("t")
    want = {r.id: r.p for r in spark.sql("select id, percent_rank() over (order by v) p from t").collect()}
    got = {r.id: r.p for r in distributed.global_percent_rank(df, "v", "p").collect()}
    assert {k: v for k, v in got.items() if values[k] is not None or True} == want


def test_tolerant_argmax(spark):
    opts = spark.createDataFrame([(1, 0.05, 1.0), (1, 0.10, 1.009), (2, 0.05, 1.0), (2, 0.10, 1.02)], "k int, d double, g double")
    got = {r.k: r.d for r in pricing.tolerant_argmax(opts, ["k"], "g", "d", 0.01).collect()}
    assert got == {1: 0.05, 2: 0.10}


def test_scenarios_and_burst(spark):
    policy = pricing.SimulationPolicy(grid=(0.0, 0.05), multipliers=(0.0, 1.0), relevance_floor=1.0, relevance_weight=0.0)
    pair = spark.createDataFrame([(1, 1, 0.2, 0.1, 100.0, 0.25, True, 0.5)], "client_id int, product_id int, p_base_purchase double, uplift_score double, unit_price double, margin_rate double, is_price_available boolean, recsys_score double")
    row = pricing.discount_scenarios(pair, policy).where("discount > 0").first()
    assert (round(row.expected_profit, 9), round(row.expected_discount_cost, 9), round(row.incremental_profit, 9), round(row.roi, 9)) == (6.0, 1.5, 1.0, round(2 / 3, 9))
    assert round(spark.range(1).select(pricing.burst(F.lit(3), F.lit(6))).first()[0], 9) == 1.6


def test_reason_codes(spark):
    rows = [(0, 0.1, ["global_popular"]), (1, 0.1, ["repeat_purchase"]), (1, 0.0, ["repeat_purchase", "category_popular"]), (1, 0.0, ["category_popular"]), (1, 0.0, ["item_to_item"])]
    df = spark.createDataFrame(rows, "t int, d double, s array<string>")
    got = [r[0] for r in df.select(ranking.reason_code(F.col("t"), F.col("d"), F.col("s"))).collect()]
    assert got == ["COLD_START_POPULAR", "HIGH_INCREMENTAL_PROFIT", "REPEAT_PURCHASE", "CATEGORY_RELEVANCE", "ORGANIC_PURCHASE_NO_DISCOUNT"]


def test_calibration_and_quota(spark):
    scored = spark.createDataFrame([(0, 0.0), (1, 0.55), (1, 1.0)], "label int, score double")
    got = {r.bin: (r.n, r.mean_score) for r in evaluation.calibration_bins(scored, 2).collect()}
    assert got == {0: (1, 0.0), 1: (2, 0.775)}
    labels = spark.createDataFrame([(0,)] * 90 + [(1,)] * 10, "label int")
    assert {r.label: r.quota for r in datasets.label_quotas(labels, 20).collect()} == {0: 18, 1: 2}


def test_uplift_curve(spark):
    rows = spark.createDataFrame([(1, 1, 1, 0.9), (2, 0, 0, 0.8), (3, 0, 1, 0.2), (4, 1, 0, 0.1)], "id int, label int, treatment int, score double")
    curve = evaluation.uplift_curve(rows)
    assert curve.orderBy(F.desc("rows")).first().gain == 0.0
    area = evaluation.auuc_qini(curve).first()
    assert area.auuc == area.qini
    got = {r.fraction: r.uplift for r in evaluation.uplift_at_k(rows, (0.5, 1.0)).collect()}
    assert got == {0.5: 1.0, 1.0: 0.0}


def test_smd(spark):
    rows = [(0, 10 - 2.0**0.5), (0, 10 + 2.0**0.5), (1, 12 - 2.0**0.5), (1, 12 + 2.0**0.5)]
    got = datasets.smd_report(spark.createDataFrame(rows, "treatment int, x double"), ["x"]).first()
    assert round(got.smd, 6) == 1.0 and got.warning == "SMD_ABOVE_THRESHOLD"


def test_conflicts_and_typing(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)], "k string, v int")
    good, bad = quality.pk_conflict_split(df, ["k"])
    assert good.count() == 1 and bad.count() == 2
    contract = contracts.Contract("x", (contracts.Field("a", "integer", allowed=(0, 1)), contracts.Field("t", "timestamp", nullable=True)))
    (tmp_path / "x.csv").write_text("a,t\n1,2001-01-01 00:00:00\n 2 ,junk\n,\n")
    rows = scans.typed_scan(spark, str(tmp_path / "x.csv"), contract, datetime(2001, 1, 1)).collect()
    assert [(r.a, r[scans.BAD + "a"], r[scans.BAD + "t"]) for r in rows] == [(1, False, False), (2, True, True), (None, True, False)]
    with pytest.raises(ValueError):
        scans.typed_scan(spark, str(tmp_path / "x.csv"), contracts.REGISTRY["uplift_test"], datetime(2001, 1, 1))


def test_months_and_snapshot(spark, tmp_path):
    assert scans.overlapping_months(datetime(2018, 9, 2), datetime(2019, 3, 1))[0::5] == ["2018-09", "2019-02"]
    good = spark.range(3).withColumnRenamed("id", "k")
    sinks.snapshot_publish(good, str(tmp_path), "s", ["k"], "r1", datetime(2001, 1, 1))
    with pytest.raises(ValueError):
        sinks.snapshot_publish(good.union(good), str(tmp_path), "s", ["k"], "r2", datetime(2001, 1, 2))
    assert sinks.current_snapshot(spark, str(tmp_path), "s").count() == 3
