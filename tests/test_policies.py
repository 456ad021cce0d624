"""Allocation under another leading order against a plain loop, and final offers."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from conftest import SF
from marketloom.operators import distributed
from marketloom.plans import policy_queries as Q


def test_budget_with_another_lead(spark):
    rnd = random.Random(4)
    rows = [(rnd.randrange(12), i, float(rnd.randrange(5)), float(rnd.randrange(4)), float(rnd.randrange(1, 30)), rnd.randrange(3) / 4) for i in range(80)]
    spent, held, want = 0, {}, set()
    for r in sorted(rows, key=lambda r: (-r[5], -r[2], -r[3], r[4], r[0], r[1])):
        if held.get(r[0], 0) < 2 and spent + r[4] <= 150:
            spent, held[r[0]] = spent + r[4], held.get(r[0], 0) + 1
            want.add(r[:2])
    df = spark.createDataFrame(rows, "client_id long, product_id long, roi double, incremental_profit double, cost double, p double")
    out = distributed.budget_allocation(df, 150.0, 2, lead="p").where("optimizer_decision = 'DISCOUNT_ACCEPTED'").collect()
    assert {(r.client_id, r.product_id) for r in out} == want


def test_final_lists_hold_only_accepted_discounts(spark):
    assert Q.offline_kpis(spark, SF).first().discount_spend <= Q.OPT.global_budget
    got = {r.policy: r.n for r in Q.policy_comparison(spark, SF).collect()}
    accepted = Q._offers(spark, SF).where(F.col("discount") > 0).count()
    assert set(got) == {*Q.POLICIES, "no_discount"} and got["profit_aware"] == accepted


def test_accepted_rows_are_those_of_the_whole_allocation(spark):
    rows = spark.createDataFrame([(i % 5, i, i % 3 / 2, i % 7 / 2, 1.0 + i % 6) for i in range(60)], "client_id long, product_id long, roi double, incremental_profit double, cost double")
    want = distributed.budget_allocation(rows, 12.0, 2).where("optimizer_decision = 'DISCOUNT_ACCEPTED'").select("allocation_rank", "product_id").collect()
    assert sorted(distributed.accepted_rows(rows, 12.0, 2).select("allocation_rank", "product_id").collect()) == sorted(want) != []
