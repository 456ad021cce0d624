"""Rows that fits read many times are written once."""

from __future__ import annotations

from conftest import SF
from marketloom.plans import policy_queries as Q
from marketloom.plans import registry


def test_scores_of_uplift_rest_on_stored_rows(spark):
    assert all("/step-" in f for f in registry.QUERIES["score_uplift"](spark, SF).inputFiles())


def test_pair_rows_gather_no_stored_table_on_the_driver(spark):
    plan = Q.pair_rows(spark, SF, Q.CUTOFFS[-1])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
