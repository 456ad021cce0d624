"""Features of a cutoff come from the lines before it, for clients, items and pairs."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import functions as F

from conftest import SF
from marketloom.operators import candidates as C
from marketloom.operators import datasets as G
from marketloom.operators import features as f
from marketloom.operators import models as M
from marketloom.plans import policy_queries as Q
from marketloom.sources.shared import materialise


def frozen(rows):
    cols = sorted(set(rows.columns) - {"label"})
    return sorted(map(str, rows.where("split = 'train'").select(*cols).collect()))


def test_moving_later_purchases_changes_no_feature(spark, tmp_path):
    for name in os.listdir(SF):
        if name != "orders.parquet":
            os.symlink(f"{SF}/{name}", tmp_path / name)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    late = (F.col("o_orderdate") >= datetime(2000, 10, 1)) & (F.col("o_orderkey") % 2 == 0)
    moved = F.when(late, F.col("o_orderdate") + F.expr("INTERVAL 400 DAYS")).otherwise(F.col("o_orderdate"))
    orders.withColumn("o_orderdate", moved.cast(orders.schema["o_orderdate"].dataType)).write.parquet(f"{tmp_path}/orders.parquet")
    assert frozen(Q._training(spark, str(tmp_path))) == frozen(Q._training(spark, SF))


def test_rows_are_those_of_the_single_operators(spark):
    """Histories, labels and client features that join while candidates are dealt give what the operators give one after the other."""
    cutoff, keys = Q.CUTOFFS[-1], ["client_id", "product_id"]
    before, everyone = Q.lines(spark, SF, cutoff), Q.t.clients(spark, SF)
    clients = materialise(f.user_features(everyone, before, cutoff))
    products = materialise(f.item_features(Q.t.products(spark, SF), before.drop("level_2"), Q.MARGINS, 0.25))
    found = materialise(C.candidates_top50(everyone, products, before, cutoff))
    pairs = f.user_item_features(found, clients, products, before, cutoff)
    sources = found.select(*keys, F.concat_ws("|", "candidate_sources").alias("candidate_sources"), "candidate_rank", "recsys_score")
    rows = pairs.join(sources, keys).join(clients, "client_id").join(products, "product_id")
    want = G.observation(rows, Q.t.purchases(spark, SF), cutoff, 90, "validation")
    got = Q.pair_rows(spark, SF, cutoff, split="validation")
    names = sorted(want.columns)
    assert sorted(got.columns) == names and dict(got.dtypes) == dict(want.dtypes)
    assert sorted(map(str, got.select(*names).collect())) == sorted(map(str, want.select(*names).collect()))


def test_wide_rows_are_dealt_once(spark):
    """Rows with all features were dealt four times; now the stored candidates have those of clients, and are dealt by item."""
    plan = Q.pair_rows(spark, SF, Q.CUTOFFS[-1])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange") == 2


def test_facts_make_no_candidates(spark):
    shape = "client_id long, product_id long, normalized_score double, candidate_source string, seen int"
    rows = [(1, 7, 0.5, "repeat_purchase", None), (1, 7, 1.0, None, 3), (1, 7, 0.0, None, 2), (1, 9, 1.0, None, 4), (1, 8, None, "item_to_item", None)]
    found = {(r.client_id, r.product_id): (r.candidate_sources, r.best_source_score, r.seen) for r in C.source_merge(spark.createDataFrame(rows, shape), facts=["seen"]).collect()}
    assert found == {(1, 7): (["repeat_purchase"], 0.5, 3), (1, 8): (["item_to_item"], None, None)}


def test_scores_are_those_of_the_fitted_model(spark):
    rows = Q._training(spark, SF).limit(2000).withColumn("label", (F.col("candidate_rank") < 9).cast("int")).withColumn("split", F.when(F.col("client_id") % 3 == 0, "validation").otherwise("train"))
    rows, keys = materialise(rows), ["client_id", "product_id", "cutoff"]
    manifest = M.feature_manifest(rows, Q.KEYS)
    got = M.fitted_scores(rows, manifest, keys, trees=2, depth=2)
    model, _ = M._stopped_early(rows, manifest, "label", "split", 2, 2, keys)
    want = M.score_propensity(rows, model, manifest).select(*keys, "p_base_purchase")
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_propensity_differs_between_products(spark):
    rows = Q._training(spark, SF)
    assert {"times_bought", "user_category_affinity", "recsys_score", "avg_check", "unique_buyers", "unit_price"} <= set(rows.columns)
    assert rows.groupBy("client_id", "product_id", "split").count().where("count > 1").isEmpty()
    scored = Q.score_propensity(spark, SF)
    assert scored.count() == rows.count()
    per = scored.groupBy("client_id", "split").agg(F.countDistinct("p_base_purchase").alias("n"))
    assert per.agg(F.max("n")).first()[0] > 1
