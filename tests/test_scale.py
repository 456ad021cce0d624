"""Hot groups: ranks inside a category, order with common and missing values, pairs of large receipts."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketloom.operators import candidates, distributed


def test_ranks_inside_hot_groups(spark):
    rnd = random.Random(7)
    groups = ["a"] * 8 + ["b", None]
    rows = [(i, rnd.choice(groups), None if rnd.random() < 0.4 else float(rnd.choice([0, 0, 0, 0, 3, 5, rnd.randrange(50)]))) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    for order, falling in (([F.desc_nulls_last("v"), F.asc("id")], True), ([F.asc_nulls_first("v"), F.asc("id")], False)):
        got = distributed.running(df, "v", order, {"r": F.lit(1)}, descending=falling, buckets=16, second=F.col("id"), within=["g"])
        want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
        assert sorted((x.id, x.r) for x in got.collect()) == sorted((x.id, x.r) for x in want.collect())
        dealt = distributed.with_bucket(df, "v", falling, 16, F.col("id"))
        # Missing values and the value 0 hold most rows; no bucket does.
        assert max(Counter(x[0] for x in dealt.select("_bucket").collect()).values()) < 600


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_pairs_of_large_receipts(spark, block):
    rnd = random.Random(5)
    rows = [(1, t, p) for t, n in ((1, 40), (2, 1), (3, 2), (4, 17), (5, 3)) for p in rnd.sample(range(60), n)]
    df = spark.createDataFrame(rows + rows[:5], "client_id int, transaction_id int, product_id int")
    held = {}
    for _, t, p in rows:
        held.setdefault(t, set()).add(p)
    each, both = Counter(p for s in held.values() for p in s), Counter((a, b) for s in held.values() for a in s for b in s if a != b)
    want = sorted((a, b, n, round(n / (each[a] * each[b]) ** 0.5, 9)) for (a, b), n in both.items())
    got = candidates.basket_cosine(df, block=block).collect()
    assert sorted((r.seed_product_id, r.product_id, r.co_receipts, round(r.similarity, 9)) for r in got) == want
    keys = candidates.basket_blocks(df.distinct(), block).groupBy("transaction_id", "_lo", "_hi").count().agg(F.max("count")).first()[0]
    assert keys <= (40 if block == 1000 else 12 * block)


def test_sources_merge_by_flags_and_refuse_unknown_names(spark):
    rows = [(1, 7, 0.5, "repeat_purchase"), (1, 7, 1.0, "global_popular"), (1, 7, 1.0, "global_popular"), (1, 8, 0.0, "item_to_item"), (None, 8, None, "item_to_item")]
    schema = "client_id long, product_id long, normalized_score double, candidate_source string"
    found = {(r.client_id, r.product_id): (r.candidate_sources, r.best_source_score, r.recsys_score) for r in candidates.source_merge(spark.createDataFrame(rows, schema)).collect()}
    assert found == {(1, 7): (["global_popular", "repeat_purchase"], 1.0, 1.05), (1, 8): (["item_to_item"], 0.0, 0.0), (None, 8): (["item_to_item"], None, None)}
    assert candidates.source_merge(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(Exception, match="unknown source"):
        candidates.source_merge(spark.createDataFrame([(1, 7, 0.5, "other")], schema)).collect()


def test_one_window_ranks_sources_as_single_ones_do(spark):
    rows = [(1, 7, 0.5, "a"), (1, 8, 0.5, "a"), (1, 9, 0.7, "a"), (1, 7, 3.0, "b"), (2, 7, 1.0, "b"), (2, 8, 2.0, "b")]
    raw = spark.createDataFrame(rows, "client_id long, product_id long, raw_score double, candidate_source string")
    want = [tuple(r) for n in "ab" for r in candidates.normalise_source(raw.where(F.col("candidate_source") == n).drop("candidate_source"), n).collect()]
    assert sorted(want) == sorted(tuple(r) for r in candidates.normalise_source(raw).collect())


def test_no_single_task_multiplies_all_clients(spark, monkeypatch):
    """The clients of one file were crossed with the popular items in one task."""
    seen = []
    monkeypatch.setattr(candidates, "BUCKET_ROWS", 900)
    for n in ("cand_repeat", "cand_category", "cand_item_to_item"):
        monkeypatch.setattr(candidates, n, lambda *a: spark.createDataFrame([], "client_id long, product_id long, raw_score double"))
    crossed = candidates.cand_global
    monkeypatch.setattr(candidates, "cand_global", lambda clients, items: seen.append(clients) or crossed(clients, items))
    items = spark.range(3).selectExpr("id AS product_id", "0 AS is_alcohol", "id AS unique_buyers", "id AS total_sales_qty")
    assert candidates.normalised_sources(spark.range(0, 300, 1, 1).withColumnRenamed("id", "client_id"), items, None, None).count() == 900
    assert seen[0].rdd.getNumPartitions() == 30 and max(seen[0].rdd.glom().map(len).collect()) < 60


def test_categories_of_clients_stay_dealt(spark):
    """All categories of clients are a few kilobytes, so one task made 25 rows of each."""
    lines = spark.range(300).selectExpr("id AS client_id", "id % 4 AS product_id", "cast(id % 2 AS string) AS level_2", "1 AS product_quantity")
    items = spark.range(4).selectExpr("id AS product_id", "cast(id % 2 AS string) AS level_2", "id AS unique_buyers")
    found = candidates.cand_category(lines, items, 25, 2, 9)
    assert found.rdd.getNumPartitions() == 9 and max(found.rdd.glom().map(len).collect()) < 150
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, candidates.cand_category(lines, items).collect())) and found.count() == 600


def test_partitions_of_candidates_follow_the_clients(spark, monkeypatch):
    monkeypatch.setattr(candidates, "BUCKET_ROWS", 900)
    for n in ("cand_repeat", "cand_category", "cand_item_to_item", "cand_global"):
        monkeypatch.setattr(candidates, n, lambda *a: spark.range(300).select(F.col("id").alias("client_id"), F.lit(1).alias("product_id"), F.lit(0.5).alias("raw_score")))
    found = candidates.normalised_sources(spark.range(300).withColumnRenamed("id", "client_id"), None, None, None)
    assert found.rdd.getNumPartitions() == 30
    assert found.count() == 1200
