"""Uplift models, samples and global order on planted cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF
from marketloom.operators import datasets, distributed, models
from marketloom.plans import policy_queries as Q


@pytest.fixture(scope="module")
def arms(spark):
    """Clients of segment a buy only when treated; the others buy at one rate in both arms."""
    rnd = random.Random(8)
    rows = []
    for i in range(1200):
        segment, arm, noise = rnd.choice("ab"), i % 2, rnd.random()
        rate = (0.9 if arm else 0.1) if segment == "a" else 0.4
        rows.append((i, segment, noise, arm, int(rnd.random() < rate), "validation" if i % 5 == 0 else "train"))
    return spark.createDataFrame(rows, "client_id long, segment string, noise double, treatment int, target int, split string")


def test_planted_uplift(arms):
    manifest = models.feature_manifest(arms, {"client_id", "treatment", "target", "split"})
    assert [(m["name"], m["categorical"]) for m in manifest] == [("segment", True), ("noise", False)]
    fitted = models.train_t_learner(arms, manifest)
    out = models.score_uplift(arms, fitted, manifest)
    p = out.agg(*(f(c).alias(f"{c}_{f.__name__}") for c in ("p_control", "p_treatment") for f in (F.min, F.max))).first()
    assert all(0 <= x <= 1 for x in p)
    mean = {r.segment: r.u for r in out.groupBy("segment").agg(F.avg("uplift_score").alias("u")).collect()}
    assert mean["a"] > 0.5 and abs(mean["b"]) < 0.2
    with pytest.raises(ValueError):
        models.score_uplift(arms.withColumn("noise", F.col("noise").cast("string")), fitted, manifest)


def test_early_stop(arms):
    """On labels without a pattern, fewer trees are kept than asked for."""
    noise = arms.withColumn("target", (F.xxhash64("client_id") % 2 == 0).cast("int"))
    manifest = models.feature_manifest(arms, {"client_id", "treatment", "target", "split"})
    fitted = models.train_t_learner(noise, manifest, trees=30)
    assert min(m.stages[-1].getNumTrees for m in fitted) < 30


def test_one_decision_on_weights(spark):
    rows = [(0, 1)] * 1 + [(0, 0)] * 19 + [(1, 1)] * 10 + [(1, 0)] * 10
    out = models.class_weights(spark.createDataFrame(rows, "treatment int, target int"), "target").distinct().collect()
    assert {(r.treatment, r.target): round(r._w, 6) for r in out} == {(0, 1): 10.0, (0, 0): round(0.5 / 0.95, 6), (1, 1): 1.0, (1, 0): 1.0}
    often = [(a, y) for a in (0, 1) for y in [1] * 19 + [0]]
    assert {r._w for r in models.class_weights(spark.createDataFrame(often, "treatment int, target int"), "target").collect()} == {1.0}


@pytest.mark.parametrize("n0, n1, most, want", [(3, 1, 2, (1, 1)), (1, 3, 2, (1, 1)), (90, 10, 50, (45, 5)), (99, 1, 10, (9, 1)), (2, 98, 50, (1, 49)), (3, 4, 100, (3, 4)), (5, 5, 5, (3, 2)), (0, 9, 4, (None, 4))])
def test_quotas_add_up(spark, n0, n1, most, want):
    frame = spark.createDataFrame([(0,)] * n0 + [(1,)] * n1, "label int")
    got = {r.label: r.quota for r in datasets.label_quotas(frame, most).collect()}
    assert (got.get(0), got.get(1)) == want


def test_common_value_fills_no_bucket(spark):
    """With one value in nine tenths of the rows, no bucket holds more than a few hundredths."""
    rnd = random.Random(2)
    rows = [(i, 0.5 if rnd.random() < 0.9 else rnd.random()) for i in range(20_000)] + [(20_000, None)]
    frame = spark.createDataFrame(rows, "id long, score double")
    dealt = distributed.with_bucket(frame, "score", True, 64, F.col("id"))
    assert dealt.groupBy("_bucket").count().agg({"count": "max"}).first()[0] < 0.06 * len(rows)
    got = distributed.global_row_number(frame, "score", [F.desc("score"), F.asc("id")], "k", True, 64, F.col("id")).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [r.id for r in sorted(got, key=lambda r: r.k)] == [i for i, _ in want]
    # Bounds beyond one chunk of the lookup.
    got = distributed.global_row_number(frame, "score", [F.asc("score"), F.asc("id")], "k", False, 300, F.col("id")).collect()
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert [r.id for r in sorted(got, key=lambda r: r.k)] == [i for i, _ in want]


def test_score_queries_are_probabilities(spark):
    out = Q.score_uplift(spark, SF)
    bad = out.where("p_control < 0 OR p_control > 1 OR p_treatment < 0 OR p_treatment > 1 OR abs(uplift_score - p_treatment + p_control) > 1e-9 OR isnan(uplift_score)")
    assert out.count() > 0 and bad.count() == 0
    assert {r.fraction for r in Q.train_t_learner(spark, SF).collect()} == {0.1, 0.2, 0.3}
