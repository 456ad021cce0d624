"""Training with a cap and the best number of trees, reports per arm, overlap, balance, and frequent values."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketloom.operators import datasets, models

KEYS = ["client_id"]


@pytest.fixture(scope="module")
def planted(spark):
    """One feature tells the label in both splits; a second one tells it in the train rows only."""
    rnd = random.Random(3)
    rows = []
    for i in range(1500):
        split, y = ("validation", rnd.random() < 0.3) if i % 3 == 0 else ("train", rnd.random() < 0.3)
        a = rnd.gauss(1.0 if y else 0.0, 1.0)
        b = rnd.gauss(1.0 if y else 0.0, 0.7) if split == "train" else rnd.gauss(0.5, 0.9)
        rows.append((i, a, b, int(y), split))
    return spark.createDataFrame(rows, "client_id long, a double, b double, label int, split string")


def test_best_number_of_trees(planted):
    manifest = models.feature_manifest(planted, {"client_id", "label", "split"})
    fitted = models.boost(planted, manifest, "label", trees=12, depth=3)
    assert len(fitted.losses) == 12 and fitted.best_iteration == min(range(12), key=fitted.losses.__getitem__) + 1
    assert 1 <= fitted.best_iteration < 12  # more trees learn what holds in the train rows only
    assert fitted.model.stages[-1].getNumTrees == fitted.best_iteration
    # The loss of the shorter model is that of the prefix of the longer one.
    again = models.boost(planted, manifest, "label", trees=fitted.best_iteration, depth=3)
    assert math.isclose(again.losses[-1], fitted.losses[fitted.best_iteration - 1], rel_tol=1e-9)


def test_report_under_a_cap(planted):
    manifest = models.feature_manifest(planted, {"client_id", "label", "split"})
    fitted, report = models.fit_propensity(planted, manifest, KEYS, most=800, trees=6, depth=2, bins=5)
    row = report.first()
    assert (row.n_validation, row.n_train, row.best_iteration, row.iterations) == (500, 300, fitted.best_iteration, 6)
    assert 0.6 < row.roc_auc < 1 and 0 < row.log_loss < 1
    assert [b.bin for b in row.calibration_bins] == [0, 1, 2, 3, 4] and sum(b.n for b in row.calibration_bins) == 500
    capped = models.capped(planted, KEYS, 800, 11)
    share = planted.where("split = 'train'").agg(F.avg("label")).first()[0]
    assert abs(capped.where("split = 'train'").agg(F.avg("label")).first()[0] - share) < 0.01
    assert capped.where("split = 'validation'").count() == 500
    with pytest.raises(ValueError, match="no room"):
        models.capped(planted, KEYS, 501, 11)
    with pytest.raises(ValueError, match="both labels"):
        models.fit_propensity(planted.where("label = 0 OR split = 'train'"), manifest, KEYS, 800)


def test_no_number_of_validation_rows_is_too_many(planted):
    """Two million rows were the most, so the query ended in an error where the validation rows alone are more."""
    many = planted.where("split = 'train'").limit(40).unionByName(planted.where("split = 'validation'").crossJoin(planted.sparkSession.range(4100).select()))
    manifest = models.feature_manifest(planted, {"client_id", "label", "split"})
    row = models.fit_propensity(many, manifest, KEYS, trees=1, depth=1, bins=2)[1].first()
    assert (row.n_train, row.n_validation) == (40, 2_050_000) and sum(b.n for b in row.calibration_bins) == 2_050_000


def test_features_are_those_of_the_fitted_stages(spark):
    """One expression gives what the stages give, unknown and missing values too, and the trees know which features are categories."""
    rows = [(i, ["a", "b", None][i % 3], None if i % 5 == 0 else float("nan") if i % 7 == 0 else float(i), i % 4, i % 2 == 0) for i in range(60)]
    shape = "client_id long, kind string, x double, n int, flag boolean"
    frame = spark.createDataFrame(rows, shape)
    manifest = models.feature_manifest(frame, {"client_id"})
    stages, name = models._stages(manifest)
    prepare = models.Pipeline(stages=stages).fit(models._as_double(frame, manifest))
    seen = models._as_double(frame.unionByName(spark.createDataFrame([(60, "c", 3.5, None, None), (61, "", None, 2, True)], shape)), manifest)
    want, got = prepare.transform(seen), models._with_features(seen, prepare)
    vectors = lambda df: {r.client_id: list(r[name]) for r in df.collect()}
    assert vectors(got) == vectors(want) and len(vectors(got)) == 62
    assert got.schema[name].metadata == want.schema[name].metadata and "nominal" in str(got.schema[name].metadata)
    # Neither columns of the stages nor text are left to carry along.
    assert got.columns == [*seen.columns, name]


def arms(spark, biased):
    rnd = random.Random(9)
    rows = []
    for i in range(900):
        x = rnd.random()
        arm = int(rnd.random() < (0.1 + 0.8 * x if biased else 0.5))
        rows.append((i, x, arm, int(rnd.random() < 0.05 + 0.3 * arm * x), "validation" if i % 3 == 0 else "train"))
    return spark.createDataFrame(rows, "client_id long, x double, treatment int, target int, split string")


def test_overlap_of_alike_and_of_biased_arms(spark):
    found = {}
    for biased in (False, True):
        frame = arms(spark, biased)
        found[biased] = models.treatment_overlap(frame, models.feature_manifest(frame, {"client_id", "treatment", "target", "split"}), trees=6, depth=3).first()
        r = found[biased]
        assert 0 <= r.p01 <= r.p05 <= r.p50 <= r.p95 <= r.p99 <= 1 and 1 <= r.best_iteration <= 6
    assert abs(found[False].roc_auc - 0.5) < 0.12 and found[True].roc_auc > 0.65


def test_report_per_arm(spark):
    frame = arms(spark, False)
    manifest = models.feature_manifest(frame, {"client_id", "treatment", "target", "split"})
    fitted = models.train_t_learner(frame, manifest, trees=4)
    rows = {r.treatment: r for r in models.arm_report(frame, fitted, manifest).collect()}
    assert set(rows) == {0, 1} and sum(r.n_train for r in rows.values()) == 600 and sum(r.n_validation for r in rows.values()) == 300
    rates = {r.treatment: r.y for r in frame.where("split = 'train'").groupBy("treatment").agg(F.avg("target").alias("y")).collect()}
    for arm, r in rows.items():
        assert r.best_iteration == fitted[arm].stages[-1].getNumTrees and 0 <= r.roc_auc <= 1
        # Control buys rarely, so both arms are balanced.
        assert math.isclose(r.weight_1, 0.5 / rates[arm]) and math.isclose(r.weight_0, 0.5 / (1 - rates[arm]))


def test_differences_between_arms(spark):
    rows = [(0, 1, 20.0, "a"), (0, 0, 30.0, "b"), (1, 1, 40.0, "a"), (1, 1, 50.0, None), (1, 0, None, "c")]
    frame = spark.createDataFrame(rows, "treatment int, target int, age double, gender string")
    found = {(r.measure, r.value): (r.control, r.treatment, r.difference) for r in datasets.treatment_differences(frame, "age", "gender").collect()}
    smd = (45 - 25) / math.sqrt((50 + 50) / 2)
    want = {("target_rate", None): (0.5, 2 / 3, 2 / 3 - 0.5), ("age_smd", None): (25, 45, smd), ("gender_share", "a"): (0.5, 1 / 3, 1 / 3 - 0.5), ("gender_share", "b"): (0.5, 0, -0.5), ("gender_share", "c"): (0, 1 / 3, 1 / 3), ("gender_share", None): (0, 1 / 3, 1 / 3)}
    assert found.keys() == want.keys() and all(math.isclose(x, y, abs_tol=1e-12) for k in want for x, y in zip(found[k], want[k]))


def top(rows, n):
    out = []
    for key in {r[0] for r in rows}:
        counts = Counter(v for k, v in rows if k == key)
        out += [(key, v, c, i + 1) for i, (v, c) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0] is None, x[0]))[:n])]
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["heavy", "even", "few", "ties"])
def test_frequent_values(spark, kind):
    rnd = random.Random(kind)
    draw = {
        "heavy": lambda: f"v{min(int(rnd.paretovariate(0.8)), 50_000)}",
        "even": lambda: f"v{rnd.randrange(3000)}",
        "few": lambda: rnd.choice(["x", "y", None]),
        "ties": lambda: rnd.choice(["a", "b", "c", *(f"r{k}" for k in range(400))]) if rnd.random() < 0.5 else rnd.choice("abc"),
    }[kind]
    rows = [(k, draw()) for k in rnd.choices(["p", "q"], [9, 1], k=12_000)]
    frame = spark.createDataFrame(rows, "k string, value string").repartition(5)
    found = datasets.frequent_values(frame, ["k"], 5, counters=60)
    assert sorted((tuple(r[c] for c in ("k", "value", "n", "rank")) for r in found.collect()), key=str) == top(rows, 5)


def test_columns_with_many_values_move_few_rows(spark):
    """A million values beside five frequent ones: the summaries hold thousands, and only candidates are counted."""
    value = F.when(F.col("id") % 4 == 0, F.concat(F.lit("top"), (F.col("id") % 20).cast("string"))).otherwise(F.col("id").cast("string"))
    frame = spark.range(0, 1_000_000, 1, 8).select(F.lit("k").alias("k"), value.alias("value"))
    held = datasets._summaries(frame, ["k"], 1000)
    assert held.count() <= 8 * 1001
    found = datasets.frequent_values(frame, ["k"], 5)
    assert {(r.value, r.n) for r in found.collect()} == {(f"top{k}", 50_000) for k in (0, 4, 8, 12, 16)}
    assert found.select("value").distinct().count() == 5
