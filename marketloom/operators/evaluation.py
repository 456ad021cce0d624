"""Offline evaluation: classifier metrics, calibration, uplift curves, business figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.operators.distributed import global_row_number, quantiles, running


def calibration_bins(scored: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins with rows, mean score and label rate; empty bins too; 1 is in the last."""
    number = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    found = scored.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("_s"), F.avg("label").alias("_l"))
    every = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), F.round("_s", 9).alias("mean_score"), F.round("_l", 9).alias("positive_rate"))


def classification_metrics(scored: DataFrame) -> DataFrame:
    """ROC-AUC and stepwise average precision over score groups, log-loss and Brier score.

    Rows with equal scores first collapse to one with counts, so windows run over
    distinct scores only.
    """
    groups = scored.groupBy("score").agg(F.sum("label").alias("_p"), F.count(F.lit(1)).alias("_n"))
    placed = running(groups, "score", [F.desc("score")], {"_tp": F.col("_p"), "_all": F.col("_n")}, descending=True)
    totals = groups.agg(F.sum("_p").alias("_pos"), F.sum("_n").alias("_tot"))
    placed = placed.join(F.broadcast(totals), how="cross")
    negatives = F.col("_n") - F.col("_p")
    ranks = placed.agg(
        # A negative is beaten by all positives of higher groups and half of its own.
        (F.sum(negatives * (F.col("_tp") - F.col("_p") + F.col("_p") / 2.0)) / F.first(F.col("_pos") * (F.col("_tot") - F.col("_pos")))).alias("_auc"),
        (F.sum((F.col("_p") * F.col("_tp") / F.col("_all")).cast("decimal(38,18)")).cast("double") / F.first("_pos")).alias("_ap"),
    )
    p = F.least(F.lit(1 - 1e-15), F.greatest(F.lit(1e-15), F.col("score")))
    loss = -(F.col("label") * F.log(p) + (1 - F.col("label")) * F.log(1 - p))
    means = scored.agg(F.avg(loss).alias("_ll"), F.avg(F.pow(F.col("score") - F.col("label"), 2)).alias("_br"))
    return ranks.join(F.broadcast(means), how="cross").select(
        F.round("_auc", 6).alias("roc_auc"), F.round("_ap", 6).alias("average_precision"), F.round("_ll", 6).alias("log_loss"), F.round("_br", 6).alias("brier")
    )


def uplift_curve(rows: DataFrame, points: int = 100) -> DataFrame:
    """Gain T - C * n_T / n_C at up to ``points`` prefixes in score order, from (0, 0)."""
    order = [F.desc("score"), F.asc("id")]
    sums = {"_k": F.lit(1), "_nt": F.col("treatment"), "_t": F.col("label") * F.col("treatment"), "_c": F.col("label") * (1 - F.col("treatment"))}
    placed = running(rows, "score", order, sums, descending=True, second=F.col("id"))
    total = rows.agg(F.count(F.lit(1)).alias("_n"))
    cuts = total.select("_n", F.explode(F.sequence(F.lit(1), F.lit(points))).alias("_i"))
    cuts = cuts.select("_n", F.least(F.col("_n"), F.greatest(F.lit(1), F.ceil(F.col("_n") * F.col("_i") / F.lit(points)))).alias("_k")).distinct()
    at = placed.join(F.broadcast(cuts), "_k").where((F.col("_nt") > 0) & (F.col("_nt") < F.col("_k")))
    gain = F.col("_t") - F.col("_c") * F.col("_nt") / (F.col("_k") - F.col("_nt"))
    curve = at.select(F.col("_k").cast("long").alias("rows"), (F.col("_k") / F.col("_n")).alias("population_fraction"), gain.cast("double").alias("gain"))
    start = rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("rows"), F.lit(0.0).alias("population_fraction"), F.lit(0.0).alias("gain"))
    return start.unionByName(curve)


def auuc_qini(curve: DataFrame) -> DataFrame:
    """Trapezoid area under the curve, and less that of the diagonal; at most 101 rows."""
    order = Window.orderBy("rows")
    steps = curve.select(
        ((F.col("population_fraction") - F.lag("population_fraction").over(order)) * (F.col("gain") + F.lag("gain").over(order)) / 2).alias("_a"), "rows", "gain"
    )
    out = steps.agg(F.sum("_a").alias("auuc"), (F.max_by("gain", "rows") / 2).alias("half"))
    return out.select(F.round("auuc", 6).alias("auuc"), F.round("half", 6).alias("random_baseline_area"), F.round(F.col("auuc") - F.col("half"), 6).alias("qini"))


def uplift_at_k(rows: DataFrame, fractions: tuple[float, ...] = (0.1, 0.2, 0.3)) -> DataFrame:
    """The response gap between the arms in the first part of the rows by score."""
    ranked = global_row_number(rows, "score", [F.desc("score"), F.asc("id")], "_k", descending=True, second=F.col("id"))
    total = rows.agg(F.count(F.lit(1)).alias("_n"))
    cuts = total.select("_n", F.explode(F.array(*map(F.lit, fractions))).alias("fraction"))
    cuts = cuts.withColumn("_cut", F.greatest(F.lit(1), F.ceil(F.col("_n") * F.col("fraction"))))
    mean = lambda arm: F.avg(F.when(F.col("treatment") == arm, F.col("label")))
    return ranked.join(F.broadcast(cuts), F.col("_k") <= F.col("_cut")).groupBy("fraction").agg(F.round(mean(1) - mean(0), 9).alias("uplift"))


def overlap_diagnostics(scored: DataFrame) -> DataFrame:
    """Quantiles of the treatment propensity and the share outside 0.1 to 0.9."""
    found = quantiles(scored, "score", {"p01": "0.01", "p05": "0.05", "p50": "0.5", "p95": "0.95", "p99": "0.99"})
    outside = scored.agg(F.round(F.avg(((F.col("score") < 0.1) | (F.col("score") > 0.9)).cast("int")), 9).alias("outside_share"))
    return found.join(F.broadcast(outside), how="cross")  # one row on both sides


def score_summary(pairs: DataFrame, clients: DataFrame) -> DataFrame:
    """Mean uplift, share of negative uplift, mean propensity."""
    a = clients.agg(F.round(F.avg("uplift_score"), 9).alias("mean_uplift"), F.round(F.avg((F.col("uplift_score") < 0).cast("int")), 9).alias("negative_share"))
    b = pairs.agg(F.round(F.avg("p_base_purchase"), 9).alias("mean_propensity"))
    return a.join(F.broadcast(b), how="cross")


def _exact(c: str) -> Column:
    """A sum that does not depend on the order of its terms."""
    return F.coalesce(F.sum(F.col(c).cast("decimal(28,9)")), F.lit(0)).cast("double")


def offline_kpis(ranked: DataFrame, offers: DataFrame, users: DataFrame) -> DataFrame:
    """Coverage, list size, diversity and business totals, as one row."""
    lists = ranked.groupBy("client_id").agg(F.countDistinct("ranking_level_2").alias("_c"), F.count(F.lit(1)).alias("_i"))
    a = lists.agg(F.count(F.lit(1)).alias("recommended_users"), F.sum("_i").alias("recommendations"), F.round(F.avg("_i"), 9).alias("average_list_size"), F.round(F.avg("_c"), 9).alias("average_category_diversity"))
    b = offers.agg(
        _exact("expected_profit").alias("expected_profit_total"), _exact("incremental_profit").alias("incremental_profit_total"),
        _exact("expected_discount_cost").alias("discount_spend"), F.avg((F.col("discount") > 0).cast("int")).alias("selected_discount_share"),
    )
    c = users.agg(F.countDistinct("client_id").alias("users"))
    out = a.join(F.broadcast(b), how="cross").join(F.broadcast(c), how="cross")
    return out.select(
        "users", "recommended_users", F.round(F.coalesce(F.try_divide("recommended_users", "users"), F.lit(0.0)), 9).alias("coverage"),
        "recommendations", "average_list_size", "average_category_diversity",
        F.round("expected_profit_total", 4).alias("expected_profit_total"), F.round("incremental_profit_total", 4).alias("incremental_profit_total"),
        F.round("discount_spend", 4).alias("discount_spend"),
        F.round(F.coalesce(F.try_divide("incremental_profit_total", "discount_spend"), F.lit(0.0)), 6).alias("promo_roi"),
        F.round("selected_discount_share", 9).alias("selected_discount_share"),
    )
