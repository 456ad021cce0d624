"""Queries of risk, scenarios, allocation, ranking, data sets, evaluation, models and streams."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.functions import expressions as X
from marketloom.operators import candidates as C
from marketloom.operators import datasets as G
from marketloom.operators import distributed as R
from marketloom.operators import evaluation as E
from marketloom.operators import features as f
from marketloom.operators import models as M
from marketloom.operators import pricing as P
from marketloom.operators import ranking as K
from marketloom.plans.base import LINES_SQL, MARGINS, SQL, USERS_SQL, eligible, lines, query, users
from marketloom.sources import scans
from marketloom.sources import tables as t
from marketloom.sources.shared import materialise, shared_dir, spread
from marketloom.streaming import feedback as st

S, D = SparkSession, DataFrame
SIM = P.SimulationPolicy()
OPT = P.OptimizerPolicy(max_discount_by_category={"PROMO": 0.05}, global_budget=400.0)
RANK = K.RankingPolicy()


def scores(s: S, d: str) -> D:
    """Surrogate uplift scores, a closed form of the key."""
    return t.clients(s, d).select("client_id", (((F.col("client_id") * 13) % 41 - 10) / F.lit(100.0)).alias("uplift_score"))


SCORES_SQL = "scores AS (SELECT client_id, ((client_id * 13) % 41 - 10) / 100.0::DOUBLE AS uplift_score FROM clients)"


def pairs(s: S, d: str) -> D:
    """Bought pairs with surrogate scores and the items' list prices."""
    bought = eligible(s, d).select("client_id", "product_id").distinct()
    items = t.products(s, d).select("product_id", "level_2", "netto")
    c, p = F.col("client_id"), F.col("product_id")
    source = F.when(p % 3 == 0, F.array(F.lit("repeat_purchase"))).when(p % 3 == 1, F.array(F.lit("category_popular"))).otherwise(F.array(F.lit("global_popular")))
    return bought.join(items, "product_id").join(scores(s, d), "client_id").select(
        "client_id", "product_id", "level_2", "uplift_score",
        ((c * 31 + p * 17) % 100 / F.lit(100.0)).alias("recsys_score"),
        ((c % 97) / F.lit(100.0)).alias("p_base_purchase"),
        F.when(p % 10 != 0, F.col("netto")).alias("unit_price"),
        F.lit(0.25).alias("margin_rate"),
        (p % 10 != 0).alias("is_price_available"),
        ((c % 11) / F.lit(10.0)).alias("promo_abuse_score"),
        source.alias("candidate_sources"),
    )


PAIRS_SQL = f"""{LINES_SQL}, {SCORES_SQL},
pairs AS (
  SELECT b.client_id, b.product_id, p.level_2, uplift_score, (b.client_id * 31 + b.product_id * 17) % 100 / 100.0::DOUBLE AS recsys_score,
    (b.client_id % 97) / 100.0::DOUBLE AS p_base_purchase, CASE WHEN b.product_id % 10 <> 0 THEN netto END AS unit_price,
    0.25::DOUBLE AS margin_rate, b.product_id % 10 <> 0 AS is_price_available, (b.client_id % 11) / 10.0::DOUBLE AS promo_abuse_score,
    CASE b.product_id % 3 WHEN 0 THEN 'repeat_purchase' WHEN 1 THEN 'category_popular' ELSE 'global_popular' END AS source
  FROM (SELECT DISTINCT client_id, product_id FROM eligible) b JOIN products p ON p.product_id = b.product_id JOIN scores s ON s.client_id = b.client_id)"""
SCENARIOS_SQL = f"""{PAIRS_SQL},
grid AS (SELECT * FROM (VALUES (0.0::DOUBLE, 0.0::DOUBLE), (0.05, 0.5), (0.1, 1.0), (0.15, 1.3)) g(discount, uplift_multiplier)),
response AS (
  SELECT *, least(1.0::DOUBLE, greatest(0.0::DOUBLE, p_base_purchase + greatest(uplift_score, 0.0::DOUBLE) * uplift_multiplier * (0.5::DOUBLE + 0.5::DOUBLE * recsys_score))) AS p_discount
  FROM pairs, grid WHERE is_price_available OR discount = 0),
economics AS (
  SELECT *, CASE WHEN is_price_available THEN unit_price * margin_rate END AS gross_margin,
    CASE WHEN is_price_available THEN p_discount * unit_price * (margin_rate - discount) END AS expected_profit,
    CASE WHEN is_price_available THEN p_discount * unit_price * discount END AS expected_discount_cost,
    CASE WHEN is_price_available THEN p_base_purchase * unit_price * margin_rate END AS baseline_expected_profit FROM response),
scenarios AS (
  SELECT *, expected_profit - baseline_expected_profit AS incremental_profit,
    CASE WHEN is_price_available THEN (expected_profit - baseline_expected_profit) / greatest(expected_discount_cost, 0.01::DOUBLE) END AS roi FROM economics)"""
CHOSEN_SQL = f"""{SCENARIOS_SQL},
eligible_rows AS (
  SELECT *, max(incremental_profit) OVER (PARTITION BY client_id, product_id) AS best FROM scenarios
  WHERE discount > 0 AND is_price_available AND margin_rate - discount > 0.05 AND discount <= CASE level_2 WHEN 'PROMO' THEN 0.05 ELSE 0.15 END
    AND promo_abuse_score <= 0.9 AND incremental_profit > 0 AND roi >= 0),
chosen AS (
  SELECT * EXCLUDE (best) FROM eligible_rows WHERE incremental_profit >= best - 0.01::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY client_id, product_id ORDER BY discount) = 1)"""


@query(
    f"""WITH {USERS_SQL}, {SCORES_SQL},
raw AS (SELECT client_id, round(greatest(purchases_7d - (7.0::DOUBLE / 30.0::DOUBLE) * purchases_30d, 0.0), 9) AS b, greatest(uplift_score, 0.0) AS u,
  coalesce(promo_sensitivity_proxy, 0.0) AS p, coalesce(redeemed_points_share, 0.0) AS r FROM users JOIN scores USING (client_id)),
ranks AS (SELECT *, percent_rank() OVER (ORDER BY b) AS pb, percent_rank() OVER (ORDER BY u) AS pu FROM raw)
SELECT client_id, round(pb, 9) AS purchase_burst_score, round(pu, 9) AS uplift_outlier_score,
  round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.4::DOUBLE * p + 0.2::DOUBLE * pb + 0.2::DOUBLE * r + 0.2::DOUBLE * pu)), 6) AS promo_abuse_score FROM ranks"""
)
def client_risk(s: S, d: str) -> D:
    out = P.client_risk(users(s, d), scores(s, d), SIM)
    return out.select("client_id", F.round("purchase_burst_score", 9).alias("purchase_burst_score"), F.round("uplift_outlier_score", 9).alias("uplift_outlier_score"), F.round("promo_abuse_score", 6).alias("promo_abuse_score"))


ECONOMICS = ["p_discount", "expected_profit", "expected_discount_cost", "incremental_profit", "roi"]
_ECONOMICS = ", ".join(ECONOMICS)


@query(f"WITH {SCENARIOS_SQL} SELECT client_id, product_id, discount, {_ECONOMICS} FROM scenarios")
def discount_scenarios(s: S, d: str) -> D:
    return P.discount_scenarios(pairs(s, d), SIM).select("client_id", "product_id", "discount", *ECONOMICS)


@query(f"WITH {CHOSEN_SQL} SELECT client_id, product_id, discount, {_ECONOMICS} FROM chosen")
def eligible_discounts(s: S, d: str) -> D:
    return _chosen(s, d).select("client_id", "product_id", "discount", *ECONOMICS)


@query(f"""WITH {SCENARIOS_SQL} SELECT client_id, product_id, discount FROM (SELECT *, max(expected_profit) OVER (PARTITION BY client_id, product_id) AS best FROM scenarios WHERE is_price_available) x
WHERE expected_profit >= best - 0.5::DOUBLE QUALIFY row_number() OVER (PARTITION BY client_id, product_id ORDER BY discount) = 1""")
def tolerant_argmax(s: S, d: str) -> D:
    rows = P.discount_scenarios(pairs(s, d), SIM).where("is_price_available")
    return P.tolerant_argmax(rows, ["client_id", "product_id"], "expected_profit", "discount", 0.5).select("client_id", "product_id", "discount")


@query(f"""WITH {SCENARIOS_SQL} SELECT client_id, product_id, max(expected_profit) AS best_profit FROM scenarios WHERE is_price_available GROUP BY ALL""")
def win_partition_max(s: S, d: str) -> D:
    rows = P.discount_scenarios(pairs(s, d), SIM).where("is_price_available")
    best = rows.withColumn("best_profit", F.max("expected_profit").over(Window.partitionBy("client_id", "product_id")))
    return best.where("discount = 0").select("client_id", "product_id", "best_profit")


def _chosen(s: S, d: str) -> D:
    return P.eligible_discounts(P.discount_scenarios(pairs(s, d), SIM), OPT)


def _rows(chosen: D, *more: str) -> D:
    return chosen.select("client_id", "product_id", *more, F.round("roi", 6).alias("roi"), F.round("incremental_profit", 6).alias("incremental_profit"), F.round("expected_discount_cost", 6).alias("cost"))


ORDER_SQL = "ORDER BY round(roi, 6) DESC, round(incremental_profit, 6) DESC, CAST(round(expected_discount_cost, 6) AS DECIMAL(20,6)), client_id, product_id"
GREEDY_SQL = f"""{CHOSEN_SQL},
prio AS (SELECT client_id, product_id, CAST(round(expected_discount_cost, 6) AS DECIMAL(20,6)) AS cost, row_number() OVER ({ORDER_SQL}) AS allocation_rank FROM chosen),
walk AS (
  SELECT 0::BIGINT AS r, 0::DECIMAL(20,6) AS spent, map([]::BIGINT[], []::INTEGER[]) AS held, NULL::VARCHAR AS decision, 0::BIGINT AS client_id, 0::BIGINT AS product_id
  UNION ALL
  SELECT p.allocation_rank,
    CASE WHEN coalesce(held[p.client_id], 0) < 2 AND spent + p.cost <= 400.0 THEN CAST(spent + p.cost AS DECIMAL(20,6)) ELSE spent END,
    CASE WHEN coalesce(held[p.client_id], 0) < 2 AND spent + p.cost <= 400.0
      THEN map_concat(held, map([p.client_id], [coalesce(held[p.client_id], 0) + 1])) ELSE held END,
    CASE WHEN coalesce(held[p.client_id], 0) >= 2 THEN 'USER_CAP_REJECTED' WHEN spent + p.cost <= 400.0 THEN 'DISCOUNT_ACCEPTED' ELSE 'BUDGET_REJECTED' END,
    p.client_id, p.product_id
  FROM walk w JOIN prio p ON p.allocation_rank = w.r + 1)"""


@query(f"WITH RECURSIVE {GREEDY_SQL} SELECT client_id, product_id, decision AS optimizer_decision, r AS allocation_rank, CAST(spent AS DOUBLE) AS budget_spent_after FROM walk WHERE r > 0")
def budget_allocation(s: S, d: str) -> D:
    out = R.budget_allocation(_rows(_chosen(s, d)), OPT.global_budget, OPT.user_cap)
    return out.select("client_id", "product_id", "optimizer_decision", "allocation_rank", F.col("budget_spent_after").cast("double").alias("budget_spent_after"))


def _offers(s: S, d: str) -> D:
    scenarios = P.discount_scenarios(pairs(s, d), SIM)
    chosen = P.eligible_discounts(scenarios, OPT)
    return P.finalize_offers(scenarios, chosen, R.budget_allocation(_rows(chosen), OPT.global_budget, OPT.user_cap))


OFFERS_SQL = f"""{GREEDY_SQL},
offers AS (
  SELECT c.*, w.decision AS optimizer_decision FROM chosen c JOIN walk w ON w.client_id = c.client_id AND w.product_id = c.product_id AND w.r > 0 AND w.decision = 'DISCOUNT_ACCEPTED'
  UNION ALL BY NAME
  SELECT s.*, coalesce(w.decision, CASE WHEN NOT is_price_available THEN 'MISSING_PRICE' ELSE 'LOCAL_BASELINE' END) AS optimizer_decision
  FROM scenarios s LEFT JOIN walk w ON w.client_id = s.client_id AND w.product_id = s.product_id AND w.r > 0
  WHERE discount = 0 AND (w.decision IS NULL OR w.decision <> 'DISCOUNT_ACCEPTED'))"""


@query(f"WITH RECURSIVE {OFFERS_SQL} SELECT client_id, product_id, discount, optimizer_decision FROM offers")
def finalize_offers(s: S, d: str) -> D:
    return _offers(s, d).select("client_id", "product_id", "discount", "optimizer_decision")


@query(f"WITH RECURSIVE {OFFERS_SQL} SELECT optimizer_decision, count(*) AS n FROM offers GROUP BY 1")
def decision_counts(s: S, d: str) -> D:
    return _offers(s, d).groupBy("optimizer_decision").agg(F.count(F.lit(1)).alias("n"))


def _plain_offers(s: S, d: str) -> D:
    """The chosen discount of each pair, or none, without a budget."""
    scenarios = P.discount_scenarios(pairs(s, d), SIM)
    chosen = P.eligible_discounts(scenarios, OPT)
    rest = scenarios.where("discount = 0").join(chosen.select("client_id", "product_id"), ["client_id", "product_id"], "left_anti")
    return chosen.unionByName(rest)


PLAIN_SQL = f"""{CHOSEN_SQL},
plain AS (SELECT * FROM chosen UNION ALL BY NAME SELECT s.* FROM scenarios s WHERE discount = 0 AND NOT EXISTS (
  SELECT 1 FROM chosen c WHERE c.client_id = s.client_id AND c.product_id = s.product_id))"""
RANKED_OFFERS_SQL = f"""{PLAIN_SQL},
tx AS (SELECT client_id, count(DISTINCT transaction_id) AS total_transactions FROM eligible GROUP BY 1),
norms AS (
  SELECT p.*, coalesce(total_transactions, 0) AS total_transactions, coalesce(level_2, 'UNKNOWN') AS ranking_level_2,
    percent_rank() OVER (PARTITION BY p.client_id ORDER BY expected_profit) AS pn, percent_rank() OVER (PARTITION BY p.client_id ORDER BY recsys_score) AS rn
  FROM plain p LEFT JOIN tx ON tx.client_id = p.client_id WHERE expected_profit IS NOT NULL),
scored AS (
  SELECT *, round(0.65::DOUBLE * pn + 0.30::DOUBLE * rn - 0.05::DOUBLE * promo_abuse_score, 9) AS final_score,
    CASE WHEN total_transactions = 0 AND source = 'global_popular' THEN 'COLD_START_POPULAR' WHEN discount > 0 THEN 'HIGH_INCREMENTAL_PROFIT'
      WHEN source = 'repeat_purchase' THEN 'REPEAT_PURCHASE' WHEN source = 'category_popular' THEN 'CATEGORY_RELEVANCE' ELSE 'ORGANIC_PURCHASE_NO_DISCOUNT' END AS reason_code
  FROM norms),
diverse AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY client_id, ranking_level_2 ORDER BY final_score DESC, expected_profit DESC, recsys_score DESC, product_id) <= 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY final_score DESC, expected_profit DESC, recsys_score DESC, product_id) AS final_rank FROM diverse QUALIFY final_rank <= 10)"""


@query(f"WITH {RANKED_OFFERS_SQL} SELECT client_id, product_id, final_score, reason_code, final_rank FROM ranked")
def rank_offers_unbudgeted(s: S, d: str) -> D:
    return K.rank_offers(_plain_offers(s, d), users(s, d), RANK).select("client_id", "product_id", "final_score", "reason_code", "final_rank")


@query(f"WITH {RANKED_OFFERS_SQL} SELECT client_id, product_id, pn AS profit_norm FROM norms")
def win_percent_rank_plain(s: S, d: str) -> D:
    rows = _plain_offers(s, d).where("expected_profit IS NOT NULL")
    return rows.select("client_id", "product_id", F.percent_rank().over(Window.partitionBy("client_id").orderBy("expected_profit")).alias("profit_norm"))


@query(f"WITH {LINES_SQL}, q AS (SELECT client_id, product_id, level_2, sum(product_quantity) AS qty FROM lines GROUP BY ALL), c AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY client_id, level_2 ORDER BY qty DESC, product_id) <= 1) SELECT client_id, product_id, level_2, row_number() OVER (PARTITION BY client_id ORDER BY qty DESC, product_id) AS final_rank FROM c QUALIFY final_rank <= 3")
def diversified_topn(s: S, d: str) -> D:
    q = lines(s, d).groupBy("client_id", "product_id", "level_2").agg(F.sum("product_quantity").alias("qty"))
    return K.diversified_topn(q, "client_id", "level_2", [F.desc("qty"), F.asc("product_id")], 1, 3).drop("qty")


@query(
    f"""WITH {RANKED_OFFERS_SQL},
lists AS (SELECT client_id, count(DISTINCT ranking_level_2) AS c, count(*) AS i FROM ranked GROUP BY 1),
tot AS (SELECT CAST(sum(CAST(expected_profit AS DECIMAL(28,9))) AS DOUBLE) AS ep, CAST(sum(CAST(incremental_profit AS DECIMAL(28,9))) AS DOUBLE) AS ip,
  CAST(sum(CAST(expected_discount_cost AS DECIMAL(28,9))) AS DOUBLE) AS sp, avg(CASE WHEN discount > 0 THEN 1.0 ELSE 0.0 END) AS ds FROM plain)
SELECT (SELECT count(*) FROM clients) AS users, count(*) AS recommended_users, round(count(*) / (SELECT count(*) FROM clients), 9) AS coverage,
  sum(i)::BIGINT AS recommendations, round(avg(i), 9) AS average_list_size, round(avg(c), 9) AS average_category_diversity,
  round(any_value(ep), 4) AS expected_profit_total, round(any_value(ip), 4) AS incremental_profit_total, round(any_value(sp), 4) AS discount_spend,
  round(any_value(ip) / any_value(sp), 6) AS promo_roi, round(any_value(ds), 9) AS selected_discount_share FROM lists, tot"""
)
def offline_kpis_unbudgeted(s: S, d: str) -> D:
    offers = _plain_offers(s, d)
    return E.offline_kpis(K.rank_offers(offers, users(s, d), RANK), offers, t.clients(s, d))


@query(f"""WITH {CHOSEN_SQL}, a AS (SELECT 'profit_aware' AS policy, count(*) AS n, round(CAST(sum(CAST(incremental_profit AS DECIMAL(28,9))) AS DOUBLE), 4) AS profit FROM chosen),
b AS (SELECT 'flat_10', count(*), round(CAST(sum(CAST(incremental_profit AS DECIMAL(28,9))) AS DOUBLE), 4) FROM scenarios WHERE discount = 0.1::DOUBLE),
c AS (SELECT 'no_discount', count(*), round(CAST(sum(CAST(incremental_profit AS DECIMAL(28,9))) AS DOUBLE), 4) FROM scenarios WHERE discount = 0)
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""")
def policies_unbudgeted(s: S, d: str) -> D:
    scenarios = P.discount_scenarios(pairs(s, d), SIM)
    total = F.round(F.sum(F.col("incremental_profit").cast("decimal(28,9)")).cast("double"), 4).alias("profit")
    one = lambda name, rows: rows.agg(F.count(F.lit(1)).alias("n"), total).select(F.lit(name).alias("policy"), "n", "profit")
    return one("profit_aware", P.eligible_discounts(scenarios, OPT)).union(one("flat_10", scenarios.where("discount = 0.1"))).union(one("no_discount", scenarios.where("discount = 0")))


# The same on the offers that the budget leaves.


def _final_sql(name: str) -> str:
    """The SQL of a query on plain offers, read from the final offers instead."""
    return SQL[name].replace(f"WITH {PLAIN_SQL}", f"WITH RECURSIVE {OFFERS_SQL}").replace("FROM plain", "FROM offers")


@query(_final_sql("rank_offers_unbudgeted"))
def rank_offers(s: S, d: str) -> D:
    return K.rank_offers(_offers(s, d), users(s, d), RANK).select("client_id", "product_id", "final_score", "reason_code", "final_rank")


@query(_final_sql("offline_kpis_unbudgeted"))
def offline_kpis(s: S, d: str) -> D:
    offers = _offers(s, d)
    return E.offline_kpis(K.rank_offers(offers, users(s, d), RANK), offers, t.clients(s, d))


#: Per policy the column that leads the order, and which eligible rows it takes.
POLICIES = {"profit_aware": ("roi", "chosen"), "flat_10": ("roi", "flat"), "top_propensity": ("p_base_purchase", "chosen"), "top_uplift": ("uplift_score", "chosen")}


def _walk_sql(name: str, lead: str, rows: str) -> str:
    first = "" if lead == "roi" else f"{lead} DESC, "
    fits = f"coalesce(held[p.client_id], 0) < {OPT.user_cap} AND spent + p.cost <= {OPT.global_budget}"
    return f"""prio_{name} AS (SELECT client_id, CAST(round(expected_discount_cost, 6) AS DECIMAL(20,6)) AS cost, round(incremental_profit, 6) AS profit, row_number() OVER ({ORDER_SQL.replace("ORDER BY ", f"ORDER BY {first}")}) AS r FROM {rows}),
walk_{name} AS (
  SELECT 0::BIGINT AS r, 0::DECIMAL(20,6) AS spent, map([]::BIGINT[], []::INTEGER[]) AS held, false AS ok, 0.0::DOUBLE AS profit
  UNION ALL
  SELECT p.r, CASE WHEN {fits} THEN CAST(spent + p.cost AS DECIMAL(20,6)) ELSE spent END,
    CASE WHEN {fits} THEN map_concat(held, map([p.client_id], [coalesce(held[p.client_id], 0) + 1])) ELSE held END, {fits}, p.profit
  FROM walk_{name} w JOIN prio_{name} p ON p.r = w.r + 1)"""


def _policy_sql(name: str, rows: str) -> str:
    return f"SELECT '{name}' AS policy, count(*) AS n, round(coalesce(CAST(sum(CAST(incremental_profit AS DECIMAL(28,9))) AS DOUBLE), 0), 4) AS profit FROM {rows}"


@query(
    f"""WITH RECURSIVE {CHOSEN_SQL}, flat AS (SELECT * FROM eligible_rows WHERE discount = 0.1::DOUBLE),
{", ".join(_walk_sql(n, *p) for n, p in POLICIES.items())}
{" UNION ALL ".join(_policy_sql(n, f"(SELECT profit AS incremental_profit FROM walk_{n} WHERE ok) x") for n in POLICIES)}
UNION ALL {_policy_sql("no_discount", "scenarios WHERE discount = 0")}"""
)
def policy_comparison(s: S, d: str) -> D:
    """Offers that each policy makes within the budget and the client cap, and their profit."""
    scenarios = materialise(P.discount_scenarios(pairs(s, d), SIM))
    offers = {"chosen": materialise(P.eligible_discounts(scenarios, OPT)), "flat": scenarios.where(P.is_eligible(OPT) & (F.col("discount") == 0.1))}
    total = F.round(F.coalesce(F.sum(F.col("incremental_profit").cast("decimal(28,9)")).cast("double"), F.lit(0.0)), 4).alias("profit")
    one = lambda name, rows: rows.agg(F.count(F.lit(1)).alias("n"), total).select(F.lit(name).alias("policy"), "n", "profit")
    out = one("no_discount", scenarios.where("discount = 0"))
    for name, (lead, rows) in POLICIES.items():
        priced = _rows(offers[rows], *([] if lead == "roi" else [lead]))
        out = out.union(one(name, R.accepted_rows(priced, OPT.global_budget, OPT.user_cap, lead=lead)))
    return out


# Data sets.

LABELS_SQL = f"""{USERS_SQL},
bought AS (SELECT DISTINCT client_id FROM purchases WHERE transaction_datetime >= TIMESTAMP '2001-01-01' AND transaction_datetime < TIMESTAMP '2001-03-02'),
labels AS (SELECT c.client_id, CAST(c.client_id % 2 AS INTEGER) AS treatment, CASE WHEN b.client_id IS NULL THEN 0 ELSE 1 END AS target FROM clients c LEFT JOIN bought b ON b.client_id = c.client_id)"""


def labels(s: S, d: str) -> D:
    bought = scans.label_scan(t.purchases(s, d), "transaction_datetime", t.CUTOFF, 60).select("client_id", F.lit(1).alias("_b")).distinct()
    return t.clients(s, d).select("client_id").join(bought, "client_id", "left").select("client_id", (F.col("client_id") % 2).cast("int").alias("treatment"), F.coalesce("_b", F.lit(0)).alias("target"))


def _seeded(seed: int, *columns: str) -> str:
    return f"md5(concat_ws('|', '{seed}', {', '.join(f'CAST({c} AS VARCHAR)' for c in columns)}))"


SPLIT_SQL = f"""{LABELS_SQL},
split AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY treatment, target ORDER BY {_seeded(5, "client_id")}) <= least(count(*) OVER (PARTITION BY treatment, target) - 1, greatest(1, floor(count(*) OVER (PARTITION BY treatment, target) * 0.2 + 0.5)))
    THEN 'validation' ELSE 'train' END AS split FROM labels)"""


@query(f"WITH {SPLIT_SQL} SELECT client_id, treatment, target, split FROM split")
def stratified_split(s: S, d: str) -> D:
    return G.stratified_split(labels(s, d), "client_id", ["treatment", "target"], 0.2, 5).select("client_id", "treatment", "target", "split")


@query(f"WITH {SPLIT_SQL} SELECT client_id, split, treatment, target, total_transactions, favorite_category_l2 FROM split JOIN users USING (client_id)")
def uplift_dataset(s: S, d: str) -> D:
    return G.uplift_dataset(labels(s, d), users(s, d), 0.2, 5).select("client_id", "split", "treatment", "target", "total_transactions", "favorite_category_l2")


@query(f"WITH {LABELS_SQL} SELECT client_id, treatment, target, count(*) OVER (PARTITION BY treatment, target) AS stratum_size FROM labels")
def win_partition_count(s: S, d: str) -> D:
    return G.stratum_sizes(labels(s, d), ["treatment", "target"]).select("client_id", "treatment", "target", "stratum_size")


@query(f"WITH {SPLIT_SQL}, r AS (SELECT split, count(*) FILTER (treatment = 0) AS n_0, count(*) FILTER (treatment = 1) AS n_1, avg(target) FILTER (treatment = 0) AS a, avg(target) FILTER (treatment = 1) AS b FROM split GROUP BY 1) SELECT split, n_0, n_1, round(a, 9) AS rate_0, round(b, 9) AS rate_1, round(b - a, 9) AS uplift FROM r")
def uplift_group_rates(s: S, d: str) -> D:
    return G.uplift_group_rates(G.stratified_split(labels(s, d), "client_id", ["treatment", "target"], 0.2, 5))


@query(f"WITH {LABELS_SQL} SELECT treatment, count(*) AS n, round(avg(target), 9) AS target_rate, round(CAST(avg(CAST(u.age AS DECIMAL(18,4))) AS DOUBLE), 6) AS age_mean, round(avg(CASE WHEN gender = 'HOUSEHOLD' THEN 1 ELSE 0 END), 9) AS gender_share FROM labels JOIN clients u USING (client_id) GROUP BY 1")
def treatment_balance(s: S, d: str) -> D:
    return G.treatment_balance(labels(s, d).join(t.clients(s, d), "client_id"), "age", "gender", "HOUSEHOLD")


@query(f"""WITH {LABELS_SQL}, arms AS (SELECT treatment, target, CAST(CAST(u.age AS DECIMAL(18,4)) AS DOUBLE) AS age, gender FROM labels JOIN clients u USING (client_id)),
w AS (SELECT avg(target) FILTER (treatment = 0) AS t0, avg(target) FILTER (treatment = 1) AS t1, avg(age) FILTER (treatment = 0) AS m0, avg(age) FILTER (treatment = 1) AS m1,
  sqrt((var_samp(age) FILTER (treatment = 0) + var_samp(age) FILTER (treatment = 1)) / 2) AS pooled, count(*) FILTER (treatment = 0) AS n0, count(*) FILTER (treatment = 1) AS n1 FROM arms),
g AS (SELECT gender, count(*) FILTER (treatment = 0) AS g0, count(*) FILTER (treatment = 1) AS g1 FROM arms GROUP BY 1),
rows AS (SELECT 'target_rate' AS measure, NULL AS value, t0 AS control, t1 AS treatment, t1 - t0 AS difference FROM w
  UNION ALL SELECT 'age_smd', NULL, m0, m1, (m1 - m0) / pooled FROM w UNION ALL SELECT 'gender_share', gender, g0 / n0, g1 / n1, g1 / n1 - g0 / n0 FROM g, w)
SELECT measure, value, round(control, 6) AS control, round(treatment, 6) AS treatment, round(difference, 6) AS difference FROM rows""")
def treatment_differences(s: S, d: str) -> D:
    out = G.treatment_differences(labels(s, d).join(t.clients(s, d), "client_id"), "age", "gender")
    return out.select("measure", "value", *(F.round(c, 6).alias(c) for c in ("control", "treatment", "difference")))


NUMERIC = ["total_transactions", "purchases_90d", "avg_check", "days_since_last_purchase"]


def _smd(c: str) -> str:
    return f"""SELECT '{c}' AS feature, avg({c}) FILTER (treatment = 0) AS m0, avg({c}) FILTER (treatment = 1) AS m1, coalesce(var_samp({c}) FILTER (treatment = 0), 0) AS v0,
  coalesce(var_samp({c}) FILTER (treatment = 1), 0) AS v1, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FILTER (treatment = 0) AS x0, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FILTER (treatment = 1) AS x1 FROM arms"""


@query(
    f"""WITH {LABELS_SQL}, arms AS (SELECT * FROM labels JOIN users USING (client_id)), m AS ({" UNION ALL ".join(map(_smd, NUMERIC))}),
f AS (SELECT *, round(CASE WHEN (v0 + v1) / 2 > 0 THEN (m1 - m0) / sqrt((v0 + v1) / 2) WHEN m0 = m1 THEN 0.0 END, 6) AS smd FROM m)
SELECT feature, smd, CASE WHEN smd IS NULL THEN 'SMD_UNDEFINED' WHEN abs(smd) > 0.05 THEN 'SMD_ABOVE_THRESHOLD' END AS warning, round(x0, 9) AS missing_control, round(x1, 9) AS missing_treatment FROM f"""
)
def smd_report(s: S, d: str) -> D:
    return G.smd_report(labels(s, d).join(users(s, d), "client_id"), NUMERIC, 0.05).withColumn("smd", F.round("smd", 6))


@query(
    f"""WITH {LABELS_SQL}, long AS (SELECT treatment, 'gender' AS feature, gender AS value FROM labels JOIN users USING (client_id) UNION ALL
  SELECT treatment, 'favorite_category_l2', favorite_category_l2 FROM labels JOIN users USING (client_id)),
c AS (SELECT treatment, feature, value, count(*) AS n FROM long GROUP BY ALL)
SELECT treatment, feature, value, n, round(n / sum(n) OVER (PARTITION BY treatment, feature), 9) AS share,
  row_number() OVER (PARTITION BY treatment, feature ORDER BY n DESC, value NULLS LAST) AS rank FROM c QUALIFY rank <= 5"""
)
def categorical_top_values(s: S, d: str) -> D:
    return G.categorical_top_values(labels(s, d).join(users(s, d), "client_id"), ["gender", "favorite_category_l2"], 5)


OBS_SQL = f"""{LINES_SQL},
w1 AS (SELECT DISTINCT client_id, product_id FROM purchases WHERE transaction_datetime >= TIMESTAMP '2000-07-05' AND transaction_datetime < TIMESTAMP '2001-01-01'),
w0 AS (SELECT DISTINCT client_id, product_id FROM purchases WHERE transaction_datetime >= TIMESTAMP '2000-04-04' AND transaction_datetime < TIMESTAMP '2000-10-01'),
l1 AS (SELECT DISTINCT client_id, product_id FROM purchases WHERE transaction_datetime >= TIMESTAMP '2001-01-01' AND transaction_datetime < TIMESTAMP '2001-04-01'),
l0 AS (SELECT DISTINCT client_id, product_id FROM purchases WHERE transaction_datetime >= TIMESTAMP '2000-10-01' AND transaction_datetime < TIMESTAMP '2000-12-30'),
observations AS (
  SELECT w.client_id, w.product_id, CASE WHEN l.client_id IS NULL THEN 0 ELSE 1 END AS label, TIMESTAMP '2001-01-01' AS cutoff, 'validation' AS split
  FROM w1 w LEFT JOIN l1 l ON l.client_id = w.client_id AND l.product_id = w.product_id
  UNION ALL SELECT w.client_id, w.product_id, CASE WHEN l.client_id IS NULL THEN 0 ELSE 1 END, TIMESTAMP '2000-10-01', 'train'
  FROM w0 w LEFT JOIN l0 l ON l.client_id = w.client_id AND l.product_id = w.product_id)"""


CUTOFFS = [datetime(2000, 10, 1), t.CUTOFF]


def observations(s: S, d: str) -> D:
    p = t.purchases(s, d)
    by = {c: scans.interval_scan(p, "transaction_datetime", c, 180).select("client_id", "product_id").distinct() for c in CUTOFFS}
    return G.temporal_observations(by, p, 90)


@query(f"WITH {OBS_SQL} SELECT * FROM observations")
def temporal_observations(s: S, d: str) -> D:
    return observations(s, d)


@query(f"""WITH {OBS_SQL}, c AS (SELECT cutoff, count(*) AS n_candidates, count(*) FILTER (label = 1) AS n_inside FROM observations GROUP BY 1)
SELECT cutoff, n_candidates, n_inside, (SELECT count(*) FROM l1) - n_inside AS n_outside FROM c WHERE cutoff = TIMESTAMP '2001-01-01'
UNION ALL SELECT cutoff, n_candidates, n_inside, (SELECT count(*) FROM l0) - n_inside FROM c WHERE cutoff = TIMESTAMP '2000-10-01'""")
def positives_outside(s: S, d: str) -> D:
    """Per cutoff: candidates, those that were bought in the label window, and purchases of that window that are no candidates."""
    p = t.purchases(s, d)
    by = {c: scans.interval_scan(p, "transaction_datetime", c, 180).select("client_id", "product_id").distinct() for c in CUTOFFS}
    outside = [G.positives_outside(by[c], p, c, 90).agg(F.count(F.lit(1)).alias("n_outside")).withColumn("cutoff", F.lit(c).cast("timestamp_ntz")) for c in CUTOFFS]
    inside = observations(s, d).groupBy(F.col("cutoff").cast("timestamp_ntz").alias("cutoff")).agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if(F.col("label") == 1).alias("n_inside"))
    return inside.join(outside[0].union(outside[1]), "cutoff")


@query(f"WITH {OBS_SQL}, q AS (SELECT split, ceil(count(*) FILTER (label = 1) * 20.0) AS quota FROM observations GROUP BY 1) SELECT client_id, product_id, label, cutoff, split FROM observations WHERE label = 1 UNION ALL SELECT client_id, product_id, label, cutoff, split FROM (SELECT o.*, row_number() OVER (PARTITION BY split ORDER BY {_seeded(3, 'client_id', 'product_id')}) AS r FROM observations o WHERE label = 0) x JOIN q USING (split) WHERE r <= quota")
def negative_sampling(s: S, d: str) -> D:
    return G.negative_sampling(observations(s, d), ["client_id", "product_id"], 20.0, 3)


@query(f"WITH {LABELS_SQL} SELECT client_id, treatment FROM labels QUALIFY row_number() OVER (PARTITION BY treatment ORDER BY {_seeded(9, 'client_id')}) <= 100")
def hash_ordered_sample(s: S, d: str) -> D:
    return G.hash_ordered_sample(labels(s, d), ["client_id"], ["treatment"], 100, 9).select("client_id", "treatment")


CAP_SQL = f"""{LABELS_SQL}, n AS (SELECT target AS label, count(*) AS n FROM labels GROUP BY 1),
sides AS (SELECT coalesce(max(n) FILTER (label = 0), 0) AS a, coalesce(max(n) FILTER (label = 1), 0) AS b FROM n),
ones AS (SELECT a, b, CASE WHEN a + b <= 500 THEN b ELSE greatest(500 - a, least(b, 500 - least(a, 1), greatest(1, round_even(500 * b / (a + b), 0)))) END AS q FROM sides),
quotas AS (SELECT label, n, CASE WHEN label = 1 THEN q ELSE least(n, 500 - q) END::BIGINT AS quota FROM n, ones)"""


@query(f"WITH {CAP_SQL} SELECT client_id, target AS label FROM labels JOIN quotas ON target = label QUALIFY row_number() OVER (PARTITION BY target ORDER BY {_seeded(4, 'client_id')}) <= quota")
def stratified_cap(s: S, d: str) -> D:
    return G.stratified_cap(labels(s, d).select("client_id", F.col("target").alias("label")), ["client_id"], 500, 4)


@query(f"WITH {CAP_SQL} SELECT label, n, quota FROM quotas")
def join_quota(s: S, d: str) -> D:
    return G.label_quotas(labels(s, d).select(F.col("target").alias("label")), 500)


@query("SELECT p_partkey AS product_id, p_type AS level_2, p_brand AS level_3, p_size AS level_4 FROM part")
def column_subset_dynamic(s: S, d: str) -> D:
    return G.column_subset(t.products(s, d), {"is_alcohol", "netto"})


@query("SELECT c_custkey AS client_id, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer")
def stable_order_export(s: S, d: str) -> D:
    rows = t.clients(s, d)
    return R.global_row_number(rows, "age", [F.desc("age"), F.asc("client_id")], "place", descending=True, second=F.col("client_id")).select("client_id", "place")


@query("SELECT c_custkey AS client_id, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) OVER (ORDER BY c_acctbal DESC, c_custkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM customer")
def win_running_sum(s: S, d: str) -> D:
    out = R.running(t.clients(s, d), "age", [F.desc("age"), F.asc("client_id")], {"running": F.col("age").cast("decimal(18,2)")}, descending=True, second=F.col("client_id"))
    return out.select("client_id", F.col("running").cast("double").alias("running"))


# Evaluation on surrogate scores.

SCORED_SQL = f"""{LABELS_SQL}, scored AS (SELECT client_id AS id, target AS label, treatment, (client_id * 7 % 101) / 100.0::DOUBLE AS score FROM labels)"""


def scored(s: S, d: str) -> D:
    return labels(s, d).select(F.col("client_id").alias("id"), F.col("target").alias("label"), "treatment", ((F.col("client_id") * 7) % 101 / F.lit(100.0)).alias("score"))


@query(f"WITH {SCORED_SQL}, b AS (SELECT least(floor(score * 10), 9)::INTEGER AS bin, count(*) AS n, avg(score) AS s, avg(label) AS l FROM scored GROUP BY 1) SELECT r.bin::INTEGER AS bin, coalesce(n, 0) AS n, round(s, 9) AS mean_score, round(l, 9) AS positive_rate FROM (SELECT unnest(range(10)) AS bin) r LEFT JOIN b ON b.bin = r.bin")
def calibration_bins(s: S, d: str) -> D:
    return E.calibration_bins(scored(s, d), 10)


@query(
    f"""WITH {SCORED_SQL}, g AS (SELECT score, sum(label) AS p, count(*) AS n FROM scored GROUP BY 1),
c AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS al, sum(p) OVER () AS pos, sum(n) OVER () AS tot FROM g)
SELECT round(sum((n - p) * (tp - p + p / 2.0::DOUBLE)) / any_value(pos * (tot - pos)), 6) AS roc_auc, round(sum(p * tp / al) / any_value(pos), 6) AS average_precision,
  (SELECT round(avg(-(label * ln(least(1 - 1e-15, greatest(1e-15, score))) + (1 - label) * ln(1 - least(1 - 1e-15, greatest(1e-15, score))))), 6) FROM scored) AS log_loss,
  (SELECT round(avg((score - label) ** 2), 6) FROM scored) AS brier FROM c"""
)
def classification_metrics(s: S, d: str) -> D:
    return E.classification_metrics(scored(s, d))


CURVE_SQL = f"""{SCORED_SQL},
o AS (SELECT row_number() OVER w AS k, sum(treatment) OVER w AS nt, sum(label * treatment) OVER w AS t, sum(label * (1 - treatment)) OVER w AS c, count(*) OVER () AS n
  FROM scored WINDOW w AS (ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING)),
cuts AS (SELECT DISTINCT least(n, greatest(1, ceil(n * i / 100.0)))::BIGINT AS k FROM (SELECT count(*) AS n FROM scored), (SELECT unnest(range(1, 101)) AS i)),
curve AS (SELECT 0::BIGINT AS rows, 0.0::DOUBLE AS population_fraction, 0.0::DOUBLE AS gain UNION ALL
  SELECT k, k / n, t - c * nt / (k - nt) FROM o JOIN cuts USING (k) WHERE nt > 0 AND nt < k)"""


@query(f"WITH {CURVE_SQL} SELECT rows, round(population_fraction, 9) AS population_fraction, round(gain, 6) AS gain FROM curve")
def uplift_curve(s: S, d: str) -> D:
    return E.uplift_curve(scored(s, d)).select("rows", F.round("population_fraction", 9).alias("population_fraction"), F.round("gain", 6).alias("gain"))


@query(f"WITH {CURVE_SQL}, st AS (SELECT (population_fraction - lag(population_fraction) OVER (ORDER BY rows)) * (gain + lag(gain) OVER (ORDER BY rows)) / 2 AS a, rows, gain FROM curve), z AS (SELECT sum(a) AS auuc, arg_max(gain, rows) / 2 AS half FROM st) SELECT round(auuc, 6) AS auuc, round(half, 6) AS random_baseline_area, round(auuc - half, 6) AS qini FROM z")
def auuc_qini(s: S, d: str) -> D:
    return E.auuc_qini(E.uplift_curve(scored(s, d)))


@query(f"WITH {CURVE_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS k, count(*) OVER () AS n FROM scored) SELECT f.fraction, round(avg(label) FILTER (treatment = 1) - avg(label) FILTER (treatment = 0), 9) AS uplift FROM r JOIN (VALUES (0.1::DOUBLE), (0.2), (0.3)) f(fraction) ON k <= greatest(1, ceil(n * f.fraction)) GROUP BY 1")
def uplift_at_k(s: S, d: str) -> D:
    return E.uplift_at_k(scored(s, d))


@query(f"WITH {SCORED_SQL} SELECT quantile_disc(score, 0.01) AS p01, quantile_disc(score, 0.05) AS p05, quantile_disc(score, 0.5) AS p50, quantile_disc(score, 0.95) AS p95, quantile_disc(score, 0.99) AS p99, round(avg(CASE WHEN score < 0.1 OR score > 0.9 THEN 1 ELSE 0 END), 9) AS outside_share FROM scored")
def overlap_diagnostics(s: S, d: str) -> D:
    return E.overlap_diagnostics(scored(s, d))


@query(f"WITH {PAIRS_SQL} SELECT (SELECT round(avg(uplift_score), 9) FROM scores) AS mean_uplift, (SELECT round(avg(CASE WHEN uplift_score < 0 THEN 1 ELSE 0 END), 9) FROM scores) AS negative_share, round(avg(p_base_purchase), 9) AS mean_propensity FROM pairs")
def score_summary(s: S, d: str) -> D:
    return E.score_summary(pairs(s, d), scores(s, d))


# Models: no SQL can fit them.

KEYS = {"client_id", "product_id", "cutoff", "split", "label", "treatment", "target"}


def pair_rows(s: S, d: str, cutoff: datetime, purchases: D | None = None, split: str = "train", label_days: int = 90) -> D:
    """The labelled candidates of a cutoff with the pair, client and item features of the lines before it.

    Each table is written once, as one plan of all of them takes too much of the driver. The history of pairs, their labels and the features of
    clients join the candidates where these are dealt by client; wide rows are dealt once more, by item.
    """
    everyone, purchases = t.clients(s, d), t.purchases(s, d) if purchases is None else purchases
    before = materialise(lines(s, d, cutoff, purchases))
    clients = f.user_features(everyone, before, cutoff)
    columns = [c for c in clients.columns if c != "client_id"]
    clients = materialise(clients.join(spread(f.affinity_maps(before)), "client_id", "left"))
    products = materialise(f.item_features(t.products(s, d), before.drop("level_2"), MARGINS, 0.25))
    known = f.pair_history(before).unionByName(G.bought_pairs(purchases, cutoff, label_days), allowMissingColumns=True)
    found = C.candidates_top50(everyone, products, before, cutoff, facts=known).withColumn("candidate_sources", F.concat_ws("|", "candidate_sources"))
    found = materialise(found.drop("best_source_score").join(spread(clients), "client_id"))
    goods = materialise(products.join(spread(f.popularity_norm(products).select("product_id", "item_popularity_norm")), "product_id"))
    sources = ["candidate_sources", "candidate_rank", "recsys_score"]
    features = f.pair_columns(F.try_element_at("_affinities", F.col("level_2")), cutoff)
    return found.join(spread(goods), "product_id").select(
        "client_id", "product_id", *features, *sources, *columns, *(c for c in products.columns if c != "product_id"), *G.label_columns(cutoff, split)
    )


def _training(s: S, d: str) -> D:
    """Labelled candidates of both cutoffs, each with the features of its own window; the last one is for validation.

    Purchases from the first window to the last label are read and joined once.
    """
    first, last = G.validate_cutoffs(sorted(CUTOFFS), 90)
    end = last + timedelta(days=90)
    purchases = materialise(scans.interval_scan(t.purchases(s, d), "transaction_datetime", end, (end - first).days + 180))
    return materialise(pair_rows(s, d, first, purchases).unionByName(pair_rows(s, d, last, purchases, "validation")))


PAIR_KEYS = ["client_id", "product_id", "cutoff"]


@query()
def train_propensity(s: S, d: str) -> D:
    """The report of the fitted model: rows, best number of trees, validation metrics and calibration bins."""
    rows = _training(s, d)
    return M.fit_propensity(rows, M.feature_manifest(rows, KEYS), PAIR_KEYS)[1]


@query()
def score_propensity(s: S, d: str) -> D:
    rows = _training(s, d)
    manifest = M.feature_manifest(rows, KEYS)
    return M.fitted_scores(rows, manifest, ["client_id", "product_id", "split"])


def _arms(s: S, d: str) -> D:
    """Labelled clients with their features, written once, as the fits read them many times."""
    return materialise(G.uplift_dataset(labels(s, d), users(s, d).select("client_id", "gender", "age", "total_transactions", "avg_check"), 0.2, 5))


def _uplift(s: S, d: str) -> D:
    rows = _arms(s, d)
    manifest = M.feature_manifest(rows, KEYS)
    return M.score_uplift(rows, M.train_t_learner(rows, manifest), manifest)


@query()
def score_uplift(s: S, d: str) -> D:
    return _uplift(s, d).select("client_id", "split", "p_control", "p_treatment", "uplift_score")


@query()
def train_t_learner(s: S, d: str) -> D:
    """Uplift at fractions on the validation rows."""
    rows = materialise(_uplift(s, d).where("split = 'validation'").select(F.col("client_id").alias("id"), F.col("target").alias("label"), "treatment", F.col("uplift_score").alias("score")))
    return E.uplift_at_k(rows, (0.1, 0.2, 0.3))


@query(f"WITH {USERS_SQL} SELECT client_id, round(least(1.0, purchases_90d / 10.0::DOUBLE), 9) AS score FROM users")
def score_with_pandas_model(s: S, d: str) -> D:
    return M.score_with_pandas_model(users(s, d), lambda x: (x["purchases_90d"] / 10.0).clip(upper=1.0), ["client_id"], ["purchases_90d"]).withColumn("score", F.round("score", 9))


@query()
def t_learner_report(s: S, d: str) -> D:
    """Per arm: rows, trees, label weights and validation metrics."""
    rows = _arms(s, d)
    manifest = M.feature_manifest(rows, KEYS)
    return M.arm_report(rows, M.train_t_learner(rows, manifest), manifest)


@query()
def treatment_overlap(s: S, d: str) -> D:
    """Whether a fitted classifier can tell the arms apart."""
    rows = _arms(s, d)
    return M.treatment_overlap(rows, M.feature_manifest(rows, KEYS))


MANIFEST = (
    ("gender", "string"), ("age", "double"), ("total_transactions", "bigint"), ("total_spent", "double"), ("purchases_7d", "bigint"),
    ("purchases_30d", "bigint"), ("purchases_90d", "bigint"), ("promo_sensitivity_proxy", "double"), ("avg_check", "double"),
    ("days_since_last_purchase", "int"), ("purchase_frequency_30d", "double"), ("redeemed_points_share", "double"), ("total_items", "double"),
    ("category_diversity", "bigint"), ("avg_item_price", "double"), ("favorite_category_l2", "string"),
)


@query(
    f"WITH {USERS_SQL} "
    + " UNION ALL ".join(
        f"SELECT {k} AS position, '{c}' AS name, '{kind}' AS type, {kind == 'string'} AS categorical, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct FROM users"
        for k, (c, kind) in enumerate(MANIFEST)
    )
)
def feature_manifest(s: S, d: str) -> D:
    """The ordered features of clients with their types, and how many values each has."""
    rows = users(s, d)
    manifest = M.feature_manifest(rows, KEYS)
    M.require_manifest(rows, manifest)
    wide = rows.agg(*(x for k, m in enumerate(manifest) for x in (F.count(m["name"]).alias(f"n{k}"), F.countDistinct(m["name"]).alias(f"d{k}"))))
    found = F.array(*(
        F.struct(F.lit(k).alias("position"), F.lit(m["name"]).alias("name"), F.lit(m["type"]).alias("type"), F.lit(m["categorical"]).alias("categorical"), F.col(f"n{k}").alias("n_values"), F.col(f"d{k}").alias("n_distinct"))
        for k, m in enumerate(manifest)
    ))
    return wide.select(F.explode(found).alias("m")).select("m.*")


# Streams over the events, run to the end of what is there.


def _staged(s: S, d: str) -> tuple[str, str]:
    """Events as files of their own, and a checkpoint folder."""
    base = f"{shared_dir(s)}/stream-{uuid.uuid4().hex}"
    t.feedback(s, d).repartition(4, "event_id").write.parquet(f"{base}/in")
    return base, f"{base}/in"


@query(f"WITH {t.FEEDBACK_SQL} SELECT event_type, count(*) AS n FROM feedback GROUP BY 1")
def stream_feedback_ingest(s: S, d: str) -> D:
    base, source = _staged(s, d)
    stream = st.stream_feedback_ingest(s, source, s.read.parquet(source).schema, 2)
    st.run_to_table(stream, f"{base}/out", f"{base}/ck")
    return s.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {t.FEEDBACK_SQL} SELECT DISTINCT event_id, event_fingerprint FROM feedback")
def stream_dedup(s: S, d: str) -> D:
    base, source = _staged(s, d)
    s.read.parquet(source).write.mode("append").parquet(source + "2")
    s.read.parquet(source).write.mode("append").parquet(source + "2")
    stream = st.stream_feedback_ingest(s, source + "2", s.read.parquet(source).schema, 1000)
    st.run_to_table(st.stream_dedup(stream, "60 days"), f"{base}/out", f"{base}/ck")
    return s.read.parquet(f"{base}/out").select("event_id", "event_fingerprint")


PREDICTIONS_SQL = f"""{t.FEEDBACK_SQL},
shown AS (SELECT event_id, client_id, k % 100 AS product_id, shown_discount, CASE WHEN k % 10 <> 0 THEN event_id END AS request_id FROM feedback)"""


@query(f"WITH {PREDICTIONS_SQL} SELECT event_id, CASE WHEN request_id IS NULL THEN 'UNVERIFIED_MISSING_REQUEST' WHEN product_id % 7 = 0 THEN 'REJECTED_MISMATCH' ELSE 'VERIFIED' END AS status FROM shown")
def stream_verify(s: S, d: str) -> D:
    """Events against the lists shown; each seventh product was shown at another discount."""
    base, source = _staged(s, d)
    k = F.col("k")
    shape = lambda f: f.withColumns({"product_id": k.cast("long"), "request_id": F.when(k % 10 != 0, F.col("event_id")), "shown_discount": F.col("shown_discount").cast("double")})
    seen = shape(s.read.parquet(source)).select(F.col("event_id").alias("request_id"), "client_id", F.to_json(F.array(F.struct("product_id", F.when(F.col("product_id") % 7 == 0, 0.5).otherwise(F.col("shown_discount")).alias("discount")))).alias("payload"))
    stream = shape(st.stream_feedback_ingest(s, source, s.read.parquet(source).schema))
    st.run_to_table(st.verify(stream, seen).select("event_id", "status"), f"{base}/out", f"{base}/ck")
    return s.read.parquet(f"{base}/out")


@query(f"WITH {PREDICTIONS_SQL} SELECT event_id, CASE WHEN request_id IS NULL OR event_id % 11 = 0 THEN 'UNVERIFIED_MISSING_REQUEST' WHEN product_id % 7 = 0 THEN 'REJECTED_MISMATCH' ELSE 'VERIFIED' END AS status FROM shown")
def stream_verify_lists(s: S, d: str) -> D:
    """The same with lists that come as a stream, an hour before their event; of each eleventh event the list never comes."""
    base, source = _staged(s, d)
    k = F.col("k")
    events = s.read.parquet(source).withColumns({"product_id": k.cast("long"), "request_id": F.when(k % 10 != 0, F.col("event_id")), "shown_discount": F.col("shown_discount").cast("double")})
    payload = F.to_json(F.array(F.struct("product_id", F.when(F.col("product_id") % 7 == 0, 0.5).otherwise(F.col("shown_discount")).alias("discount"))))
    lists = events.select(F.col("event_id").alias("request_id"), "client_id", payload.alias("payload"), (F.col("created_at") - F.make_dt_interval(hours=F.lit(1))).alias("shown_at"))
    events.drop("event_date").write.parquet(f"{base}/events")
    lists.where("request_id % 11 <> 0").write.parquet(f"{base}/lists")
    schemas = {n: s.read.parquet(f"{base}/{n}").schema for n in ("events", "lists")}

    def run() -> None:
        read = {n: st.stream_feedback_ingest(s, f"{base}/{n}", x, 1000) for n, x in schemas.items()}
        st.run_to_table(st.stream_verify(read["events"], read["lists"], "1 day", "60 days").select("event_id", "status"), f"{base}/out", f"{base}/ck")

    run()
    # Later rows move both watermarks past all that waits; they belong to no event of the tables.
    ends, least = events.agg(F.max("created_at"), F.min("event_id")).first()
    for years in (1, 2):
        at = F.lit(ends).cast(events.schema["created_at"].dataType) + F.make_interval(years=F.lit(years))
        events.drop("event_date").limit(1).withColumns({"event_id": F.lit(least - years).cast("long"), "created_at": at}).write.mode("append").parquet(f"{base}/events")
        lists.limit(1).withColumns({"request_id": F.lit(least - years).cast("long"), "shown_at": at}).write.mode("append").parquet(f"{base}/lists")
        run()
    return s.read.parquet(f"{base}/out").where(F.col("event_id") >= least)


@query(f"WITH {t.FEEDBACK_SQL} SELECT received_at >= TIMESTAMP '2024-01-25' AS is_late, count(*) AS n_events FROM feedback WHERE created_at >= TIMESTAMP '2024-01-05' AND created_at < TIMESTAMP '2024-01-25' GROUP BY 1")
def stream_late_audit(s: S, d: str) -> D:
    base, source = _staged(s, d)
    stream = st.stream_feedback_ingest(s, source, s.read.parquet(source).schema, 1000)
    st.run_to_table(st.stream_late_audit(stream, t.EVENT_CUTOFF, 20), f"{base}/out", f"{base}/ck", "complete")
    return s.read.parquet(f"{base}/out")


_TWICE_SQL = f"""{t.FEEDBACK_SQL}, twice AS (
  SELECT event_id, event_fingerprint, received_at FROM feedback
  UNION ALL SELECT event_id, event_fingerprint || 'x', received_at + INTERVAL 1 DAY FROM feedback WHERE event_id % 50 = 0
  UNION ALL SELECT event_id, event_fingerprint, received_at + INTERVAL 2 DAY FROM feedback WHERE event_id % 75 = 0)"""


def _versions(s: S, d: str) -> D:
    """Events of which every fiftieth comes again with another fingerprint a day later, and every 75th as it was two days later."""
    base, source = _staged(s, d)
    schema = s.read.parquet(source).schema
    for every, mark, days in ((50, "x", 1), (75, "", 2)):
        again = t.feedback(s, d).where(F.col("event_id") % every == 0)
        again.withColumns({"event_fingerprint": F.concat("event_fingerprint", F.lit(mark)), "received_at": F.col("received_at") + F.make_dt_interval(days=F.lit(days))}).write.mode("append").parquet(source)
    stream = st.stream_feedback_ingest(s, source, schema, 3)
    st.run_to_table(st.stream_versions(stream, "60 days", timedelta(days=90)), f"{base}/out", f"{base}/ck")
    return s.read.parquet(f"{base}/out")


@query(f"WITH {_TWICE_SQL} SELECT event_id, count(DISTINCT event_fingerprint) AS n_versions, count(*) AS n_rows FROM twice GROUP BY 1 HAVING count(DISTINCT event_fingerprint) > 1")
def stream_conflicts(s: S, d: str) -> D:
    """The events that came with several fingerprints, from what the stream says of each row."""
    rows = _versions(s, d)
    several = rows.groupBy("event_id").agg(F.countDistinct("event_fingerprint").alias("n_versions"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("status") == "conflict").alias("n"))
    return several.where("n > 0").drop("n")


@query(f"""WITH {_TWICE_SQL}, c AS (SELECT event_id, count(DISTINCT event_fingerprint) AS v, count(*) AS n FROM twice GROUP BY 1)
SELECT event_id, n AS n_rows, v > 1 AS in_conflict FROM c""")
def stream_versions(s: S, d: str) -> D:
    """Per event how many rows came, and whether one of them was in conflict with the first."""
    rows = _versions(s, d)
    whole = rows.groupBy("event_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max("n_seen").alias("seen"), F.count_if(F.col("status") == "new").alias("n_new"), (F.count_if(F.col("status") == "conflict") > 0).alias("in_conflict"))
    return whole.where("n_rows = seen AND n_new = 1").select("event_id", "n_rows", "in_conflict")


@query(f"WITH {t.FEEDBACK_SQL} SELECT event_date, count(*) AS n FROM feedback GROUP BY 1")
def stream_partition_merge(s: S, d: str) -> D:
    base, source = _staged(s, d)
    stream = st.stream_feedback_ingest(s, source, s.read.parquet(source).schema, 2)
    st.stream_partition_merge(stream, f"{base}/out", f"{base}/ck").awaitTermination()
    return s.read.parquet(f"{base}/out").groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {t.FEEDBACK_SQL}, w AS (SELECT event_date, min(event_id) AS a, max(event_id) AS b FROM feedback GROUP BY 1) SELECT event_date, substr(sha256(concat_ws('|', CAST(a AS VARCHAR), CAST(b AS VARCHAR))), 1, 32) AS batch_id FROM w")
def batch_id(s: S, d: str) -> D:
    marks = t.feedback(s, d).groupBy("event_date").agg(F.min("event_id").cast("string").alias("a"), F.max("event_id").cast("string").alias("b"))
    return marks.select("event_date", X.batch_id(F.col("a"), F.col("b")).alias("batch_id"))
