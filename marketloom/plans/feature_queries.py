"""Queries of features, candidates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import expressions as X
from marketloom.operators import candidates as C
from marketloom.operators import features as f
from marketloom.operators.distributed import global_percent_rank, running
from marketloom.plans.base import (
    AGE_SQL, CATEGORY_SQL, ITEMS_SQL, LINE_FEATURES_SQL, LINES_SQL, PRICES_SQL, RECEIPT_FEATURES_SQL, RECEIPTS_SQL, USERS_SQL, eligible, items, lines, query, stored, users,
)
from marketloom.sources import tables as t
from marketloom.sources.shared import materialise

S, D = SparkSession, DataFrame


@query(f"WITH {LINES_SQL}, {RECEIPTS_SQL} SELECT * FROM receipts")
def receipt_rollup(s: S, d: str) -> D:
    return f.receipt_rollup(eligible(s, d))


@query(f"WITH {USERS_SQL} SELECT * FROM users")
def user_features(s: S, d: str) -> D:
    return users(s, d)


@query(f"WITH {ITEMS_SQL} SELECT * FROM items")
def item_features(s: S, d: str) -> D:
    return items(s, d)


@query(f"WITH {ITEMS_SQL} SELECT * FROM repeats")
def repeat_rate(s: S, d: str) -> D:
    return f.repeat_rate(eligible(s, d))


def _prices(s: S, d: str) -> D:
    return materialise(f.price_observations(lines(s, d).drop("level_2"), t.products(s, d)))


@query(f"WITH {LINES_SQL}, {PRICES_SQL} SELECT product_id, unit_price, level_2, level_3 FROM filtered")
def price_outlier_filter(s: S, d: str) -> D:
    return f.price_outlier_filter(_prices(s, d)).select("product_id", "unit_price", "level_2", "level_3")


@query(f"WITH {LINES_SQL}, {PRICES_SQL} SELECT product_id, level_2, level_3, quantile_disc(unit_price, 0.5) AS median_price FROM filtered GROUP BY GROUPING SETS ((product_id), (level_2, level_3), (level_2))")
def hierarchical_median_price(s: S, d: str) -> D:
    prices = f.price_outlier_filter(_prices(s, d))
    return f.hierarchical_median_price(prices).select("product_id", "level_2", "level_3", "median_price")


@query(f"WITH {LINES_SQL}, {CATEGORY_SQL} SELECT * FROM affinity")
def category_affinity(s: S, d: str) -> D:
    return f.category_affinity(lines(s, d))


NORM_SQL = """norms AS (SELECT product_id, level_2, median_unit_price,
  CASE WHEN max(popularity_rank_l2) OVER (PARTITION BY level_2) <= 1 THEN 1.0::DOUBLE
    ELSE 1.0::DOUBLE - (popularity_rank_l2 - 1) / (max(popularity_rank_l2) OVER (PARTITION BY level_2) - 1) END AS item_popularity_norm FROM items)"""


@query(f"WITH {ITEMS_SQL}, {NORM_SQL} SELECT * FROM norms")
def popularity_norm(s: S, d: str) -> D:
    return f.popularity_norm(items(s, d))


WINDOW = "created_at >= TIMESTAMP '2024-01-25' - INTERVAL 20 DAY AND created_at < TIMESTAMP '2024-01-25'"
SINCE = "created_at >= TIMESTAMP '2024-01-25' - INTERVAL {} DAY"
_COUNTS = ", ".join(f"count(*) FILTER (event_type = '{k}' AND {SINCE.format(n)}) AS feedback_{k}s_{n}d" for k in ("click", "cart", "purchase") for n in (30, 90))


@query(
    f"""WITH {t.CLIENTS_SQL}, {t.FEEDBACK_SQL},
known AS (SELECT DISTINCT * FROM feedback WHERE {WINDOW} AND received_at < TIMESTAMP '2024-01-25'
  AND verification_status = 'VERIFIED' AND client_id IN (SELECT client_id FROM clients)),
agg AS (SELECT client_id, {_COUNTS},
  count(*) FILTER (event_type = 'purchase') AS np, count(*) FILTER (event_type = 'purchase' AND shown_discount > 0) AS nd,
  count(*) FILTER (event_type = 'purchase' AND shown_discount = 0) AS no,
  CAST(sum(shown_discount) AS DOUBLE) / count(shown_discount) AS feedback_avg_shown_discount,
  CASE WHEN count(purchase_value) > 0 THEN CAST(sum(purchase_value) AS DOUBLE) / count(purchase_value) END AS feedback_avg_purchase_value
  FROM known GROUP BY client_id)
SELECT client_id, {", ".join(f"coalesce({c}, 0) AS {c}" for c in f.FEEDBACK_COUNTS)},
  CASE WHEN np > 0 THEN nd / np END AS feedback_discounted_share, CASE WHEN np > 0 THEN no / np END AS feedback_organic_share,
  feedback_avg_shown_discount, feedback_avg_purchase_value
FROM clients LEFT JOIN agg USING (client_id)"""
)
def feedback_features(s: S, d: str) -> D:
    return f.feedback_features(t.clients(s, d), t.feedback(s, d), t.EVENT_CUTOFF, 20)


@query(
    f"""WITH {t.CLIENTS_SQL}, {t.FEEDBACK_SQL},
e AS (SELECT DISTINCT * FROM feedback)
SELECT (SELECT count(*) FROM feedback) AS source_event_rows, (SELECT count(*) FROM feedback) - count(*) AS duplicate_event_rows,
  count(*) FILTER (NOT ({WINDOW})) AS outside_event_time_rows,
  count(*) FILTER ({WINDOW} AND received_at >= TIMESTAMP '2024-01-25') AS late_received_rows,
  count(*) FILTER ({WINDOW} AND received_at < TIMESTAMP '2024-01-25' AND verification_status <> 'VERIFIED') AS unverified_event_rows,
  count(*) FILTER ({WINDOW} AND received_at < TIMESTAMP '2024-01-25' AND verification_status = 'VERIFIED') AS verified_event_rows,
  count(*) FILTER ({WINDOW} AND received_at < TIMESTAMP '2024-01-25' AND verification_status = 'VERIFIED' AND client_id NOT IN (SELECT client_id FROM clients)) AS unknown_client_rows
FROM e"""
)
def feedback_audit(s: S, d: str) -> D:
    return f.feedback_audit(t.clients(s, d), t.feedback(s, d), t.EVENT_CUTOFF, 20)


INTERACTIONS_SQL = """interactions AS (
  SELECT client_id, product_id, count(DISTINCT transaction_id) AS times_bought,
    date_diff('day', CAST(max(transaction_datetime) AS DATE), DATE '2001-01-01') AS days_since_last
  FROM lines GROUP BY ALL)"""
BASKET_SQL = """baskets AS (SELECT DISTINCT client_id, transaction_id, product_id FROM lines),
item_receipts AS (SELECT product_id, count(*) AS n FROM baskets GROUP BY product_id),
cosine AS (
  SELECT x.seed_product_id, x.product_id, co_receipts, co_receipts / sqrt(a.n * b.n) AS similarity
  FROM (SELECT l.product_id AS seed_product_id, r.product_id, count(*) AS co_receipts
        FROM baskets l JOIN baskets r USING (client_id, transaction_id) WHERE l.product_id <> r.product_id GROUP BY ALL) x
  JOIN item_receipts a ON a.product_id = x.seed_product_id JOIN item_receipts b ON b.product_id = x.product_id)"""


def _first(frame: str, k: int, group: str = "client_id", order: str = "raw_score DESC, product_id") -> str:
    return f"SELECT * FROM {frame} QUALIFY row_number() OVER (PARTITION BY {group} ORDER BY {order}) <= {k}"


CANDIDATES_SQL = f"""{ITEMS_SQL}, {CATEGORY_SQL}, {INTERACTIONS_SQL}, {BASKET_SQL},
repeat0 AS (SELECT client_id, product_id, round(ln(1 + times_bought) * exp(-days_since_last / 45.0), 9) AS raw_score FROM interactions),
cand_repeat AS ({_first("repeat0", 20)}),
top_categories AS ({_first("affinity", 2, "client_id", "affinity DESC, level_2")}),
category0 AS (SELECT client_id, product_id, round(affinity * ln(1 + unique_buyers), 9) AS raw_score FROM top_categories JOIN items USING (level_2)),
cand_category AS ({_first("category0", 25)}),
neighbours AS ({_first("cosine", 20, "seed_product_id", "similarity DESC, product_id")}),
i2i0 AS (
  SELECT client_id, n.product_id, CAST(sum(CAST(round(similarity * exp(-days_since_last / 45.0), 9) AS DECIMAL(20,9))) AS DOUBLE) AS raw_score
  FROM interactions i JOIN neighbours n ON i.product_id = n.seed_product_id GROUP BY ALL),
cand_i2i AS ({_first("i2i0", 25)}),
top_items AS (SELECT product_id, unique_buyers, total_sales_qty, round(ln(1 + unique_buyers), 9) AS raw_score FROM items WHERE is_alcohol = 0
  ORDER BY unique_buyers DESC, total_sales_qty DESC, product_id LIMIT 20),
cand_global AS (SELECT client_id, product_id, raw_score FROM clients, top_items),
sources AS (
  {" UNION ALL ".join(f"SELECT client_id, product_id, CASE WHEN count(*) OVER (PARTITION BY client_id) = 1 THEN 1.0 ELSE percent_rank() OVER (PARTITION BY client_id ORDER BY raw_score) END AS normalized_score, '{n}' AS candidate_source FROM {c}" for c, n in (("cand_repeat", "repeat_purchase"), ("cand_category", "category_popular"), ("cand_i2i", "item_to_item"), ("cand_global", "global_popular")))}),
merged AS (
  SELECT client_id, product_id, list_sort(list(DISTINCT candidate_source)) AS candidate_sources, max(normalized_score) AS best_source_score,
    round(max(normalized_score) + 0.05::DOUBLE * (count(DISTINCT candidate_source) - 1), 9) AS recsys_score
  FROM sources GROUP BY client_id, product_id),
candidates AS (
  SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY recsys_score DESC, product_id) AS candidate_rank FROM merged
  QUALIFY candidate_rank <= 50)"""


@query(f"WITH {CANDIDATES_SQL} SELECT client_id, product_id, raw_score FROM cand_repeat")
def cand_repeat(s: S, d: str) -> D:
    return C.cand_repeat(eligible(s, d), t.CUTOFF)


@query(f"WITH {CANDIDATES_SQL} SELECT client_id, product_id, raw_score FROM cand_category")
def cand_category(s: S, d: str) -> D:
    return C.cand_category(lines(s, d), items(s, d))


@query(f"WITH {LINES_SQL}, {BASKET_SQL} SELECT seed_product_id, product_id, co_receipts, round(similarity, 9) AS similarity FROM cosine")
def basket_cosine(s: S, d: str) -> D:
    return C.basket_cosine(eligible(s, d)).withColumn("similarity", F.round("similarity", 9))


@query(f"WITH {LINES_SQL}, {BASKET_SQL} SELECT seed_product_id, product_id, co_receipts FROM cosine WHERE seed_product_id < product_id")
def self_join_basket(s: S, d: str) -> D:
    return C.basket_cosine(eligible(s, d)).where("seed_product_id < product_id").select("seed_product_id", "product_id", "co_receipts")


@query(f"WITH {CANDIDATES_SQL} SELECT client_id, product_id, raw_score FROM cand_i2i")
def cand_item_to_item(s: S, d: str) -> D:
    return C.cand_item_to_item(eligible(s, d), t.CUTOFF)


@query(f"WITH {CANDIDATES_SQL} SELECT client_id, product_id, raw_score FROM cand_global")
def cand_global(s: S, d: str) -> D:
    return C.cand_global(t.clients(s, d), items(s, d))


@query(f"WITH {CANDIDATES_SQL} SELECT client_id, product_id, raw_score FROM cand_global")
def join_cross_broadcast(s: S, d: str) -> D:
    return C.cand_global(t.clients(s, d), items(s, d))


@query(f"WITH {CANDIDATES_SQL} SELECT product_id, unique_buyers, total_sales_qty FROM top_items")
def topk_global(s: S, d: str) -> D:
    return C.topk_global(items(s, d)).select("product_id", "unique_buyers", "total_sales_qty")


@query(f"WITH {CANDIDATES_SQL} SELECT client_id, product_id, array_to_string(candidate_sources, ',') AS candidate_sources, best_source_score, recsys_score, candidate_rank FROM candidates")
def candidates_top50(s: S, d: str) -> D:
    found, i = stored(s, d)
    out = C.candidates_top50(t.clients(s, d), i, found, t.CUTOFF)
    return out.select("client_id", "product_id", F.concat_ws(",", "candidate_sources").alias("candidate_sources"), "best_source_score", "recsys_score", "candidate_rank")


@query(f"WITH {CANDIDATES_SQL} SELECT client_id, product_id, array_to_string(candidate_sources, ',') AS candidate_sources, recsys_score FROM merged")
def source_merge(s: S, d: str) -> D:
    e, i = stored(s, d)
    return C.source_merge(C.normalised_sources(t.clients(s, d), i, e, t.CUTOFF)).select("client_id", "product_id", F.concat_ws(",", "candidate_sources").alias("candidate_sources"), "recsys_score")


@query(f"WITH {CANDIDATES_SQL} SELECT client_id, product_id, normalized_score FROM sources WHERE candidate_source = 'repeat_purchase'")
def win_percent_rank(s: S, d: str) -> D:
    return C.normalise_source(C.cand_repeat(eligible(s, d), t.CUTOFF), "repeat_purchase").drop("candidate_source")


#: Candidates and users read the same first tables; those of the users follow.
PAIR_SQL = f"""{CANDIDATES_SQL}, {RECEIPT_FEATURES_SQL}, {LINE_FEATURES_SQL}, {NORM_SQL},
pair_features AS (
  SELECT c.client_id, c.product_id, CASE WHEN h.times_bought IS NOT NULL THEN 1 ELSE 0 END AS bought_before,
    coalesce(h.times_bought, 0) AS times_bought, h.days_since_last AS days_since_last_item_purchase,
    coalesce(a.affinity, 0.0) AS user_category_affinity, n.item_popularity_norm,
    CASE WHEN n.median_unit_price IS NOT NULL AND l.avg_item_price > 0 THEN n.median_unit_price / l.avg_item_price END AS price_vs_user_avg,
    least(1.0, coalesce(a.affinity, 0.0) + CASE WHEN v.favorite_category_l2 = n.level_2 THEN 0.25 ELSE 0.0 END) AS category_match_score
  FROM candidates c LEFT JOIN interactions h ON h.client_id = c.client_id AND h.product_id = c.product_id
    JOIN clients k ON k.client_id = c.client_id JOIN norms n ON n.product_id = c.product_id
    LEFT JOIN line_features l ON l.client_id = c.client_id LEFT JOIN favourite v ON v.client_id = c.client_id
    LEFT JOIN affinity a ON a.client_id = c.client_id AND a.level_2 = n.level_2)"""


@query(f"WITH {PAIR_SQL} SELECT * FROM pair_features")
def user_item_features(s: S, d: str) -> D:
    found, i = stored(s, d)
    pairs = C.candidates_top50(t.clients(s, d), i, found, t.CUTOFF)
    return f.user_item_features(pairs, f.user_features(t.clients(s, d), found, t.CUTOFF), i, found, t.CUTOFF)


@query(f"WITH {LINES_SQL}, {CATEGORY_SQL} SELECT * FROM favourite")
def win_row_number(s: S, d: str) -> D:
    return f.favourite_category(lines(s, d))


@query(f"WITH {ITEMS_SQL} SELECT p_partkey AS product_id, row_number() OVER (PARTITION BY p_type ORDER BY qty DESC NULLS LAST, p_partkey) AS popularity_rank FROM part LEFT JOIN sales ON product_id = p_partkey")
def win_row_number_nulls_last(s: S, d: str) -> D:
    sales = eligible(s, d).groupBy("product_id").agg(F.sum("product_quantity").alias("qty"))
    sold = t.products(s, d).join(sales, "product_id", "left").select("product_id", "level_2", "qty")
    order = [F.desc_nulls_last("qty"), F.asc("product_id")]
    ranked = running(sold, "qty", order, {"popularity_rank": F.lit(1)}, descending=True, second=F.col("product_id"), within=["level_2"])
    return ranked.select("product_id", "popularity_rank")


@query(f"WITH {LINES_SQL}, {AGE_SQL} SELECT client_id, age FROM ages")
def winsorize(s: S, d: str) -> D:
    return f.winsorize(t.clients(s, d), "age").select("client_id", "age")


@query(f"WITH {LINES_SQL} SELECT client_id, least(5000.0, greatest(0.0, age)) AS age FROM clients")
def clip(s: S, d: str) -> D:
    return t.clients(s, d).select("client_id", X.clip("age", 0.0, 5000.0).alias("age"))


@query("SELECT p_partkey AS product_id, CASE p_type WHEN 'ECONOMY' THEN 0.18 WHEN 'PROMO' THEN 0.12 ELSE 0.25 END::DOUBLE AS margin FROM part")
def map_lookup_default(s: S, d: str) -> D:
    from marketloom.plans.base import MARGINS

    return t.products(s, d).select("product_id", X.lookup("level_2", MARGINS, 0.25).alias("margin"))


@query(f"WITH {USERS_SQL} SELECT client_id, coalesce(avg_check, 0.0) AS avg_check, coalesce(favorite_category_l2, 'none') AS favorite FROM users")
def null_default(s: S, d: str) -> D:
    return users(s, d).select("client_id", F.coalesce("avg_check", F.lit(0.0)).alias("avg_check"), F.coalesce("favorite_category_l2", F.lit("none")).alias("favorite"))


@query(f"WITH {ITEMS_SQL} SELECT price_source, is_price_available, count(*) AS n FROM items GROUP BY ALL")
def conditional_columns(s: S, d: str) -> D:
    return items(s, d).groupBy("price_source", "is_price_available").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {LINES_SQL}, {CATEGORY_SQL} {_first('category_quantities', 2, 'client_id', 'category_quantity DESC, level_2')}")
def topk_per_group(s: S, d: str) -> D:
    return C.topk_per_group(f.category_quantities(lines(s, d)), ["client_id"], [F.desc("category_quantity"), F.asc("level_2")], 2)


@query("SELECT c_custkey AS client_id, percent_rank() OVER (ORDER BY c_acctbal) AS age_rank FROM customer", name="global_percent_rank")
def global_percent_rank_query(s: S, d: str) -> D:
    return global_percent_rank(t.clients(s, d), "age", "age_rank").select("client_id", "age_rank")


@query(f"WITH {LINES_SQL} SELECT count(DISTINCT client_id) AS clients, count(DISTINCT transaction_id) AS receipts, count(DISTINCT (client_id, product_id)) AS pairs FROM lines")
def distinct_count(s: S, d: str) -> D:
    return eligible(s, d).agg(
        F.countDistinct("client_id").alias("clients"), F.countDistinct("transaction_id").alias("receipts"), F.countDistinct("client_id", "product_id").alias("pairs")
    )


@query(f"WITH {t.FEEDBACK_SQL} SELECT client_id, count(*) FILTER (event_type = 'click' AND created_at >= TIMESTAMP '2024-01-15') AS recent_clicks, count(*) FILTER (event_type = 'purchase') AS purchases FROM feedback GROUP BY client_id")
def conditional_sum(s: S, d: str) -> D:
    recent = F.col("created_at") >= F.lit("2024-01-15").cast("timestamp")
    return t.feedback(s, d).groupBy("client_id").agg(
        F.count_if((F.col("event_type") == "click") & recent).alias("recent_clicks"), F.count_if(F.col("event_type") == "purchase").alias("purchases")
    )


@query(f"WITH {LINES_SQL} SELECT DISTINCT client_id, transaction_id, product_id FROM lines")
def distinct_rows(s: S, d: str) -> D:
    return eligible(s, d).select("client_id", "transaction_id", "product_id").distinct()


@query(f"WITH {t.FEEDBACK_SQL} SELECT DISTINCT event_id, event_fingerprint FROM (SELECT * FROM feedback UNION ALL SELECT * FROM feedback WHERE event_type = 'click') x")
def dedup_by_key(s: S, d: str) -> D:
    events = t.feedback(s, d)
    twice = events.unionByName(events.where("event_type = 'click'"))
    return twice.dropDuplicates(["event_id", "event_fingerprint"]).select("event_id", "event_fingerprint")


@query(f"WITH {CANDIDATES_SQL} SELECT candidate_source, count(*) AS n FROM sources WHERE candidate_source IN ('repeat_purchase', 'item_to_item') GROUP BY 1")
def union_by_name(s: S, d: str) -> D:
    a = C.normalise_source(C.cand_repeat(eligible(s, d), t.CUTOFF), "repeat_purchase")
    b = C.normalise_source(C.cand_item_to_item(eligible(s, d), t.CUTOFF), "item_to_item")
    return a.unionByName(b).groupBy("candidate_source").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey AS id, c_acctbal AS balance, NULL AS price FROM customer UNION ALL SELECT p_partkey, NULL, p_retailprice FROM part")
def union_missing_columns(s: S, d: str) -> D:
    a = t.read(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    b = t.read(s, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"))
    return a.unionByName(b, allowMissingColumns=True)


@query(f"WITH {LINES_SQL} SELECT client_id, product_id, level_2, trn_sum_from_iss FROM lines WHERE client_id IN (SELECT client_id FROM clients WHERE age >= 0)")
def join_inner_equi(s: S, d: str) -> D:
    rich = t.clients(s, d).where("age >= 0").select("client_id")
    return lines(s, d).join(rich, "client_id").select("client_id", "product_id", "level_2", "trn_sum_from_iss")


@query(f"WITH {LINES_SQL}, {RECEIPTS_SQL} SELECT c.client_id, gender, count(transaction_id) AS receipts FROM clients c LEFT JOIN receipts r ON c.client_id = r.client_id GROUP BY ALL")
def join_left_enrich(s: S, d: str) -> D:
    per = f.receipt_rollup(eligible(s, d)).groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))
    return t.clients(s, d).join(per, "client_id", "left").select("client_id", "gender", F.coalesce("n", F.lit(0)).alias("receipts"))


@query(f"WITH {LINES_SQL} SELECT client_id FROM clients WHERE client_id NOT IN (SELECT client_id FROM lines)")
def join_left_anti(s: S, d: str) -> D:
    return t.clients(s, d).join(eligible(s, d), "client_id", "left_anti").select("client_id")


@query(f"WITH {LINES_SQL} SELECT client_id FROM clients WHERE client_id IN (SELECT client_id FROM lines)")
def join_semi(s: S, d: str) -> D:
    return t.clients(s, d).join(eligible(s, d), "client_id", "left_semi").select("client_id")


@query(f"WITH {LINES_SQL}, {PRICES_SQL} SELECT level_2, count(*) AS n FROM filtered GROUP BY level_2")
def join_theta_filter(s: S, d: str) -> D:
    return f.price_outlier_filter(_prices(s, d)).groupBy("level_2").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey AS client_id, lower(trim(c_name)) AS name, sha256(concat_ws('|', CAST(c_custkey AS VARCHAR), c_mktsegment)) AS digest, strftime(DATE '2001-01-01' + CAST(c_custkey % 400 AS INTEGER), '%Y-%m') AS month, date_diff('day', DATE '2001-01-01', DATE '2001-01-01' + CAST(c_custkey % 400 AS INTEGER)) AS days, round(ln(1 + abs(c_acctbal)), 6) AS log_balance FROM customer")
def scalar_functions(s: S, d: str) -> D:
    day = F.date_add(F.lit("2001-01-01").cast("date"), (F.col("c_custkey") % 400).cast("int"))
    return t.read(s, d, "customer").select(
        F.col("c_custkey").alias("client_id"), F.lower(F.trim("c_name")).alias("name"),
        F.sha2(F.concat_ws("|", F.col("c_custkey").cast("string"), "c_mktsegment"), 256).alias("digest"),
        F.date_format(day, "yyyy-MM").alias("month"), F.datediff(day, F.lit("2001-01-01").cast("date")).alias("days"),
        F.round(F.log1p(F.abs("c_acctbal")), 6).alias("log_balance"),
    )


@query(f"WITH {CANDIDATES_SQL} SELECT client_id, len(candidate_sources) AS n_sources, list_contains(candidate_sources, 'item_to_item') AS has_i2i, candidate_sources[1] AS first_source, count(*) AS n FROM candidates GROUP BY ALL")
def array_functions(s: S, d: str) -> D:
    found, i = stored(s, d)
    c = C.candidates_top50(t.clients(s, d), i, found, t.CUTOFF)
    return c.groupBy(
        "client_id", F.size("candidate_sources").alias("n_sources"), F.array_contains("candidate_sources", "item_to_item").alias("has_i2i"), F.get("candidate_sources", F.lit(0)).alias("first_source")
    ).agg(F.count(F.lit(1)).alias("n"))
