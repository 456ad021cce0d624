"""Queries of scans, sinks and data quality."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.functions import expressions as X
from marketloom.operators import quality as Q
from marketloom.operators import raw_files as raw
from marketloom.operators.features import category_affinity
from marketloom.plans.base import CATEGORY_SQL, ITEMS_SQL, LINES_SQL, eligible, items, lines, query
from marketloom.sources import events as store
from marketloom.sources import scans, sinks
from marketloom.sources import tables as t
from marketloom.sources.contracts import REGISTRY, Contract, Field
from marketloom.sources.shared import shared_dir

S, D = SparkSession, DataFrame
AT = datetime(2001, 1, 1)


def _path(s: S, name: str) -> str:
    return f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"


#: The customer table as a raw file would bring it: text, with blanks and junk in some rows.
CUSTOMERS = Contract("customers", (Field("client_id", "integer"), Field("age", "double", nullable=True), Field("flag", "integer", allowed=(0, 1)), Field("since", "timestamp", nullable=True)), ("client_id",))


def raw_customers(s: S, d: str) -> D:
    key = F.col("c_custkey")
    return t.read(s, d, "customer").select(
        F.concat(F.lit(" "), key.cast("string"), F.lit(" ")).alias("client_id"),
        F.when(key % 7 == 0, "x1").when(key % 11 == 0, " ").when(key % 13 == 0, "NaN").otherwise(key.cast("string")).alias("age"),
        (key % 3).cast("string").alias("flag"),
        F.when(key % 5 == 0, "not-a-timestamp").otherwise("2001-01-01 00:00:00").alias("since"),
    )


FLAGS_SQL = """raw AS (
  SELECT c_custkey AS client_id,
    CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'NaN'::DOUBLE ELSE c_custkey END AS age,
    c_custkey % 3 AS flag, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE TIMESTAMP '2001-01-01' END AS since,
    false AS bad_id, c_custkey % 7 = 0 OR (c_custkey % 11 <> 0 AND c_custkey % 13 = 0) AS bad_age, c_custkey % 3 = 2 AS bad_flag, c_custkey % 5 = 0 AS bad_since
  FROM customer)"""


@query(f"WITH {FLAGS_SQL} SELECT CAST(client_id AS INTEGER) AS client_id, age, CAST(flag AS INTEGER) AS flag, since FROM raw")
def typed_scan(s: S, d: str) -> D:
    path = _path(s, "raw")
    raw_customers(s, d).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return scans.without_flags(scans.typed_scan(s, path, CUSTOMERS, AT)).select("client_id", "age", "flag", "since")


@query(f"WITH {FLAGS_SQL} SELECT CAST(client_id AS INTEGER) AS client_id, bad_id, bad_age, bad_flag, bad_since FROM raw")
def invalid_flags(s: S, d: str) -> D:
    typed = scans.typed_columns(raw_customers(s, d), CUSTOMERS)
    names = {"client_id": "bad_id", "age": "bad_age", "flag": "bad_flag", "since": "bad_since"}
    return typed.select("client_id", *(F.col(scans.BAD + c).alias(n) for c, n in names.items()))


@query(f"WITH {FLAGS_SQL} SELECT count(*) AS n_rows, count(*) FILTER (bad_id) AS invalid_client_id, count(*) FILTER (bad_age) AS invalid_age, count(*) FILTER (bad_flag) AS invalid_flag, count(*) FILTER (bad_since) AS invalid_since FROM raw")
def contract_profile(s: S, d: str) -> D:
    return Q.contract_profile(scans.typed_columns(raw_customers(s, d), CUSTOMERS))


#: Columns of the purchases contract that the tables have, with what the contract says of them.
PURCHASE_FIELDS = (
    (0, "client_id", "string", False), (1, "transaction_id", "string", False), (2, "transaction_datetime", "timestamp", False),
    (9, "product_id", "string", False), (10, "product_quantity", "double", False), (11, "trn_sum_from_iss", "double", True),
)


@query(
    f"WITH {t.PURCHASES_SQL} "
    + " UNION ALL ".join(
        f"SELECT {k} AS position, '{c}' AS field, '{kind}' AS kind, {null} AS nullable, count({c}) AS n_values, count(*) FILTER ({c} IS NULL AND NOT {null}) AS n_bad FROM purchases"
        for k, c, kind, null in PURCHASE_FIELDS
    )
)
def contract_registry(s: S, d: str) -> D:
    """The declared fields of purchases, with the values and the bad ones after a cast from text."""
    contract = REGISTRY["purchases"]
    p = t.purchases(s, d)
    raw = p.select(*((F.col(c) if c in p.columns else F.lit(None)).cast("string").alias(c) for c in contract.columns))
    typed = scans.typed_columns(raw, contract)
    here = [(k, f) for k, f in enumerate(contract.fields) if f.name in p.columns and f.name in {x[1] for x in PURCHASE_FIELDS}]
    wide = typed.agg(*(x for k, f in here for x in (F.count(f.name).alias(f"n{k}"), F.count_if(F.col(scans.BAD + f.name)).alias(f"b{k}"))))
    found = F.array(*(F.struct(F.lit(k).alias("position"), F.lit(f.name).alias("field"), F.lit(f.kind).alias("kind"), F.lit(f.nullable).alias("nullable"), F.col(f"n{k}").alias("n_values"), F.col(f"b{k}").alias("n_bad")) for k, f in here))
    return wide.select(F.explode(found).alias("r")).select("r.*")


@query("SELECT 'customer' AS name, DATE '2001-01-01' AS ingest_date, count(*) AS n FROM customer UNION ALL SELECT 'part', DATE '2001-01-01', count(*) FROM part")
def dimension_ingest(s: S, d: str) -> D:
    base = _path(s, "bronze")
    frames = {n: t.read(s, d, n) for n in ("customer", "part")}
    scans.dimension_ingest(frames, base, "2001-01-01", frames)
    parts = [s.read.parquet(f"{base}/{n}").groupBy(F.lit(n).alias("name"), "ingest_date").agg(F.count(F.lit(1)).alias("n")) for n in frames]
    return parts[0].union(parts[1])


@query(f"WITH {t.PURCHASES_SQL} SELECT strftime(transaction_datetime, '%Y-%m') AS purchase_month, count(*) AS n, sum(trn_sum_from_iss) AS total FROM purchases WHERE transaction_datetime >= TIMESTAMP '2000-10-01' AND transaction_datetime < TIMESTAMP '2001-01-01' GROUP BY 1")
def fact_ingest_by_month(s: S, d: str) -> D:
    base = _path(s, "facts")
    scans.fact_ingest_by_month(t.purchases(s, d), "transaction_datetime", base, ["2000-10", "2000-11", "2000-12"])
    facts = s.read.schema("trn_sum_from_iss decimal(18,2), purchase_month string").parquet(base)
    return facts.groupBy("purchase_month").agg(F.count(F.lit(1)).alias("n"), F.sum("trn_sum_from_iss").cast("decimal(38,2)").alias("total"))


@query(f"WITH {LINES_SQL} SELECT client_id, transaction_id, product_id, transaction_datetime FROM eligible")
def interval_scan(s: S, d: str) -> D:
    return eligible(s, d).select("client_id", "transaction_id", "product_id", "transaction_datetime")


@query(f"WITH {t.PURCHASES_SQL} SELECT client_id, product_id, transaction_datetime FROM purchases WHERE transaction_datetime >= TIMESTAMP '2001-01-01' AND transaction_datetime < TIMESTAMP '2001-01-31'")
def label_scan(s: S, d: str) -> D:
    return scans.label_scan(t.purchases(s, d), "transaction_datetime", t.CUTOFF, 30).select("client_id", "product_id", "transaction_datetime")


@query(f"WITH {t.PURCHASES_SQL} SELECT client_id, count(*) AS n FROM purchases WHERE transaction_datetime >= TIMESTAMP '2000-12-01' AND transaction_datetime < TIMESTAMP '2001-01-01' GROUP BY 1")
def half_open_filter(s: S, d: str) -> D:
    inside = X.half_open("transaction_datetime", datetime(2000, 12, 1), t.CUTOFF)
    return t.purchases(s, d).where(inside).groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {t.FEEDBACK_SQL} SELECT event_id, event_date FROM feedback WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'")
def event_date_scan(s: S, d: str) -> D:
    return scans.event_date_scan(t.feedback(s, d), t.EVENT_CUTOFF, 20, ["event_id", "event_date"]).select("event_id", "event_date")


@query(f"WITH {t.FEEDBACK_SQL} SELECT event_id, received_at FROM feedback WHERE (received_at, event_id) > (TIMESTAMP '2024-01-10', 0) ORDER BY received_at, event_id LIMIT 500")
def incremental_batch(s: S, d: str) -> D:
    return scans.incremental_batch(t.feedback(s, d), (datetime(2024, 1, 10), 0), 500).select("event_id", "received_at")


@query(f"WITH {t.FEEDBACK_SQL} SELECT event_date, count(*) AS n, sum(purchase_value) AS total FROM feedback GROUP BY 1")
def merge_partitions(s: S, d: str) -> D:
    """A first load of earlier events, each of them a day off, then two merges of all as they are, the second a repeat."""
    path = _path(s, "events")
    events = t.feedback(s, d)
    store.merge_partitions(events.where("event_date < DATE '2024-01-20'").withColumn("event_date", F.date_add("event_date", 1)), path)
    for _ in range(2):
        store.merge_partitions(events, path)
    merged = s.read.schema(events.schema).parquet(path)
    return merged.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), F.sum("purchase_value").cast("decimal(38,2)").alias("total"))


LEDGER_SIZE = 4000


@query(f"""WITH {t.FEEDBACK_SQL}, n AS (SELECT event_id, received_at, (row_number() OVER (ORDER BY received_at, event_id) - 1) // {LEDGER_SIZE} AS b FROM feedback),
m AS (SELECT b, count(*) AS n_rows, max(received_at) AS upper_at, arg_max(event_id, (received_at, event_id)) AS upper_id FROM n GROUP BY b)
SELECT lag(upper_at) OVER (ORDER BY b) AS lower_at, lag(upper_id) OVER (ORDER BY b) AS lower_id, upper_at, upper_id, n_rows FROM m""")
def export_ledger(s: S, d: str) -> D:
    """Events published in bounded batches, by what the ledger says of each batch."""
    path = _path(s, "export")
    store.export_batches(t.feedback(s, d), path, LEDGER_SIZE)
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return store.ledger(s, path).select(ntz("lower_at"), "lower_id", ntz("upper_at"), "upper_id", "n_rows")


@query("SELECT p_type AS level_2, count(*) AS n FROM part GROUP BY 1")
def parquet_sink(s: S, d: str) -> D:
    path = _path(s, "sink")
    sinks.parquet_sink(t.products(s, d), path, ["level_2"])
    return s.read.parquet(path).groupBy("level_2").agg(F.count(F.lit(1)).alias("n"))


ANNOTATED_SQL = f"""{t.PURCHASES_SQL},
annotated AS (
  SELECT *, list_filter([CASE WHEN line_discount <= 0 THEN 'NONPOSITIVE_QUANTITY' END,
    CASE WHEN client_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) THEN 'UNKNOWN_CLIENT' END,
    CASE WHEN product_id NOT IN (SELECT p_partkey FROM part WHERE p_size < 45) THEN 'UNKNOWN_PRODUCT' END,
    CASE WHEN transaction_datetime >= TIMESTAMP '2001-01-01' THEN 'FUTURE_TRANSACTION' END], lambda x: x IS NOT NULL) AS reason_codes,
    trn_sum_from_iss > 0 AND line_discount > 0 AS is_valid_for_price
  FROM purchases)"""
CODES = ("NONPOSITIVE_QUANTITY", "UNKNOWN_CLIENT", "UNKNOWN_PRODUCT", "FUTURE_TRANSACTION")


def annotated(s: S, d: str) -> D:
    known = t.products(s, d).where("level_4 < 45")
    return Q.annotate_purchases(t.purchases(s, d), t.clients(s, d).where("age >= 0"), known, t.CUTOFF, "line_discount")


@query(f"WITH {ANNOTATED_SQL} SELECT client_id, transaction_id, product_id, array_to_string(reason_codes, ',') AS reasons, is_valid_for_price FROM annotated")
def reject_reasons(s: S, d: str) -> D:
    return annotated(s, d).select("client_id", "transaction_id", "product_id", F.concat_ws(",", "reason_codes").alias("reasons"), "is_valid_for_price")


@query(f"WITH {ANNOTATED_SQL} SELECT array_to_string(reason_codes, ',') AS reasons, count(*) AS n, 'run-1' AS run_id FROM annotated WHERE len(reason_codes) > 0 GROUP BY 1")
def reject_sink(s: S, d: str) -> D:
    path = _path(s, "rejects")
    marked = annotated(s, d)
    sinks.reject_sink(sinks.reject_rows(marked, F.col("reason_codes"), "run-1", AT), path)
    return s.read.parquet(path).groupBy(F.concat_ws(",", "reason_codes").alias("reasons"), "run_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {ANNOTATED_SQL}
SELECT strftime(transaction_datetime, '%Y-%m') AS month, count(*) AS rows_in, count(*) FILTER (len(reason_codes) = 0) AS rows_accepted,
  count(*) FILTER (len(reason_codes) > 0) AS rows_rejected, count(*) FILTER (len(reason_codes) = 0 AND NOT is_valid_for_price) AS rows_without_price,
  {", ".join(f"count(*) FILTER (list_contains(reason_codes, '{c}')) AS n_{c.lower()}" for c in CODES)},
  count(*) - count(DISTINCT (client_id, transaction_id, transaction_datetime, purchase_sum, product_id, product_quantity, trn_sum_from_iss, points_spent, store_id, line_discount)) AS duplicate_rows
FROM annotated GROUP BY 1"""
)
def quality_by_month(s: S, d: str) -> D:
    return Q.quality_by_month(annotated(s, d), CODES)


@query(f"WITH {LINES_SQL} SELECT client_id, transaction_id, 'run-1' AS run_id, TIMESTAMP '2001-01-01' AS processed_at, '2001-01-01' AS source_snapshot FROM eligible")
def lineage_stamp(s: S, d: str) -> D:
    return sinks.lineage_stamp(eligible(s, d).select("client_id", "transaction_id"), "run-1", AT, source_snapshot="2001-01-01")


@query("SELECT 'run-1' AS run_id, count(*) AS rows_in, count(*) FILTER (c_acctbal < 0) AS negative FROM customer")
def run_metadata(s: S, d: str) -> D:
    row = t.read(s, d, "customer").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("neg")).first()
    path = _path(s, "metadata")
    sinks.run_metadata(s, path, "run-1", {"customer": "customer.parquet"}, {"cutoff": "2001-01-01"}, {"rows_in": row["n"], "negative": row["neg"]})
    record = s.read.schema("run_id string, metrics map<string,double>").json(path)
    return record.select("run_id", F.col("metrics")["rows_in"].cast("long").alias("rows_in"), F.col("metrics")["negative"].cast("long").alias("negative"))


@query(f"WITH {ITEMS_SQL} SELECT product_id, unique_buyers FROM items")
def snapshot_publish(s: S, d: str) -> D:
    base = _path(s, "gold")
    frame = items(s, d).select("product_id", "unique_buyers")
    sinks.snapshot_publish(frame, base, "item_features", ["product_id"], "run-1", AT)
    return sinks.current_snapshot(s, base, "item_features")


@query(f"WITH {ITEMS_SQL}, top AS (SELECT product_id, row_number() OVER (ORDER BY unique_buyers DESC, total_sales_qty DESC, product_id) AS rank FROM items WHERE is_alcohol = 0 QUALIFY rank <= 50) SELECT product_id, rank, 1 - (rank - 1) / 50.0::DOUBLE AS score FROM top")
def fallback_list(s: S, d: str) -> D:
    return sinks.fallback_list(items(s, d), 50)


def _ranked(s: S, d: str) -> D:
    aff = category_affinity(lines(s, d))
    rank = F.row_number().over(Window.partitionBy("client_id").orderBy(F.desc("affinity"), "level_2"))
    return aff.select("client_id", "level_2", rank.alias("rank"))


RANKED_SQL = """ranked AS (SELECT client_id, level_2, row_number() OVER (PARTITION BY client_id ORDER BY affinity DESC, level_2) AS rank FROM affinity)"""


@query(f"""WITH {LINES_SQL}, {CATEGORY_SQL}, {RANKED_SQL}
SELECT client_id, '[' || string_agg('{{"level_2":"' || level_2 || '","rank":' || rank || '}}', ',' ORDER BY rank) || ']' AS payload, count(*) AS n_items FROM ranked GROUP BY 1""")
def serving_payload(s: S, d: str) -> D:
    return sinks.serving_payload(_ranked(s, d), "client_id", "rank", ["level_2"])


@query(f"""WITH {LINES_SQL}, {CATEGORY_SQL}, {RANKED_SQL},
per AS (SELECT n.n AS top_n, client_id, strlen('[' || string_agg('{{"level_2":"' || level_2 || '","rank":' || rank || '}}', ',' ORDER BY rank) || ']') AS b
  FROM ranked, (SELECT unnest(range(1, 6)) AS n) n WHERE rank <= n.n GROUP BY ALL),
sizes AS (SELECT CAST(top_n AS INTEGER) AS top_n, sum(b)::BIGINT AS bytes FROM per GROUP BY 1),
fit AS (SELECT *, CAST(floor(bytes * 1.25) AS BIGINT) <= 60000 AS fits FROM sizes)
SELECT top_n, bytes, fits, coalesce(top_n = (SELECT max(top_n) FROM fit WHERE fits), NULL) AS is_chosen FROM fit""")
def fit_top_n_budget(s: S, d: str) -> D:
    return sinks.fit_top_n_budget(_ranked(s, d), "client_id", "rank", ["level_2"], 5, 60_000, 1.25)


@query(
    """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n_rows,
  count(DISTINCT (l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) AS n_versions FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, n_rows, n_versions FROM k WHERE n_versions > 1"""
)
def pk_conflict_split(s: S, d: str) -> D:
    return Q.key_versions(t.read(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]).where("n_versions > 1")


@query(
    """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n,
  count(DISTINCT (l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) AS v FROM lineitem GROUP BY ALL)
SELECT count(*) FILTER (v = 1) AS accepted, coalesce(sum(n) FILTER (v > 1), 0)::BIGINT AS rejected FROM k"""
)
def pk_conflict_rejects(s: S, d: str) -> D:
    good, bad = Q.pk_conflict_split(t.read(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])
    n = lambda x, c: x.agg(F.count(F.lit(1)).alias(c))
    return n(good, "accepted").join(n(bad, "rejected"), how="cross")


@query("SELECT count(*) FILTER (c_acctbal < 0 OR c_acctbal > 100) AS age_out_of_range, count(*) FILTER (c_nationkey % 5 < c_custkey % 5) AS redeem_before_issue, 0::BIGINT AS redeem_after_snapshot FROM customer")
def client_anomalies(s: S, d: str) -> D:
    day = lambda n: F.date_add(F.lit("2000-01-01").cast("date"), n.cast("int"))
    c = t.read(s, d, "customer").select(F.col("c_acctbal").alias("age"), day(F.col("c_custkey") % 5).alias("issue"), day(F.col("c_nationkey") % 5).alias("redeem"))
    return Q.client_anomalies(c, "issue", "redeem", "age", t.CUTOFF)


@query("SELECT count(*) FILTER (p_type IS NULL) AS null_level_2, count(*) FILTER (p_brand IS NULL) AS null_level_3, count(*) FILTER (p_retailprice <= 0) AS nonpositive_netto FROM part")
def product_anomalies(s: S, d: str) -> D:
    return Q.product_anomalies(t.products(s, d), ["level_2", "level_3"], "netto")


@query("SELECT o_orderkey, o_custkey AS client_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def fk_orphans(s: S, d: str) -> D:
    orders = t.read(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("client_id"))
    return Q.fk_orphans(orders, t.clients(s, d).where("age >= 0"), "client_id")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_key_check(s: S, d: str) -> D:
    return Q.duplicate_keys(t.read(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"WITH {LINES_SQL} SELECT (SELECT count(*) FROM clients) AS n_inputs, count(DISTINCT client_id) AS n_outputs, (SELECT count(*) FROM clients) - count(DISTINCT client_id) AS n_missing, 0::BIGINT AS n_unexpected FROM eligible")
def coverage_check(s: S, d: str) -> D:
    return Q.coverage_check(t.clients(s, d), eligible(s, d), ["client_id"])


@query("SELECT 'c_mktsegment' AS field, count(DISTINCT c_mktsegment) AS n_values, min(c_mktsegment) AS low, max(c_mktsegment) AS high FROM customer UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey), min(c_nationkey::VARCHAR), max(c_nationkey::VARCHAR) FROM customer")
def snapshot_contract_check(s: S, d: str) -> D:
    return Q.snapshot_contract(t.read(s, d, "customer"), ["c_mktsegment", "c_nationkey"])


@query(f"WITH {t.PURCHASES_SQL} SELECT count(*) AS n_rows, count(*) FILTER (transaction_datetime >= TIMESTAMP '2001-01-01') AS n_leaking FROM purchases")
def cutoff_leakage_check(s: S, d: str) -> D:
    return Q.cutoff_leakage(t.purchases(s, d), "transaction_datetime", t.CUTOFF)


@query(
    f"""WITH {FLAGS_SQL},
issues AS (
  SELECT 'invalid_value' AS code, 'age' AS field, client_id::VARCHAR AS example FROM raw WHERE bad_age
  UNION ALL SELECT 'invalid_value', 'flag', client_id::VARCHAR FROM raw WHERE bad_flag
  UNION ALL SELECT 'invalid_value', 'since', client_id::VARCHAR FROM raw WHERE bad_since
  UNION ALL SELECT 'feature_leakage', 'since', client_id::VARCHAR FROM raw WHERE since >= TIMESTAMP '2001-01-01'
  UNION ALL SELECT 'foreign_key_not_found', 'client_id', client_id::VARCHAR FROM raw WHERE client_id NOT IN (SELECT o_custkey FROM orders)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY code, field ORDER BY example) AS r FROM issues)
SELECT code, field, count(*) AS n_issues, string_agg(example, ',' ORDER BY example) FILTER (r <= 5) AS examples FROM ranked GROUP BY ALL"""
)
def validation_report(s: S, d: str) -> D:
    typed = scans.typed_columns(raw_customers(s, d), CUSTOMERS)
    parents = {"client_id": t.read(s, d, "orders").select(F.col("o_custkey").cast("int").alias("client_id"))}
    return Q.validation_report(typed, ["client_id"], "since", t.CUTOFF, parents, "client_id")


@query(
    f"""WITH {FLAGS_SQL}
SELECT 'client_id' AS field, count(*) AS n_rows, count(*) FILTER (client_id IS NULL) AS n_null, count(*) FILTER (bad_id) AS n_invalid, NULL::TIMESTAMP AS low, NULL::TIMESTAMP AS high, NULL::BIGINT AS rows_before, NULL::BIGINT AS rows_after FROM raw
UNION ALL SELECT 'age', count(*), count(*) FILTER (age IS NULL), count(*) FILTER (bad_age), NULL, NULL, NULL, NULL FROM raw
UNION ALL SELECT 'flag', count(*), count(*) FILTER (flag IS NULL), count(*) FILTER (bad_flag), NULL, NULL, NULL, NULL FROM raw
UNION ALL SELECT 'since', count(*), count(*) FILTER (since IS NULL), count(*) FILTER (bad_since), min(since), max(since),
  count(*) FILTER (since < TIMESTAMP '2001-01-01'), count(*) FILTER (since >= TIMESTAMP '2001-01-01') FROM raw"""
)
def validation_profile(s: S, d: str) -> D:
    return Q.validation_profile(scans.typed_columns(raw_customers(s, d), CUSTOMERS), "since", t.CUTOFF)


# Raw files with planted errors, written from the customers and orders.


def _raw_files(s: S, d: str) -> dict[str, str]:
    """Paths of the files: clients and purchases with errors, no products, labels without a column, and an empty file."""
    base = _path(s, "raw")

    def put(name: str, columns: list[str], lines: D) -> None:
        # One string column whose name is the header; nothing is quoted.
        lines.select(F.col("line").alias(",".join(columns))).write.options(header=True, sep="\u0001", quote="\u0000", emptyValue="").csv(f"{base}/{name}")

    k = F.col("c_custkey")
    c = t.read(s, d, "customer").where(k % 10 != 0)
    issued = F.when(k % 41 == 0, "").otherwise("2018-01-01 10:00:00")
    age = F.when(k % 37 == 0, "old").otherwise((k % 90).cast("string"))
    line = F.concat(F.concat_ws(",", k.cast("string"), issued, F.lit(""), age, F.lit("F")), F.when(k % 50 == 7, ",x").otherwise(""))
    lines = c.select(line.alias("line"), k)
    put("clients", REGISTRY["clients"].columns, lines.union(lines.where(k % 29 == 0)))
    o = t.read(s, d, "orders")
    at = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    rest = [F.lit(x) for x in ("1.0", "0.0", "0.0", "0.0", "100.0", "store-1", "product-1", "1.0", "", "")]
    put("purchases", REGISTRY["purchases"].columns, o.select(F.concat_ws(",", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"), at, *rest).alias("line")))
    put("uplift_train", ["client_id", "treatment_flg"], o.select(F.concat_ws(",", F.col("o_custkey").cast("string"), F.lit("1")).alias("line")))
    put("uplift_test", ["client_id"], o.select(F.lit("").alias("line")).limit(0))
    return {n: f"{base}/{n}" for n in ("clients", "products", "purchases", "uplift_train", "uplift_test")}


RAW_SQL = """raw_clients AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 41 = 0 THEN '' ELSE '2018-01-01 10:00:00' END AS issued,
    CASE WHEN c_custkey % 37 = 0 THEN 'old' ELSE CAST(c_custkey % 90 AS VARCHAR) END AS age FROM customer, (SELECT unnest([1, 2]) AS copy)
  WHERE c_custkey % 10 <> 0 AND (copy = 1 OR c_custkey % 29 = 0))"""


@query(
    f"""WITH {RAW_SQL},
issues AS (
  SELECT 'clients' AS file, 'malformed_row' AS code, '' AS field, k || ',' || issued || ',,' || age || ',F,x' AS example FROM raw_clients WHERE k % 50 = 7
  UNION ALL SELECT 'clients', 'null_required_value', 'first_issue_date', CAST(k AS VARCHAR) FROM raw_clients WHERE k % 41 = 0
  UNION ALL SELECT 'clients', 'invalid_value', 'age', age FROM raw_clients WHERE k % 37 = 0
  UNION ALL SELECT 'clients', 'duplicate_primary_key', 'client_id', CAST(k AS VARCHAR) FROM raw_clients GROUP BY k HAVING count(*) > 1
  UNION ALL SELECT 'purchases', 'purchase_client_not_found', 'client_id', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey NOT IN (SELECT k FROM raw_clients)
  UNION ALL SELECT 'purchases', 'feature_leakage', 'transaction_datetime', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
  UNION ALL SELECT 'products', 'missing_file', '', NULL
  UNION ALL SELECT 'uplift_train', 'missing_column', 'target', NULL
  UNION ALL SELECT 'uplift_test', 'empty_file', '', NULL),
counts AS (SELECT file, code, field, count(*) AS n_issues FROM issues GROUP BY ALL),
shown AS (SELECT DISTINCT file, code, field, example FROM issues WHERE example IS NOT NULL QUALIFY dense_rank() OVER (PARTITION BY file, code, field ORDER BY example) <= 5)
SELECT file, code, field, any_value(n_issues) AS n_issues, coalesce(string_agg(example, ';' ORDER BY example), '') AS examples
FROM counts LEFT JOIN shown USING (file, code, field) GROUP BY ALL"""
)
def raw_file_report(s: S, d: str) -> D:
    issues, _ = raw.raw_file_report(s, _raw_files(s, d), REGISTRY, t.CUTOFF, ("purchases", "transaction_datetime"))
    return issues.withColumn("examples", F.concat_ws(";", "examples"))


@query(
    f"""WITH {RAW_SQL}, p AS (SELECT count(*) AS n, min(o_orderdate) AS lo, max(o_orderdate) AS hi, count(*) FILTER (o_orderdate < TIMESTAMP '2001-01-01') AS b, count(*) FILTER (o_orderdate >= TIMESTAMP '2001-01-01') AS a FROM orders)
SELECT 'clients' AS file, 'first_issue_date' AS field, count(*) AS n_rows, count(*) FILTER (issued = '') AS n_null, TIMESTAMP '2018-01-01 10:00:00' AS low, TIMESTAMP '2018-01-01 10:00:00' AS high, 0 AS rows_before, count(*) FILTER (issued <> '') AS rows_after FROM raw_clients
UNION ALL SELECT 'clients', 'first_redeem_date', count(*), count(*), NULL, NULL, 0, 0 FROM raw_clients
UNION ALL SELECT 'clients', 'age', count(*), 0, NULL, NULL, NULL, NULL FROM raw_clients
UNION ALL SELECT 'purchases', 'transaction_datetime', n, 0, lo, hi, b, a FROM p
UNION ALL SELECT 'purchases', 'trn_sum_from_iss', n, n, NULL, NULL, NULL, NULL FROM p
UNION ALL SELECT 'uplift_test', 'client_id', 0, 0, NULL, NULL, NULL, NULL"""
)
def raw_file_profile(s: S, d: str) -> D:
    _, profile = raw.raw_file_report(s, _raw_files(s, d), REGISTRY, t.CUTOFF)
    wanted = F.col("field").isin("first_issue_date", "first_redeem_date", "age", "transaction_datetime", "trn_sum_from_iss") | (F.col("file") == "uplift_test")
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return profile.where(wanted).select("file", "field", "n_rows", "n_null", ntz("low"), ntz("high"), "rows_before", "rows_after")
