"""Data quality: profiles, conflicts, rejects and checks over whole tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.expressions import payload_digest
from marketloom.operators.distributed import BUCKET_ROWS, LEAST
from marketloom.sources.scans import BAD


def contract_profile(typed: DataFrame, group: str | None = None) -> DataFrame:
    """Rows and invalid values per field, for all rows or per group, in one pass."""
    flags = [c for c in typed.columns if c.startswith(BAD)]
    aggs = [F.count(F.lit(1)).alias("n_rows"), *(F.count_if(F.col(c)).alias("invalid_" + c.removeprefix(BAD)) for c in flags)]
    return (typed.groupBy(group) if group else typed.groupBy()).agg(*aggs)


def require_valid(profile: DataFrame) -> None:
    """An error if a group has no row or an invalid value."""
    bad = [c for c in profile.columns if c.startswith("invalid_")]
    wrong = F.col("n_rows") == 0
    for c in bad:
        wrong = wrong | (F.col(c) > 0)
    if row := profile.where(wrong).first():
        raise ValueError(f"contract broken: {row.asDict()}")


def validation_report(typed: DataFrame, keys: list[str], time_col: str | None, cutoff: datetime | None, parents: Mapping[str, DataFrame], example: str, n_examples: int = 5) -> DataFrame:
    """Issues of a table, a row per code and field: count and smallest example keys.

    Codes: invalid_value, duplicate_primary_key, foreign_key_not_found, feature_leakage.
    """
    flags = [c for c in typed.columns if c.startswith(BAD)]
    shown = F.col(example).cast("string")
    found = typed.select(
        shown.alias("example"),
        F.explode(F.array(*(F.when(F.col(c), F.struct(F.lit("invalid_value").alias("code"), F.lit(c.removeprefix(BAD)).alias("field"))) for c in flags))).alias("i"),
    ).where("i is not null").select("i.code", "i.field", "example")
    repeats = typed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = found.union(repeats.select(F.lit("duplicate_primary_key"), F.lit(keys[0]), F.col(keys[0]).cast("string")))
    for child, parent in parents.items():
        lost = fk_orphans(typed, parent, child)
        found = found.union(lost.select(F.lit("foreign_key_not_found"), F.lit(child), F.col(example).cast("string")))
    if time_col and cutoff:
        late = typed.where(F.col(time_col) >= F.lit(cutoff))
        found = found.union(late.select(F.lit("feature_leakage"), F.lit(time_col), shown))
    counts = found.groupBy("code", "field").agg(F.count(F.lit(1)).alias("n_issues"))
    rank = F.row_number().over(Window.partitionBy("code", "field").orderBy(F.asc_nulls_last("example")))
    # Cut to the first examples before the shuffle of the window.
    few = found.distinct().withColumn("r", rank).where(F.col("r") <= n_examples)
    shown = few.groupBy("code", "field").agg(F.concat_ws(",", F.sort_array(F.collect_list("example"))).alias("examples"))
    return counts.join(shown, ["code", "field"], "left").select("code", "field", "n_issues", F.coalesce("examples", F.lit("")).alias("examples"))


def validation_profile(typed: DataFrame, time_col: str | None = None, cutoff: datetime | None = None) -> DataFrame:
    """A row per field, from one pass: rows, nulls, invalid values; for the time, also its range and rows on both sides of the cutoff."""
    fields = [c for c in typed.columns if not c.startswith(BAD)]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in fields:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_null_{c}"), (F.count_if(F.col(BAD + c)) if BAD + c in typed.columns else F.lit(0).cast("long")).alias(f"_bad_{c}")]
    if time_col:
        at = F.col(time_col)
        aggs += [F.min(at).alias("_low"), F.max(at).alias("_high"), F.count_if(at < F.lit(cutoff)).alias("_before"), F.count_if(at >= F.lit(cutoff)).alias("_after")]
    timed = {"low": "timestamp", "high": "timestamp", "before": "bigint", "after": "bigint"}
    rows = [
        F.struct(
            F.lit(c).alias("field"), F.col("_rows").alias("n_rows"), F.col(f"_null_{c}").alias("n_null"), F.col(f"_bad_{c}").alias("n_invalid"),
            *((F.col(f"_{n}") if c == time_col else F.lit(None)).cast(kind).alias(n) for n, kind in timed.items()),
        )
        for c in fields
    ]
    return typed.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*").withColumnsRenamed({"before": "rows_before", "after": "rows_after"})


def pk_conflict_split(frame: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """One row per key with one version of its values, and all rows of keys with several.

    A version is a digest of all columns but the keys. Versions are counted per key
    with a map-side combine and joined back, so no key's rows gather in one task.
    """
    payload = [c for c in frame.columns if c not in keys]
    marked = frame.withColumn("_version", payload_digest(payload))
    split = marked.groupBy(*keys).agg((F.min("_version") != F.max("_version")).alias("_conflict"))
    good = frame.join(split.where("NOT _conflict").select(*keys), keys, "left_semi").dropDuplicates(keys)
    bad = frame.join(split.where("_conflict").select(*keys), keys, "left_semi")
    return good, bad.withColumn("reason_codes", F.array(F.lit("CONFLICTING_PRIMARY_KEY")))


def key_versions(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: its rows and how many versions of its values there are."""
    payload = [c for c in frame.columns if c not in keys]
    return frame.withColumn("_v", payload_digest(payload)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("_v").alias("n_versions"))


def reason_array(reasons: Mapping[str, Column]) -> Column:
    """The codes whose condition holds, in the given order."""
    return F.filter(F.array(*(F.when(c, F.lit(code)) for code, c in reasons.items())), lambda x: x.isNotNull())


def annotate_purchases(purchases: DataFrame, clients: DataFrame, products: DataFrame, snapshot_end: datetime, measure: str = "product_quantity") -> DataFrame:
    """Purchases with all their reject reasons and the soft flag of usable prices."""
    known_clients = clients.select("client_id", F.lit(True).alias("_c")).distinct()
    known_products = products.select("product_id", F.lit(True).alias("_p")).distinct()
    joined = purchases.join(known_clients, "client_id", "left").join(known_products, "product_id", "left")
    reasons = {
        "NONPOSITIVE_QUANTITY": F.coalesce(F.col(measure) <= 0, F.lit(True)),
        "UNKNOWN_CLIENT": F.col("_c").isNull(),
        "UNKNOWN_PRODUCT": F.col("_p").isNull(),
        "FUTURE_TRANSACTION": F.col("transaction_datetime") >= F.lit(snapshot_end),
    }
    valid_price = F.coalesce((F.col("trn_sum_from_iss") > 0) & (F.col(measure) > 0), F.lit(False))
    return joined.withColumns({"reason_codes": reason_array(reasons), "is_valid_for_price": valid_price}).drop("_c", "_p")


def quality_by_month(annotated: DataFrame, codes: Iterable[str]) -> DataFrame:
    """Per month: rows in, accepted, rejected, without price, counts per reason, exact repeats."""
    month = F.date_format("transaction_datetime", "yyyy-MM").alias("month")
    base = [c for c in annotated.columns if c not in ("reason_codes", "is_valid_for_price")]
    # Equal rows first collapse to one with a count, so repeats need no second pass.
    # They are dealt first, in partitions that follow the rows, so neither a file's rows nor a partition's gather in one task.
    dealt = annotated.repartition(max(LEAST, -(-annotated.count() // BUCKET_ROWS)), *base)
    rows = dealt.groupBy(*base, "reason_codes", "is_valid_for_price").agg(F.count(F.lit(1)).alias("_n"))
    rejected = F.size("reason_codes") > 0
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0))
    return rows.groupBy(month).agg(
        F.sum("_n").alias("rows_in"),
        total(~rejected).alias("rows_accepted"),
        total(rejected).alias("rows_rejected"),
        total(~rejected & ~F.col("is_valid_for_price")).alias("rows_without_price"),
        *(total(F.array_contains("reason_codes", c)).alias("n_" + c.lower()) for c in codes),
        F.sum(F.col("_n") - 1).alias("duplicate_rows"),
    )


def client_anomalies(clients: DataFrame, issue: str, redeem: str, age: str, snapshot_end: datetime) -> DataFrame:
    return clients.agg(
        F.count_if((F.col(age) < 0) | (F.col(age) > 100)).alias("age_out_of_range"),
        F.count_if(F.col(redeem) < F.col(issue)).alias("redeem_before_issue"),
        F.count_if(F.col(redeem) >= F.lit(snapshot_end)).alias("redeem_after_snapshot"),
    )


def product_anomalies(products: DataFrame, attributes: Iterable[str], netto: str) -> DataFrame:
    return products.agg(*(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in attributes), F.count_if(F.col(netto) <= 0).alias("nonpositive_netto"))


def fk_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key the parent has not; null keys are no orphans."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")


def duplicate_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def require_unique(frame: DataFrame, keys: list[str]) -> None:
    if row := duplicate_keys(frame, keys).first():
        raise ValueError(f"duplicate key {row.asDict()}")


def coverage_check(inputs: DataFrame, output: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys on both sides, and how many of either side the other lacks."""
    both = inputs.select(*keys, F.lit(1).alias("_i")).distinct().join(output.select(*keys, F.lit(1).alias("_o")).distinct(), keys, "full")
    return both.agg(
        F.count("_i").alias("n_inputs"),
        F.count("_o").alias("n_outputs"),
        F.count_if(F.col("_o").isNull()).alias("n_missing"),
        F.count_if(F.col("_i").isNull()).alias("n_unexpected"),
    )


def snapshot_contract(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Per contract column: how many values it has, and the smallest and largest, in one pass."""
    columns = list(columns)
    wide = frame.agg(*(x for c in columns for x in (F.countDistinct(c).alias(f"n_{c}"), F.min(F.col(c).cast("string")).alias(f"a_{c}"), F.max(F.col(c).cast("string")).alias(f"b_{c}"))))
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"n_{c}").alias("n_values"), F.col(f"a_{c}").alias("low"), F.col(f"b_{c}").alias("high")) for c in columns))
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def require_snapshot(frame: DataFrame, expected: Mapping[str, Any]) -> None:
    """An error unless each contract column holds exactly its expected value."""
    for row in snapshot_contract(frame, expected).collect():  # one row per contract column
        if row["n_values"] != 1 or row["low"] != str(expected[row["field"]]):
            raise ValueError(f"{row['field']}: {row['low']} to {row['high']}, not {expected[row['field']]}")


def cutoff_leakage(frame: DataFrame, time_col: str, cutoff: datetime) -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(time_col) >= F.lit(cutoff)).alias("n_leaking"))
