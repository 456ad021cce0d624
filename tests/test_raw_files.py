"""Reports on raw files with one error each, and checks that raise."""

from __future__ import annotations

from datetime import datetime

import pytest

from marketloom.operators import quality
from marketloom.operators.raw_files import raw_file_report
from marketloom.sources import scans
from marketloom.sources.contracts import REGISTRY

CUTOFF = datetime(2019, 3, 1)
# One valid row a file.
FILES = {
    "clients": ["client-1,2018-01-01 10:00:00,,35,F"],
    "products": ["product-1,l1,l2,l3,l4,1,brand-1,vendor-1,0.5,0,0"],
    "purchases": ["client-1,transaction-1,2019-01-01 12:00:00,1,0,0,0,100,store-1,product-1,1,50,"],
    "uplift_train": ["client-1,1,0"],
    "uplift_test": ["client-1"],
}


def report(spark, tmp_path, changes=None, lacks=(), headers=None, strict=False):
    paths = {}
    for name, lines in (FILES | (changes or {})).items():
        paths[name] = f"{tmp_path}/{name}.csv"
        if name not in lacks:
            head = (headers or {}).get(name, ",".join(REGISTRY[name].columns))
            with open(paths[name], "w", encoding="utf-8") as out:
                out.write("\n".join([head, *lines]) + "\n" if head is not None else "")
    issues, profile = raw_file_report(spark, paths, REGISTRY, CUTOFF, ("purchases", "transaction_datetime") if strict else None)
    return {(r.file, r.code, r.field): (r.n_issues, r.examples) for r in issues.collect()}, {(r.file, r.field): r for r in profile.collect()}


def test_valid_files(spark, tmp_path):
    issues, profile = report(spark, tmp_path)
    assert issues == {}
    time = profile["purchases", "transaction_datetime"]
    assert (time.n_rows, time.rows_before, time.rows_after, time.low) == (1, 1, 0, datetime(2019, 1, 1, 12))
    assert profile["clients", "first_redeem_date"].n_null == 1 and len(profile) == sum(len(c.fields) for c in REGISTRY.values())


def test_a_time_that_is_none(spark, tmp_path):
    row = "client-1,invalid-transaction,not-a-timestamp,1.0,0.0,0.0,0.0,100.0,store-1,product-1,1.0,100.0,"
    issues, profile = report(spark, tmp_path, {"purchases": [row]})
    assert issues == {("purchases", "invalid_value", "transaction_datetime"): (1, ["not-a-timestamp"])}
    assert profile["purchases", "transaction_datetime"].low is None


def test_missing_files_and_unknown_clients(spark, tmp_path):
    issues, _ = report(spark, tmp_path, {"uplift_train": ["unknown-client,1,0"]}, lacks=["purchases"])
    assert issues == {("purchases", "missing_file", ""): (1, []), ("uplift_train", "uplift_client_not_found", "client_id"): (1, ["unknown-client"])}
    # Without the parent file nothing is said of references to it.
    issues, _ = report(spark, tmp_path / "..", {"uplift_train": ["unknown-client,1,0"]}, lacks=["clients"])
    assert set(issues) == {("clients", "missing_file", "")}


def test_unknown_products_and_leakage(spark, tmp_path):
    late = FILES["purchases"][0].replace("product-1", "other").replace("2019-01-01 12:00:00", "2019-03-01 00:00:00")
    issues, profile = report(spark, tmp_path, {"purchases": [late]})
    assert issues == {("purchases", "purchase_product_not_found", "product_id"): (1, ["other"])}
    assert (profile["purchases", "transaction_datetime"].rows_before, profile["purchases", "transaction_datetime"].rows_after) == (0, 1)
    issues, _ = report(spark, tmp_path, {"purchases": [late]}, strict=True)
    assert issues["purchases", "feature_leakage", "transaction_datetime"] == (1, ["2019-03-01 00:00:00"])


def test_malformed_rows_and_empty_values(spark, tmp_path):
    lines = [
        *FILES["clients"], "client-2,2018-01-01 10:00:00,,35,F,extra", "client-3,2018-01-01 10:00:00,,35,F,", 'client-4,2018-01-01 10:00:00,,35,"a,b"',
        "client-5", ",2018-01-01 10:00:00,,nan,F", "client-1,2018-01-01 10:00:00,,inf,F", "client-1,2018-01-01 10:00:00,, ,",
    ]
    issues, profile = report(spark, tmp_path, {"clients": lines})
    assert issues == {
        ("clients", "malformed_row", ""): (2, ["client-2,2018-01-01 10:00:00,,35,F,extra", "client-3,2018-01-01 10:00:00,,35,F,"]),
        ("clients", "null_required_value", "first_issue_date"): (1, ["client-5"]),
        ("clients", "null_required_value", "client_id"): (1, [""]),
        ("clients", "invalid_value", "age"): (2, ["inf", "nan"]),
        ("clients", "duplicate_primary_key", "client_id"): (2, ["client-1"]),
    }
    assert profile["clients", "age"].n_rows == 8 and profile["clients", "age"].n_null == 2


def test_at_most_five_examples(spark, tmp_path):
    issues, _ = report(spark, tmp_path, {"uplift_train": [f"client-1{k},7,0" for k in range(9)]})
    assert issues["uplift_train", "invalid_value", "treatment_flg"] == (9, ["7"])
    assert issues["uplift_train", "uplift_client_not_found", "client_id"] == (9, [f"client-1{k}" for k in range(5)])


def test_headers_and_empty_files(spark, tmp_path):
    issues, profile = report(spark, tmp_path, {"uplift_test": []}, headers={"uplift_train": "client_id,target"})
    assert issues == {("uplift_test", "empty_file", ""): (1, []), ("uplift_train", "missing_column", "treatment_flg"): (1, [])}
    assert profile["uplift_test", "client_id"].n_rows == 0 and ("uplift_train", "client_id") not in profile


def test_checks_that_raise(spark):
    """Broken contracts, double keys, and snapshots that mix runs."""
    raw = spark.createDataFrame([("a", "1", "0"), ("a", "9", "1")], "client_id string, treatment_flg string, target string")
    typed = scans.typed_columns(raw, REGISTRY["uplift_train"])
    with pytest.raises(ValueError, match="contract broken"):
        quality.require_valid(quality.contract_profile(typed))
    quality.require_valid(quality.contract_profile(typed.where("treatment_flg = 1")))
    with pytest.raises(ValueError, match="contract broken"):
        quality.require_valid(quality.contract_profile(typed.limit(0)))
    with pytest.raises(ValueError, match="duplicate key"):
        quality.require_unique(raw, ["client_id"])
    quality.require_unique(raw, ["client_id", "target"])
    mixed = spark.createDataFrame([("2019-01-01", 30), ("2019-01-02", 30)], "snapshot string, days int")
    with pytest.raises(ValueError, match="snapshot"):
        quality.require_snapshot(mixed, {"snapshot": "2019-01-01", "days": 30})
    with pytest.raises(ValueError, match="days"):
        quality.require_snapshot(mixed.limit(1), {"snapshot": "2019-01-01", "days": 60})
    quality.require_snapshot(mixed.limit(1), {"snapshot": "2019-01-01", "days": 30})
    rows = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "only")], "k int, version int, v string")
    assert sorted(r.v for r in scans.latest_version(rows, ["k"], ["version"]).collect()) == ["new", "only"]
