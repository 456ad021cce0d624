"""Registered queries against their SQL in DuckDB on the smallest tables, and streams and approximate functions on larger ones too."""

from __future__ import annotations

import datetime
import decimal

import duckdb
import pytest

from conftest import SF
from marketloom.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


LARGER = SF.replace("0.001", "0.01")
#: Queries whose results hang on state, batches, summaries, quantiles or hashes.
DELICATE = [n for n in registry.SQL if n.startswith("stream_")] + [
    "merge_partitions", "export_ledger", "batch_id", "budget_allocation", "categorical_top_values", "overlap_diagnostics", "winsorize", "price_outlier_filter", "hierarchical_median_price",
    "global_percent_rank", "stratified_cap", "raw_file_report",
]


def connect(folder):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def duck():
    return {folder: connect(folder) for folder in (SF, LARGER)}


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 8) + 0.0)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.parametrize("folder, name", [(SF, n) for n in registry.SQL] + [(LARGER, n) for n in DELICATE])
def test_query_equals_sql(spark, duck, folder, name):
    df = registry.QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    res = duck[folder].execute(registry.SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert got == want
