"""Registered queries of the training-data operators against their SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

pytest.importorskip("public_tokenizers")

from conftest import SF  # noqa: E402
from marketloom.llm import registry  # noqa: E402


@pytest.mark.parametrize("folder", [SF, SF.replace("0.001", "0.01")])
@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_sql(spark, folder, name):
    frame = registry.queries()[name](spark, folder)
    cols = sorted(frame.columns)
    got = sorted(tuple(map(str, (r[c] for c in cols))) for r in frame.collect())
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    found = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    assert sorted(tuple(str(r[names.index(c)]) for c in cols) for r in found.fetchall()) == got
