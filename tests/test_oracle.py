"""Every registered query against its DuckDB oracle on the smallest data."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, key, norm, rows_equal  # noqa: E402

from starloom.oracle import ORACLE  # noqa: E402
from starloom.plans.catalog import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)
    assert len(QUERIES) >= 42


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    s_rows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=key)
    cur = duck.execute(ORACLE[name])
    d_cols = [d[0] for d in cur.description]
    assert sorted(d_cols) == cols
    idx = [d_cols.index(c) for c in cols]
    d_rows = sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=key)
    assert len(s_rows) == len(d_rows)
    assert all(rows_equal(a, b, 1e-9) for a, b in zip(s_rows, d_rows))


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "customer_unique_id", "customer_city_asof", "customer_state_asof", "first_order_in_version",
        "last_order_in_version", "sales_in_version", "orders_in_version",
    ]
