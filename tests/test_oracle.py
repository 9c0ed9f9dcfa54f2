"""Every registered query against its DuckDB oracle on the smallest data folder."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data folder not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    oracle = E.oracle_sql().get(key)
    if oracle is None:
        pytest.skip("no oracle")
    res = con.execute(oracle)
    d_cols, d_rows = canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "cumulative_revenue" in df.columns
