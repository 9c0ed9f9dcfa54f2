"""Skew-sensitive queries on a skewed copy of the smallest data folder.

One order holds a third of all line items and one customer a third of all orders; the
results must still equal the oracle's.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data folder not present")
KEYS = ["gold_order_fulfillment", "gold_daily_kpi", "gold_fct_orders", "gold_product_performance", "gold_customer_ltv",
        "gold_dim_customers", "q01_exec_kpi", "join_left", "win_rank_lead", "p_customer_rank_state", "win_row_number",
        "agg_median", "stream_incremental_orders"]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    out = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for t in TABLES:
        q = f"SELECT * FROM '{SF}/{t}.parquet'"
        if t == "lineitem":
            q = (f"SELECT CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey, * EXCLUDE (l_orderkey) "
                 f"FROM '{SF}/lineitem.parquet'")
        elif t == "orders":
            q = f"SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 1 THEN 1 ELSE o_custkey END AS o_custkey) FROM '{SF}/orders.parquet'"
        con.execute(f"COPY ({q}) TO '{out}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{out}/{t}.parquet')")
    return out, con


@pytest.mark.parametrize("key", KEYS)
def test_skewed_matches_oracle(spark, skewed, key):
    folder, con = skewed
    df = E.queries()[key](spark, folder)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[key])
    d_cols, d_rows = canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols and s_rows == d_rows
