"""Plan properties that matter at scale, checked on every registered query."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data folder not present")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_pairwise_joins_or_python_in_plan(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    assert not [f for f in FORBIDDEN if f in plan]


def test_topk_per_group_is_pushed_below_the_shuffle(spark):
    plan = _plan(E.queries()["q04_top3_per_category"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["gold_payment_analysis"](spark, SF))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("o_orderdate" not in s and "o_orderpriority" not in s for s in scans)


# Scans of a base table that a plan may hold, and tables it must not read at all (0). Payments
# and reviews are shaped from the orders table, so a model of all three scans it three times.
SCANS = {
    "gold_dim_customers": {"orders": 3, "lineitem": 0}, "gold_dim_products": {"lineitem": 1}, "gold_dim_sellers": {"lineitem": 2, "orders": 1},
    "gold_fct_orders": {"lineitem": 1, "orders": 3}, "int_order_details": {"lineitem": 1, "orders": 3},
    "int_customer_orders": {"lineitem": 1, "orders": 1}, "gold_seller_performance": {"lineitem": 2, "orders": 2},
    "gold_daily_kpi": {"lineitem": 1, "orders": 3}, "q10_last7d_kpi": {"lineitem": 1, "orders": 3},
    "q07_delivery_share": {"lineitem": 1, "orders": 1, "customer": 0, "supplier": 0, "nation": 0, "region": 0},
    "filter_in": {"lineitem": 2, "orders": 2, "customer": 0, "supplier": 0, "nation": 0, "region": 0},
    "p_late_share": {"lineitem": 0, "orders": 1, "customer": 0, "supplier": 0, "nation": 0, "region": 0},
    "dq_not_null": {"lineitem": 1}, "dq_singular": {"lineitem": 1},
}


@pytest.mark.parametrize("key", sorted(SCANS))
def test_scans_of_base_tables_have_a_ceiling(spark, key):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = _plan(E.queries()[key](spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    for table, most in SCANS[key].items():
        assert sum(f"/{table}.parquet]" in s for s in scans) <= most, table
