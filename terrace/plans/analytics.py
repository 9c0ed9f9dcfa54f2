"""Analytic queries over the gold marts (executive KPIs, rankings, trends, shares).

Window functions without PARTITION BY are only applied to results grouped by a bounded
dimension: calendar days, review scores, statuses, payment types, categories (one row per
group), never to customer, seller or item grain. Top-k uses ``orderBy().limit()`` (a
distributed take-ordered) with a unique tie-breaker.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from terrace.functions.exprs import round2, safe_ratio, share_of_group_total
from terrace.plans import marts

Tables = Mapping[str, DataFrame]

# Output labels of the tier and sentiment buckets.
TIER_LABELS = ("Platinum 💎", "Gold 🥇", "Silver 🥈", "Bronze 🥉")
SENTIMENT_LABELS = ("Positive ✅", "Neutral ➖", "Negative ❌")


def change_pct(value: str, w: Window) -> F.Column:
    """``ROUND((x - LAG(x)) / NULLIF(LAG(x), 0) * 100, 2)``."""
    prev = F.lag(value, 1).over(w)
    return round2(F.try_divide(F.col(value) - prev, F.nullif(prev, F.lit(0.0))) * 100)


def exact_sum(c: str) -> F.Column:
    """SUM of 2-decimal money values done in DECIMAL, so every engine gets the same digits."""
    return F.sum(F.col(c).cast("decimal(38,2)"))


# ---------------------------------------------------------------- Q1
def q01_exec_kpi(t: Tables) -> DataFrame:
    o = marts.valid_orders(t).select("order_id", "customer_id")
    it = marts.item_stats_per_order(t["fact_order_item"])
    rv = marts.review_stats_per_order(t["fact_order_review"])
    ir = F.greatest(F.coalesce("it_rows", F.lit(0)), F.lit(1))
    rr = F.greatest(F.coalesce("rv_rows", F.lit(0)), F.lit(1))
    per_order = (o.join(it, "order_id", "left").join(rv, "order_id", "left")
                 .select("order_id", "customer_id", (F.col("it_price") * rr).alias("p_sum"),
                         (F.col("rv_sum") * ir).alias("s_sum"), (F.col("rv_cnt") * ir).alias("s_cnt")))
    kpi = per_order.agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("total_customers"),
        round2(F.sum("p_sum")).alias("total_revenue"),
        round2(F.try_divide(F.sum("s_sum").cast("double"), F.sum("s_cnt").cast("double"))).alias("avg_review_score"))
    return kpi.select("*", round2(safe_ratio("total_revenue", "total_orders")).alias("revenue_per_order"))


# ---------------------------------------------------------------- Q2
def q02_top10_products(t: Tables, k: int = 10) -> DataFrame:
    p = marts.gold_product_performance(t)
    return (p.select("product_id", "category_english", "total_units_sold", "total_revenue", "total_orders",
                     "avg_unit_price", "avg_review_score",
                     round2(safe_ratio("total_revenue", "total_units_sold")).alias("revenue_per_unit"))
            .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("product_id").asc())
            .limit(k))


# ---------------------------------------------------------------- Q3
def q03_category_share(t: Tables) -> DataFrame:
    c = marts.gold_category_performance(t)
    return (c.select("category_name", "total_products", "total_orders", "total_units_sold", "total_revenue",
                     "avg_review_score", share_of_group_total("total_revenue").alias("revenue_share_pct"))
            .orderBy(F.col("total_revenue").desc_nulls_first(), "category_name"))


# ---------------------------------------------------------------- Q4
def q04_top3_per_category(t: Tables, k: int = 3) -> DataFrame:
    p = marts.gold_product_performance(t).where(F.col("total_units_sold") > 0)
    w = Window.partitionBy("category_english").orderBy(F.col("total_revenue").desc_nulls_first())
    return (p.select("category_english", "product_id", "total_units_sold", "total_revenue",
                     F.dense_rank().over(w).cast("bigint").alias("rank_in_category"))
            .where(F.col("rank_in_category") <= k)
            .orderBy("category_english", "rank_in_category", "product_id"))


# ---------------------------------------------------------------- Q5
def revenue_tier(c: str = "total_revenue") -> F.Column:
    x = F.col(c)
    return (F.when(x >= 500, TIER_LABELS[0]).when(x >= 200, TIER_LABELS[1])
            .when(x >= 100, TIER_LABELS[2]).otherwise(TIER_LABELS[3]))


def q05_customer_tiers(t: Tables) -> DataFrame:
    """Customer segments by lifetime revenue. The source query also numbers customers by
    revenue but never reads that number, so the plan does not compute it."""
    ltv = marts.gold_customer_ltv(t).where(F.col("total_orders") > 0)
    return (ltv.groupBy(revenue_tier().alias("customer_tier")).agg(
        F.count(F.lit(1)).alias("total_customers"),
        round2(F.avg("total_revenue")).alias("avg_revenue"),
        round2(F.avg("total_orders")).alias("avg_orders"),
        round2(F.avg("customer_lifetime_days")).alias("avg_lifetime_days"),
        F.min("total_revenue").alias("_min_rev"))
        .orderBy(F.col("_min_rev").desc_nulls_first()).drop("_min_rev"))


# ---------------------------------------------------------------- Q6
def q06_sales_trend(t: Tables) -> DataFrame:
    d = marts.gold_daily_sales_summary(t)
    w = Window.orderBy("order_date")
    w7 = w.rowsBetween(-6, 0)
    return (d.select(
        "order_date", "total_orders", "total_revenue",
        exact_sum("total_revenue").over(w).cast("double").alias("cumulative_revenue"),
        (exact_sum("total_revenue").over(w7).cast("double") / F.count("total_revenue").over(w7))
        .alias("revenue_ma_7d"),
        change_pct("total_revenue", w).alias("revenue_dod_change_pct"))
        .orderBy("order_date"))


# ---------------------------------------------------------------- Q7
def q07_delivery_share(t: Tables) -> DataFrame:
    """Over the rows of the fulfillment mart: an order stands for each of its items, or for one
    row without any. Customers and sellers add no row and are not read."""
    f = marts.fulfilled_orders(t).where(F.col("delivery_status").isin("On Time", "Late"))
    items = t["fact_order_item"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    w = F.coalesce("n_items", F.lit(1))

    def average(c: str) -> F.Column:
        return round2(F.try_divide(F.sum(F.col(c) * w), F.sum(F.when(F.col(c).isNotNull(), w)).cast("double")))

    return (f.join(items, "order_id", "left").groupBy("delivery_status").agg(
        F.sum(w).alias("total_orders"),
        average("approval_hours").alias("avg_approval_hours"),
        average("fulfillment_hours").alias("avg_fulfillment_hours"),
        average("delivery_vs_estimate_hours").alias("avg_delay_hours"))
        .select("delivery_status", "total_orders", share_of_group_total("total_orders").alias("pct_of_total"),
                "avg_approval_hours", "avg_fulfillment_hours", "avg_delay_hours"))


# ---------------------------------------------------------------- Q8
def q08_payment_usage(t: Tables) -> DataFrame:
    p = marts.gold_payment_analysis(t)
    return (p.select("payment_type", "total_transactions", "total_payment_volume", "avg_payment_value",
                     "avg_installments", share_of_group_total("total_transactions").alias("usage_pct"))
            .orderBy(F.col("total_payment_volume").desc_nulls_first()))


# ---------------------------------------------------------------- Q9
def sentiment(c: str = "review_score") -> F.Column:
    x = F.col(c)
    return F.when(x >= 4, SENTIMENT_LABELS[0]).when(x == 3, SENTIMENT_LABELS[1]).otherwise(SENTIMENT_LABELS[2])


def q09_sentiment(t: Tables) -> DataFrame:
    r = marts.gold_review_analysis(t)
    return (r.groupBy(sentiment().alias("sentiment")).agg(
        F.sum("total_reviews").alias("total_reviews"),
        round2(F.sum("pct_of_total")).alias("pct_of_total"))
        .orderBy(F.col("total_reviews").desc_nulls_first()))


# ---------------------------------------------------------------- Q10
def q10_last7d_kpi(t: Tables, days: int = 7) -> DataFrame:
    k = marts.gold_daily_kpi(t)
    # Day grain (bounded by the calendar): the newest date comes from a window over the daily
    # rows, so the daily KPI mart is computed once.
    newest = F.max("date").over(Window.partitionBy())
    recent = (k.withColumn("_since", F.date_sub(newest, days)).where(F.col("date") >= F.col("_since"))
              .drop("_since"))
    w = Window.orderBy("date")
    return (recent.select("date", "orders", "unique_customers", "revenue", "items_sold", "revenue_per_order",
                          "avg_daily_score", change_pct("revenue", w).alias("revenue_growth_pct"))
            .orderBy(F.col("date").desc()))


ANALYTIC_QUERIES = {
    "q01_exec_kpi": q01_exec_kpi,
    "q02_top10_products": q02_top10_products,
    "q03_category_share": q03_category_share,
    "q04_top3_per_category": q04_top3_per_category,
    "q05_customer_tiers": q05_customer_tiers,
    "q06_sales_trend": q06_sales_trend,
    "q07_delivery_share": q07_delivery_share,
    "q08_payment_usage": q08_payment_usage,
    "q09_sentiment": q09_sentiment,
    "q10_last7d_kpi": q10_last7d_kpi,
}
