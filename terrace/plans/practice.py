"""Practice queries from the course guides, over the gold marts and the star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from terrace.functions import exprs as X
from terrace.functions.stats import ranked
from terrace.oracle import R2
from terrace.plans import analytics, marts, star
from terrace.plans.silver import SilverTables
from terrace.session import materialize

Tables = Mapping[str, DataFrame]
PRACTICE: dict[str, tuple] = {}


def practice(key: str, sql: str, *deps: str):
    def deco(fn):
        PRACTICE[key] = (fn, sql, deps)
        return fn
    return deco


@practice("p_ltv_by_city", f"""
SELECT customer_city, COUNT(*) AS customers, {R2('AVG(total_revenue)')} AS avg_ltv
FROM gold_customer_ltv GROUP BY customer_city ORDER BY avg_ltv DESC NULLS FIRST""", "gold_customer_ltv")
def p_ltv_by_city(t):
    return (marts.gold_customer_ltv(t).groupBy("customer_city")
            .agg(F.count(F.lit(1)).alias("customers"), X.round2(F.avg("total_revenue")).alias("avg_ltv"))
            .orderBy(F.col("avg_ltv").desc_nulls_first()))


@practice("p_sellers_below_avg", """
SELECT seller_id, avg_customer_review FROM gold_seller_performance
WHERE avg_customer_review < (SELECT AVG(avg_customer_review) FROM gold_seller_performance)""",
          "gold_seller_performance")
def p_sellers_below_avg(t):
    s = materialize(marts.gold_seller_performance(t))  # computed once, read twice
    avg = s.agg(F.avg("avg_customer_review")).scalar()
    return s.where(F.col("avg_customer_review") < avg).select("seller_id", "avg_customer_review")


@practice("p_late_share", f"""
SELECT COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT order_id) FILTER (WHERE delivery_status = 'Late') AS late_orders,
       {R2("100.0 * COUNT(DISTINCT order_id) FILTER (WHERE delivery_status = 'Late') / COUNT(DISTINCT order_id)")} AS late_pct
FROM gold_order_fulfillment""", "gold_order_fulfillment")
def p_late_share(t):
    f = marts.fulfilled_orders(t)  # every order is in the mart, with or without items
    return (f.agg(F.countDistinct("order_id").alias("orders"),
                  F.countDistinct(F.when(F.col("delivery_status") == "Late", F.col("order_id"))).alias("late_orders"))
            .select("orders", "late_orders", X.pct("late_orders", "orders").alias("late_pct")))


@practice("p_payment_rank_month", """
SELECT month, payment_type, transactions,
       DENSE_RANK() OVER (PARTITION BY month ORDER BY transactions DESC) AS popularity_rank
FROM (SELECT date_trunc('month', o.order_purchase_timestamp) AS month, p.payment_type, COUNT(*) AS transactions
      FROM fact_order_payment p JOIN fact_order o ON p.order_id = o.order_id GROUP BY 1, 2)""",
          "fact_order_payment", "fact_order")
def p_payment_rank_month(t):
    months = t["fact_order"].select(
        "order_id", X.month_start("order_purchase_timestamp").alias("month"))
    per_month = (t["fact_order_payment"].select("order_id", "payment_type").join(months, "order_id")
                 .groupBy("month", "payment_type").agg(F.count(F.lit(1)).alias("transactions")))
    w = Window.partitionBy("month").orderBy(F.col("transactions").desc())
    return per_month.select("month", "payment_type", "transactions", F.dense_rank().over(w).cast("bigint").alias("popularity_rank"))


@practice("p_delivered_daily", """
SELECT CAST(order_purchase_timestamp AS DATE) AS date, COUNT(*) AS orders, SUM(price) AS revenue
FROM fact_order o JOIN fact_order_item oi ON o.order_id = oi.order_id
WHERE order_status = 'delivered' GROUP BY 1""", "fact_order", "fact_order_item")
def p_delivered_daily(t):
    o = (t["fact_order"].where(F.col("order_status") == "delivered")
         .select("order_id", F.to_date("order_purchase_timestamp").alias("date")))
    return (o.join(t["fact_order_item"].select("order_id", "price"), "order_id")
            .groupBy("date").agg(F.count(F.lit(1)).alias("orders"), F.sum("price").alias("revenue")))


@practice("p_top5_customers", """
WITH customer_revenue AS (SELECT customer_id, customer_city, total_revenue FROM gold_customer_ltv
                          WHERE total_revenue IS NOT NULL)
SELECT * FROM customer_revenue ORDER BY total_revenue DESC, customer_id LIMIT 5""", "gold_customer_ltv")
def p_top5_customers(t, k: int = 5):
    c = marts.gold_customer_ltv(t).where(F.col("total_revenue").isNotNull())
    return (c.select("customer_id", "customer_city", "total_revenue")
            .orderBy(F.col("total_revenue").desc(), "customer_id").limit(k))


@practice("p_seller_rank_state", """
SELECT seller_state, seller_id, total_revenue,
       RANK() OVER (PARTITION BY seller_state ORDER BY total_revenue DESC NULLS FIRST) AS state_rank
FROM gold_seller_performance""", "gold_seller_performance")
def p_seller_rank_state(t):
    s = marts.gold_seller_performance(t).select("seller_state", "seller_id", "total_revenue")
    return ranked(s, ["seller_state"], [F.col("total_revenue").desc_nulls_first(), F.col("seller_id")],
                  ["total_revenue"], rank="state_rank")


@practice("p_monthly_running", """
SELECT month, CAST(revenue AS DOUBLE) AS revenue, CAST(SUM(revenue) OVER (ORDER BY month) AS DOUBLE) AS running_revenue
FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, SUM(CAST(total_revenue AS DECIMAL(38,2))) AS revenue
      FROM gold_daily_sales_summary GROUP BY 1)""", "gold_daily_sales_summary")
def p_monthly_running(t):
    m = (marts.gold_daily_sales_summary(t)
         .groupBy(F.trunc("order_date", "month").alias("month"))
         .agg(analytics.exact_sum("total_revenue").alias("revenue")))
    # Month grain: bounded by the calendar, so an unpartitioned running window is fine.
    return m.select("month", F.col("revenue").cast("double").alias("revenue"),
                    F.sum("revenue").over(Window.orderBy("month")).cast("double").alias("running_revenue"))


@practice("p_wow_change", f"""
SELECT week, CAST(revenue AS DOUBLE) AS revenue,
       {R2('(CAST(revenue AS DOUBLE) - LAG(CAST(revenue AS DOUBLE)) OVER (ORDER BY week)) / NULLIF(LAG(CAST(revenue AS DOUBLE)) OVER (ORDER BY week), 0) * 100')} AS wow_change_pct
FROM (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, SUM(CAST(total_revenue AS DECIMAL(38,2))) AS revenue
      FROM gold_daily_sales_summary GROUP BY 1)""", "gold_daily_sales_summary")
def p_wow_change(t):
    wk = (marts.gold_daily_sales_summary(t)
          .groupBy(F.trunc("order_date", "week").alias("week"))
          .agg(analytics.exact_sum("total_revenue").cast("double").alias("revenue")))
    return wk.select("week", "revenue", analytics.change_pct("revenue", Window.orderBy("week")).alias("wow_change_pct"))


@practice("p_star_category", f"""
WITH category_stats AS (
    SELECT product_category_english, COUNT(*) AS products, CAST(SUM(total_orders) AS BIGINT) AS orders,
           {R2('SUM(total_revenue)')} AS revenue
    FROM gold_dim_products GROUP BY product_category_english)
SELECT * FROM category_stats ORDER BY revenue DESC""", "gold_dim_products")
def p_star_category(t):
    p = star.gold_dim_products(SilverTables(t))
    return (p.groupBy("product_category_english").agg(
        F.count(F.lit(1)).alias("products"), F.sum("total_orders").alias("orders"),
        X.round2(F.sum("total_revenue")).alias("revenue")).orderBy(F.col("revenue").desc()))


@practice("p_customer_rank_state", """
SELECT customer_state, customer_id, total_revenue,
       RANK() OVER (PARTITION BY customer_state ORDER BY total_revenue DESC) AS state_rank
FROM gold_dim_customers""", "gold_dim_customers")
def p_customer_rank_state(t):
    c = star.gold_dim_customers(SilverTables(t)).select("customer_state", "customer_id", "total_revenue")
    return ranked(c, ["customer_state"], [F.col("total_revenue").desc(), F.col("customer_id")],
                  ["total_revenue"], rank="state_rank")
