"""One small query per primitive operator (projection, filter, join, aggregate, window, sort,
scalar function), each run over the whole raw / silver / gold tables.

``PRIMS[key] = (build(tables) -> DataFrame, oracle SQL, oracle dependencies)``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from terrace.functions import exprs as X
from terrace.functions.joins import left_join_many
from terrace.functions.stats import exact_median, global_row_number, ranked, top_distinct_ranked
from terrace.oracle import INITCAP, R2
from terrace.plans import analytics, marts
from terrace.plans.silver import SilverTables
from terrace.session import materialize

Tables = Mapping[str, DataFrame]
PRIMS: dict[str, tuple] = {}


def prim(key: str, sql: str, *deps: str):
    def deco(fn):
        PRIMS[key] = (fn, sql, deps)
        return fn
    return deco


VALID = "order_status NOT IN ('canceled', 'unavailable')"

# ====================================================================== 2.3 projections / filters
@prim("select_rename", """
SELECT order_id AS id_order, order_item_id AS line_no, product_id AS id_product, seller_id AS id_seller,
       price AS item_price, freight_value AS item_freight FROM fact_order_item""", "fact_order_item")
def select_rename(t):
    return t["fact_order_item"].select(
        F.col("order_id").alias("id_order"), F.col("order_item_id").alias("line_no"),
        F.col("product_id").alias("id_product"), F.col("seller_id").alias("id_seller"),
        F.col("price").alias("item_price"), F.col("freight_value").alias("item_freight"))


@prim("fill_null_const", """
SELECT review_id, COALESCE(review_score, 0) AS review_score, COALESCE(review_comment_title, 'other') AS review_comment_title,
       COALESCE(review_comment_message, 'other') AS review_comment_message FROM fact_order_review""", "fact_order_review")
def fill_null_const(t):
    return (t["fact_order_review"].select("review_id", "review_score", "review_comment_title", "review_comment_message")
            .fillna({"review_score": 0, "review_comment_title": "other", "review_comment_message": "other"}))


@prim("fill_null_median", """
SELECT order_id, order_item_id, COALESCE(price, (SELECT MEDIAN(price) FROM fact_order_item)) AS price
FROM fact_order_item""", "fact_order_item")
def fill_null_median(t):
    items = t["fact_order_item"]
    med = exact_median(items, "price").scalar()
    return items.select("order_id", "order_item_id", F.coalesce(F.col("price"), med).alias("price"))


@prim("cast_int64", """
SELECT order_id, payment_sequential, CAST(payment_installments AS BIGINT) AS payment_installments,
       CAST(trunc(payment_value) AS BIGINT) AS payment_value_int FROM fact_order_payment""", "fact_order_payment")
def cast_int64(t):
    return t["fact_order_payment"].select(
        "order_id", "payment_sequential", F.col("payment_installments").cast("bigint").alias("payment_installments"),
        F.col("payment_value").cast("bigint").alias("payment_value_int"))


@prim("filter_threshold", "SELECT review_id, order_id, review_score FROM fact_order_review WHERE review_score >= 4",
      "fact_order_review")
def filter_threshold(t):
    return t["fact_order_review"].where(F.col("review_score") >= 4).select("review_id", "order_id", "review_score")


@prim("filter_not_in", f"SELECT order_id, order_status FROM fact_order WHERE {VALID}", "fact_order")
def filter_not_in(t):
    return t["fact_order"].where(X.not_canceled()).select("order_id", "order_status")


@prim("filter_not_in_keep_null", f"SELECT order_id, order_status FROM fact_order WHERE order_status IS NULL OR {VALID}",
      "fact_order")
def filter_not_in_keep_null(t):
    return t["fact_order"].where(X.not_canceled_keep_null()).select("order_id", "order_status")


@prim("filter_in", """
SELECT order_id, delivery_status FROM gold_order_fulfillment WHERE delivery_status IN ('On Time', 'Late')""",
      "gold_order_fulfillment")
def filter_in(t):
    o = marts.fulfilled_orders(t).where(F.col("delivery_status").isin("On Time", "Late")).select("order_id", "delivery_status")
    return left_join_many(o, t["fact_order_item"].select("order_id", "order_item_id"), ["order_id"]).select("order_id", "delivery_status")


@prim("filter_bool", "SELECT order_id, order_status FROM silver_fact_orders WHERE NOT is_canceled",
      "silver_fact_orders")
def filter_bool(t):
    return SilverTables(t)["silver_fact_orders"].where(~F.col("is_canceled")).select("order_id", "order_status")


@prim("flag_equals", "SELECT order_id, order_status, is_delivered FROM silver_fact_orders", "silver_fact_orders")
def flag_equals(t):
    return SilverTables(t)["silver_fact_orders"].select("order_id", "order_status", "is_delivered")


@prim("flag_in", "SELECT order_id, order_status, is_canceled FROM silver_fact_orders", "silver_fact_orders")
def flag_in(t):
    return SilverTables(t)["silver_fact_orders"].select("order_id", "order_status", "is_canceled")


@prim("null_or_negative_to_zero", """
SELECT order_id, order_item_id, price AS raw_price,
       CASE WHEN price IS NULL OR price < 0 THEN 0 ELSE price END AS price FROM fact_order_item""", "fact_order_item")
def null_or_negative_to_zero(t):
    return t["fact_order_item"].select("order_id", "order_item_id", F.col("price").alias("raw_price"),
                                       X.null_or_negative_to_zero("price").alias("price"))


@prim("clamp_keep_null", """
SELECT review_id, review_score AS raw_score,
       CASE WHEN review_score < 1 THEN 1 WHEN review_score > 5 THEN 5 ELSE review_score END AS review_score
FROM fact_order_review""", "fact_order_review")
def clamp_keep_null(t):
    return t["fact_order_review"].select("review_id", F.col("review_score").alias("raw_score"),
                                         X.clamp_keep_null("review_score").alias("review_score"))


@prim("case_tier", """
SELECT customer_id, total_revenue,
       CASE WHEN total_revenue >= 500 THEN 'Platinum 💎' WHEN total_revenue >= 200 THEN 'Gold 🥇'
            WHEN total_revenue >= 100 THEN 'Silver 🥈' ELSE 'Bronze 🥉' END AS customer_tier
FROM gold_customer_ltv""", "gold_customer_ltv")
def case_tier(t):
    return marts.gold_customer_ltv(t).select("customer_id", "total_revenue",
                                             analytics.revenue_tier().alias("customer_tier"))


@prim("case_sentiment", """
SELECT review_id, review_score, CASE WHEN review_score >= 4 THEN 'Positive ✅' WHEN review_score = 3 THEN 'Neutral ➖'
       ELSE 'Negative ❌' END AS sentiment FROM fact_order_review""", "fact_order_review")
def case_sentiment(t):
    return t["fact_order_review"].select("review_id", "review_score", analytics.sentiment().alias("sentiment"))


@prim("case_delivery_status", """
SELECT order_id, CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 'Late'
       WHEN order_delivered_customer_date IS NOT NULL THEN 'On Time' ELSE 'Not Delivered' END AS delivery_status
FROM fact_order""", "fact_order")
def case_delivery_status(t):
    d, e = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return t["fact_order"].select(
        "order_id", F.when(d > e, "Late").when(d.isNotNull(), "On Time").otherwise("Not Delivered").alias("delivery_status"))


@prim("coalesce_chain", """
SELECT p.product_id, COALESCE(c.product_category_name_english, p.product_category_name, 'Unknown') AS category_gold,
       COALESCE(c.product_category_name_english, 'unknown') AS category_silver
FROM dim_product p LEFT JOIN dim_product_category c ON p.product_category_name = c.product_category_name""",
      "dim_product", "dim_product_category")
def coalesce_chain(t):
    j = t["dim_product"].join(t["dim_product_category"], "product_category_name", "left")
    return j.select("product_id",
                    F.coalesce("product_category_name_english", "product_category_name", F.lit("Unknown"))
                    .alias("category_gold"),
                    F.coalesce("product_category_name_english", F.lit("unknown")).alias("category_silver"))


@prim("drop_null_rows", """
SELECT review_id, review_comment_title, review_comment_message FROM fact_order_review
WHERE review_comment_title IS NOT NULL AND review_comment_message IS NOT NULL""", "fact_order_review")
def drop_null_rows(t):
    return (t["fact_order_review"].select("review_id", "review_comment_title", "review_comment_message")
            .dropna(subset=["review_comment_title", "review_comment_message"]))


@prim("subquery_cte", f"""
WITH valid AS (SELECT order_id, customer_id FROM fact_order WHERE {VALID}),
per_customer AS (SELECT customer_id, COUNT(*) AS n_orders FROM valid GROUP BY customer_id),
repeat_buyers AS (SELECT customer_id, n_orders FROM per_customer WHERE n_orders >= 2)
SELECT c.customer_id, c.customer_city, r.n_orders FROM dim_customer c JOIN repeat_buyers r ON c.customer_id = r.customer_id""",
      "fact_order", "dim_customer")
def subquery_cte(t):
    valid = marts.valid_orders(t).select("order_id", "customer_id")
    per_customer = valid.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"))
    repeat_buyers = per_customer.where(F.col("n_orders") >= 2)
    return t["dim_customer"].join(repeat_buyers, "customer_id").select("customer_id", "customer_city", "n_orders")


# ====================================================================== 2.4 joins
@prim("join_left", """
SELECT o.order_id, o.order_status, oi.order_item_id, oi.price
FROM fact_order o LEFT JOIN fact_order_item oi ON o.order_id = oi.order_id""", "fact_order", "fact_order_item")
def join_left(t):
    o = t["fact_order"].select("order_id", "order_status")
    i = t["fact_order_item"].select("order_id", "order_item_id", "price")
    return left_join_many(o, i, ["order_id"]).select("order_id", "order_status", "order_item_id", "price")


@prim("join_left_using", """
SELECT * FROM (SELECT order_id, order_status FROM fact_order) o
LEFT JOIN (SELECT order_id, order_item_id, price FROM fact_order_item) oi USING (order_id)""",
      "fact_order", "fact_order_item")
def join_left_using(t):
    o = t["fact_order"].select("order_id", "order_status")
    return left_join_many(o, t["fact_order_item"].select("order_id", "order_item_id", "price"), ["order_id"])


@prim("join_left_on_residual", f"""
SELECT oi.order_id, oi.order_item_id, o.order_status
FROM fact_order_item oi LEFT JOIN fact_order o ON oi.order_id = o.order_id AND o.{VALID}""",
      "fact_order_item", "fact_order")
def join_left_on_residual(t):
    valid = marts.valid_orders(t).select("order_id", "order_status")
    return t["fact_order_item"].select("order_id", "order_item_id").join(valid, "order_id", "left")


@prim("join_inner", """
SELECT r.review_id, r.order_id, r.review_score, oi.order_item_id, oi.seller_id
FROM fact_order_review r JOIN fact_order_item oi ON r.order_id = oi.order_id""",
      "fact_order_review", "fact_order_item")
def join_inner(t):
    return (t["fact_order_review"].select("review_id", "order_id", "review_score")
            .join(t["fact_order_item"].select("order_id", "order_item_id", "seller_id"), "order_id", "inner")
            .select("review_id", "order_id", "review_score", "order_item_id", "seller_id"))


@prim("join_inner_keylist", """
SELECT p.order_id, p.payment_sequential, p.payment_value FROM fact_order_payment p
JOIN (SELECT order_id FROM fact_order WHERE order_status IS NULL OR order_status NOT IN ('canceled', 'unavailable')) v
  ON p.order_id = v.order_id""", "fact_order_payment", "fact_order")
def join_inner_keylist(t):
    ids = t["fact_order"].where(X.not_canceled_keep_null()).select("order_id")
    # Semi join: the id list is unique (checked by dq_unique), so this equals the inner join.
    return (t["fact_order_payment"].join(ids, "order_id", "left_semi")
            .select("order_id", "payment_sequential", "payment_value"))


@prim("join_left_merge", """
SELECT o.order_id, o.order_status, oi.order_item_id FROM fact_order o
LEFT JOIN fact_order_item oi ON o.order_id = oi.order_id
WHERE o.order_status IS NULL OR o.order_status NOT IN ('canceled', 'unavailable')""", "fact_order", "fact_order_item")
def join_left_merge(t):
    o = t["fact_order"].where(X.not_canceled_keep_null()).select("order_id", "order_status")
    return left_join_many(o, t["fact_order_item"].select("order_id", "order_item_id"), ["order_id"])


@prim("join_full_outer", """
WITH jo AS (SELECT CAST(order_purchase_timestamp AS DATE) AS d, COUNT(*) AS orders FROM fact_order GROUP BY 1),
jr AS (SELECT CAST(review_creation_date AS DATE) AS d, COUNT(*) AS reviews FROM fact_order_review GROUP BY 1)
SELECT COALESCE(jo.d, jr.d) AS date, jo.orders, jr.reviews FROM jo FULL OUTER JOIN jr ON jo.d = jr.d""",
      "fact_order", "fact_order_review")
def join_full_outer(t):
    a = t["fact_order"].groupBy(F.to_date("order_purchase_timestamp").alias("d")).agg(F.count(F.lit(1)).alias("orders"))
    b = t["fact_order_review"].groupBy(F.to_date("review_creation_date").alias("d")).agg(F.count(F.lit(1)).alias("reviews"))
    return a.join(b, a["d"] == b["d"], "full").select(F.coalesce(a["d"], b["d"]).alias("date"), "orders", "reviews")


@prim("join_star_multiway", """
SELECT oi.order_id, oi.order_item_id, COALESCE(pc.product_category_name_english, p.product_category_name, 'Unknown') AS category,
       s.seller_state, o.order_status, c.customer_state
FROM fact_order_item oi
LEFT JOIN dim_product p ON oi.product_id = p.product_id
LEFT JOIN dim_product_category pc ON p.product_category_name = pc.product_category_name
LEFT JOIN dim_seller s ON oi.seller_id = s.seller_id
LEFT JOIN fact_order o ON oi.order_id = o.order_id
LEFT JOIN dim_customer c ON o.customer_id = c.customer_id""",
      "fact_order_item", "dim_product", "dim_product_category", "dim_seller", "fact_order", "dim_customer")
def join_star_multiway(t):
    prod = (t["dim_product"].join(t["dim_product_category"], "product_category_name", "left")
            .select("product_id", F.coalesce("product_category_name_english", "product_category_name",
                                             F.lit("Unknown")).alias("category")))
    orders = (t["fact_order"].select("order_id", "customer_id", "order_status")
              .join(t["dim_customer"].select("customer_id", "customer_state"), "customer_id", "left"))
    return (t["fact_order_item"].select("order_id", "order_item_id", "product_id", "seller_id")
            .join(prod, "product_id", "left")
            .join(t["dim_seller"].select("seller_id", "seller_state"), "seller_id", "left")
            .join(orders, "order_id", "left")
            .select("order_id", "order_item_id", "category", "seller_state", "order_status", "customer_state"))


@prim("join_fanout", f"""
SELECT o.order_id, {R2('SUM(oi.price)')} AS fanout_revenue, COUNT(*) AS joined_rows
FROM fact_order o LEFT JOIN fact_order_item oi ON o.order_id = oi.order_id
LEFT JOIN fact_order_review r ON o.order_id = r.order_id
WHERE o.{VALID} GROUP BY o.order_id""", "fact_order", "fact_order_item", "fact_order_review")
def join_fanout(t):
    o = marts.valid_orders(t).select("order_id")
    it = marts.item_stats_per_order(t["fact_order_item"])
    rv = marts.review_stats_per_order(t["fact_order_review"])
    ir = F.greatest(F.coalesce("it_rows", F.lit(0)), F.lit(1))
    rr = F.greatest(F.coalesce("rv_rows", F.lit(0)), F.lit(1))
    return (o.join(it, "order_id", "left").join(rv, "order_id", "left")
            .select("order_id", X.round2(F.col("it_price") * rr).alias("fanout_revenue"), (ir * rr).alias("joined_rows")))


@prim("join_preaggregated", """
WITH p AS (SELECT order_id, SUM(payment_value) AS total_payment FROM fact_order_payment GROUP BY order_id),
r AS (SELECT order_id, AVG(review_score) AS avg_review_score FROM fact_order_review GROUP BY order_id)
SELECT o.order_id, p.total_payment, r.avg_review_score
FROM fact_order o LEFT JOIN p ON o.order_id = p.order_id LEFT JOIN r ON o.order_id = r.order_id""",
      "fact_order", "fact_order_payment", "fact_order_review")
def join_preaggregated(t):
    p = t["fact_order_payment"].groupBy("order_id").agg(F.sum("payment_value").alias("total_payment"))
    r = t["fact_order_review"].groupBy("order_id").agg(F.avg("review_score").alias("avg_review_score"))
    return t["fact_order"].select("order_id").join(p, "order_id", "left").join(r, "order_id", "left")


@prim("scalar_subquery", """
SELECT order_id, payment_sequential, payment_value FROM fact_order_payment
WHERE payment_value > (SELECT AVG(payment_value) FROM fact_order_payment)""", "fact_order_payment")
def scalar_subquery(t):
    p = t["fact_order_payment"]
    avg = p.agg(F.avg("payment_value")).scalar()
    return p.where(F.col("payment_value") > avg).select("order_id", "payment_sequential", "payment_value")


# ====================================================================== 2.5 aggregations
@prim("agg_count_distinct", """
SELECT order_status, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT CAST(order_purchase_timestamp AS DATE)) AS days
FROM fact_order GROUP BY order_status""", "fact_order")
def agg_count_distinct(t):
    return t["fact_order"].groupBy("order_status").agg(
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct(F.to_date("order_purchase_timestamp")).alias("days"))


@prim("agg_count", """
SELECT review_score, COUNT(*) AS n_rows, COUNT(review_comment_title) AS n_titles, COUNT(review_comment_message) AS n_messages
FROM fact_order_review GROUP BY review_score""", "fact_order_review")
def agg_count(t):
    return t["fact_order_review"].groupBy("review_score").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("review_comment_title").alias("n_titles"),
        F.count("review_comment_message").alias("n_messages"))


@prim("agg_sum_round", f"SELECT seller_id, {R2('SUM(price)')} AS revenue FROM fact_order_item GROUP BY seller_id",
      "fact_order_item")
def agg_sum_round(t):
    return t["fact_order_item"].groupBy("seller_id").agg(X.round2(F.sum("price")).alias("revenue"))


@prim("agg_avg_round", f"SELECT seller_id, {R2('AVG(price)')} AS avg_price FROM fact_order_item GROUP BY seller_id",
      "fact_order_item")
def agg_avg_round(t):
    return t["fact_order_item"].groupBy("seller_id").agg(X.round2(F.avg("price")).alias("avg_price"))


@prim("agg_min_max", """
SELECT seller_id, MIN(price) AS min_price, MAX(price) AS max_price, MIN(shipping_limit_date) AS first_ship,
       MAX(shipping_limit_date) AS last_ship FROM fact_order_item GROUP BY seller_id""", "fact_order_item")
def agg_min_max(t):
    return t["fact_order_item"].groupBy("seller_id").agg(
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.min("shipping_limit_date").alias("first_ship"), F.max("shipping_limit_date").alias("last_ship"))


@prim("agg_count_distinct_if", """
SELECT customer_id, COUNT(DISTINCT order_id) FILTER (WHERE is_delivered) AS delivered_orders,
       COUNT(DISTINCT order_id) FILTER (WHERE is_canceled) AS canceled_orders
FROM silver_fact_orders GROUP BY customer_id""", "silver_fact_orders")
def agg_count_distinct_if(t):
    return SilverTables(t)["silver_fact_orders"].groupBy("customer_id").agg(
        F.countDistinct(F.when(F.col("is_delivered"), F.col("order_id"))).alias("delivered_orders"),
        F.countDistinct(F.when(F.col("is_canceled"), F.col("order_id"))).alias("canceled_orders"))


@prim("agg_array_distinct", """
SELECT order_id, array_to_string(list_sort(list_distinct(list(payment_type))), ',') AS payment_types
FROM fact_order_payment GROUP BY order_id""", "fact_order_payment")
def agg_array_distinct(t):
    # The array is rendered as a ','-joined string so both engines compare the same text.
    return t["fact_order_payment"].groupBy("order_id").agg(
        F.array_join(F.sort_array(F.collect_set("payment_type")), ",").alias("payment_types"))


@prim("agg_string_distinct", """
SELECT order_id, STRING_AGG(DISTINCT payment_type, ', ' ORDER BY payment_type) AS payment_types
FROM fact_order_payment GROUP BY order_id""", "fact_order_payment")
def agg_string_distinct(t):
    return t["fact_order_payment"].groupBy("order_id").agg(
        F.array_join(F.sort_array(F.collect_set("payment_type")), ", ").alias("payment_types"))


@prim("agg_group_by_expr", """
SELECT CAST(order_purchase_timestamp AS DATE) AS order_date, COALESCE(order_status, 'unknown') AS status, COUNT(*) AS n
FROM fact_order GROUP BY 1, 2""", "fact_order")
def agg_group_by_expr(t):
    return t["fact_order"].groupBy(
        F.to_date("order_purchase_timestamp").alias("order_date"),
        F.coalesce("order_status", F.lit("unknown")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@prim("agg_global", f"""
SELECT COUNT(*) AS n_items, COUNT(DISTINCT order_id) AS n_orders, {R2('SUM(price)')} AS revenue,
       {R2('AVG(freight_value)')} AS avg_freight FROM fact_order_item""", "fact_order_item")
def agg_global(t):
    return t["fact_order_item"].agg(
        F.count(F.lit(1)).alias("n_items"), F.countDistinct("order_id").alias("n_orders"),
        X.round2(F.sum("price")).alias("revenue"), X.round2(F.avg("freight_value")).alias("avg_freight"))


@prim("agg_sum_expr", f"""
SELECT order_id, {R2('SUM(price + freight_value)')} AS total_order_value FROM silver_fact_order_items GROUP BY order_id""",
      "silver_fact_order_items")
def agg_sum_expr(t):
    return SilverTables(t)["silver_fact_order_items"].groupBy("order_id").agg(
        X.round2(F.sum(F.col("price") + F.col("freight_value"))).alias("total_order_value"))


@prim("agg_median", """
SELECT (SELECT MEDIAN(price) FROM fact_order_item) AS median_price,
       (SELECT MEDIAN(payment_value) FROM fact_order_payment) AS median_payment""",
      "fact_order_item", "fact_order_payment")
def agg_median(t):
    a = exact_median(t["fact_order_item"], "price").withColumnRenamed("median", "median_price")
    b = exact_median(t["fact_order_payment"], "payment_value").withColumnRenamed("median", "median_payment")
    return a.select("median_price", b.scalar().alias("median_payment"))


@prim("agg_named_groupby", """
SELECT o.order_status, COUNT(DISTINCT o.order_id) AS total_orders, COUNT(oi.order_item_id) AS total_items,
       CAST(COALESCE(SUM(CAST(oi.price AS DECIMAL(38,10))), 0) AS DOUBLE) AS total_revenue
FROM fact_order o LEFT JOIN fact_order_item oi ON o.order_id = oi.order_id
WHERE o.order_status IS NOT NULL GROUP BY o.order_status""", "fact_order", "fact_order_item")
def agg_named_groupby(t):
    # Money is accumulated exactly (DECIMAL), so the per-order pre-aggregation cannot change
    # the last digits of the total.
    it = t["fact_order_item"].groupBy("order_id").agg(
        F.count("order_item_id").alias("it_n"), F.sum(F.col("price").cast("decimal(38,10)")).alias("it_price"))
    o = t["fact_order"].where(F.col("order_status").isNotNull()).select("order_id", "order_status")
    return (o.join(it, "order_id", "left").groupBy("order_status").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.coalesce(F.sum("it_n"), F.lit(0)).alias("total_items"),
        F.coalesce(F.sum("it_price"), F.lit(0)).cast("double").alias("total_revenue")))


@prim("agg_sum_line_numbers", """
SELECT product_id, CAST(SUM(order_item_id) AS BIGINT) AS units_sold FROM fact_order_item GROUP BY product_id""", "fact_order_item")
def agg_sum_line_numbers(t):
    return t["fact_order_item"].groupBy("product_id").agg(F.sum("order_item_id").alias("units_sold"))


@prim("agg_scale_then_reduce", """
SELECT COUNT(x) AS count, CAST(SUM(x) AS BIGINT) AS total FROM (SELECT order_item_id * 3 AS x FROM fact_order_item)""",
      "fact_order_item")
def agg_scale_then_reduce(t, multiplier: int = 3):
    x = t["fact_order_item"].select((F.col("order_item_id") * multiplier).alias("x"))
    return x.agg(F.count("x").alias("count"), F.sum("x").alias("total"))


# ====================================================================== 2.6 windows
@prim("win_share_of_total", f"""
SELECT seller_id, total_revenue, {R2('100.0 * total_revenue / SUM(total_revenue) OVER ()')} AS revenue_share_pct
FROM gold_seller_performance""", "gold_seller_performance")
def win_share_of_total(t):
    # Seller grain grows with the data: materialise the mart once (reliable checkpoint), then
    # the total is a scalar subquery over the stored rows instead of a second mart run.
    s = materialize(marts.gold_seller_performance(t))
    total = s.agg(F.sum("total_revenue")).scalar()
    return s.select("seller_id", "total_revenue", X.pct("total_revenue", total).alias("revenue_share_pct"))


@prim("win_share_of_count", f"""
SELECT order_status, COUNT(*) AS n, {R2('100.0 * CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER ()')} AS pct
FROM fact_order GROUP BY order_status""", "fact_order")
def win_share_of_count(t):
    return t["fact_order"].groupBy("order_status").agg(F.count(F.lit(1)).alias("n")).select(
        "order_status", "n", X.share_of_group_total("n").alias("pct"))


@prim("win_dense_rank", """
SELECT * FROM (SELECT seller_state, seller_id, total_revenue,
       DENSE_RANK() OVER (PARTITION BY seller_state ORDER BY total_revenue DESC NULLS FIRST) AS rnk
       FROM gold_seller_performance) WHERE rnk <= 3""", "gold_seller_performance")
def win_dense_rank(t):
    s = marts.gold_seller_performance(t).select("seller_state", "seller_id", "total_revenue")
    return top_distinct_ranked(s, ["seller_state"], "total_revenue", 3, "rnk")


@prim("win_row_number", """
SELECT customer_id, total_revenue,
       ROW_NUMBER() OVER (ORDER BY total_revenue DESC NULLS FIRST, customer_id) AS revenue_rank
FROM gold_customer_ltv""", "gold_customer_ltv")
def win_row_number(t):
    ltv = marts.gold_customer_ltv(t).select("customer_id", "total_revenue")
    return global_row_number(ltv, [F.col("total_revenue").desc_nulls_first(), F.col("customer_id").asc()],
                             "revenue_rank")


@prim("win_running_total", """
SELECT order_date, total_orders, CAST(SUM(total_orders) OVER (ORDER BY order_date) AS BIGINT) AS cumulative_orders
FROM gold_daily_sales_summary""", "gold_daily_sales_summary")
def win_running_total(t):
    d = marts.gold_daily_sales_summary(t)
    return d.select("order_date", "total_orders",
                    F.sum("total_orders").over(Window.orderBy("order_date")).alias("cumulative_orders"))


@prim("win_moving_avg", """
SELECT order_date, total_orders,
       AVG(total_orders) OVER (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS orders_ma_7
FROM gold_daily_sales_summary""", "gold_daily_sales_summary")
def win_moving_avg(t):
    d = marts.gold_daily_sales_summary(t)
    return d.select("order_date", "total_orders",
                    F.avg("total_orders").over(Window.orderBy("order_date").rowsBetween(-6, 0)).alias("orders_ma_7"))


@prim("win_lag_change", f"""
SELECT order_date, total_orders,
       {R2('(total_orders - LAG(total_orders) OVER (ORDER BY order_date)) / NULLIF(LAG(total_orders) OVER (ORDER BY order_date), 0) * 100')} AS change_pct
FROM gold_daily_sales_summary""", "gold_daily_sales_summary")
def win_lag_change(t):
    d = marts.gold_daily_sales_summary(t)
    w = Window.orderBy("order_date")
    prev = F.lag("total_orders").over(w)
    return d.select("order_date", "total_orders",
                    X.round2(F.try_divide((F.col("total_orders") - prev).cast("double"),
                                          F.nullif(prev, F.lit(0)).cast("double")) * 100).alias("change_pct"))


@prim("win_rank_lead", """
SELECT seller_state, seller_id, total_revenue,
       RANK() OVER (PARTITION BY seller_state ORDER BY total_revenue DESC NULLS FIRST) AS rnk,
       LEAD(total_revenue) OVER (PARTITION BY seller_state ORDER BY total_revenue DESC NULLS FIRST, seller_id) AS next_revenue
FROM gold_seller_performance""", "gold_seller_performance")
def win_rank_lead(t):
    s = marts.gold_seller_performance(t).select("seller_state", "seller_id", "total_revenue")
    return ranked(s, ["seller_state"], [F.col("total_revenue").desc_nulls_first(), F.col("seller_id")],
                  ["total_revenue"], rank="rnk", lead=("total_revenue", "next_revenue"))


# ====================================================================== 2.7 sorts / limits
@prim("sort_result", "SELECT * FROM gold_review_analysis ORDER BY review_score DESC NULLS FIRST", "gold_review_analysis")
def sort_result(t):
    return marts.gold_review_analysis(t).orderBy(F.col("review_score").desc_nulls_first())


@prim("sort_by_aggregate", f"""
SELECT order_status, COUNT(*) AS n_items FROM fact_order o JOIN fact_order_item oi ON o.order_id = oi.order_id
GROUP BY order_status ORDER BY SUM(oi.price) DESC NULLS FIRST""", "fact_order", "fact_order_item")
def sort_by_aggregate(t):
    j = t["fact_order"].select("order_id", "order_status").join(
        t["fact_order_item"].select("order_id", "price"), "order_id")
    return (j.groupBy("order_status").agg(F.count(F.lit(1)).alias("n_items"), F.sum("price").alias("_rev"))
            .orderBy(F.col("_rev").desc_nulls_first()).drop("_rev"))


@prim("top_k", """
SELECT customer_id, total_revenue FROM gold_dim_customers ORDER BY total_revenue DESC, customer_id LIMIT 10""",
      "gold_dim_customers")
def top_k(t):
    from terrace.plans.star import gold_dim_customers
    return (gold_dim_customers(SilverTables(t)).select("customer_id", "total_revenue")
            .orderBy(F.col("total_revenue").desc(), "customer_id").limit(10))


@prim("head_n", "SELECT product_id, product_category_name FROM dim_product ORDER BY product_id LIMIT 3", "dim_product")
def head_n(t, n: int = 3):
    return t["dim_product"].select("product_id", "product_category_name").orderBy("product_id").limit(n)


# ====================================================================== 2.8 scalar functions
@prim("fn_upper", "SELECT customer_id, upper(customer_unique_id) AS name_upper FROM dim_customer", "dim_customer")
def fn_upper(t):
    return t["dim_customer"].select("customer_id", F.upper("customer_unique_id").alias("name_upper"))


@prim("fn_trim_initcap", f"SELECT customer_id, trim({INITCAP('customer_city')}) AS city FROM dim_customer",
      "dim_customer")
def fn_trim_initcap(t):
    return t["dim_customer"].select("customer_id", F.trim(X.initcap_words("customer_city")).alias("city"))


@prim("fn_upper_trim", "SELECT customer_id, upper(trim(customer_state)) AS state FROM dim_customer", "dim_customer")
def fn_upper_trim(t):
    return t["dim_customer"].select("customer_id", F.upper(F.trim("customer_state")).alias("state"))


@prim("fn_to_date", "SELECT order_id, CAST(order_purchase_timestamp AS DATE) AS order_date FROM fact_order", "fact_order")
def fn_to_date(t):
    return t["fact_order"].select("order_id", F.to_date("order_purchase_timestamp").alias("order_date"))


@prim("fn_hours_between", """
SELECT order_id, date_diff('microsecond', order_purchase_timestamp, order_delivered_customer_date) / 3.6e9 AS hours
FROM fact_order""", "fact_order")
def fn_hours_between(t):
    return t["fact_order"].select(
        "order_id", X.hours_between("order_delivered_customer_date", "order_purchase_timestamp").alias("hours"))


@prim("fn_hours_between_sec", """
SELECT order_id, date_diff('second', order_purchase_timestamp, order_approved_at) / 3600.0 AS hours FROM fact_order""",
      "fact_order")
def fn_hours_between_sec(t):
    return t["fact_order"].select(
        "order_id", X.hours_between_seconds("order_approved_at", "order_purchase_timestamp").alias("hours"))


@prim("fn_elapsed_days", """
SELECT order_id, date_sub('day', order_purchase_timestamp, order_delivered_customer_date) AS days FROM fact_order""",
      "fact_order")
def fn_elapsed_days(t):
    return t["fact_order"].select(
        "order_id", X.elapsed_days("order_purchase_timestamp", "order_delivered_customer_date").alias("days"))


@prim("fn_boundary_days", """
SELECT order_id, COALESCE(date_diff('day', order_purchase_timestamp, order_delivered_customer_date), 0) AS days
FROM fact_order""", "fact_order")
def fn_boundary_days(t):
    return t["fact_order"].select(
        "order_id", F.coalesce(X.boundary_days("order_purchase_timestamp", "order_delivered_customer_date"),
                               F.lit(0)).cast("bigint").alias("days"))


@prim("fn_date_minus_interval", """
SELECT MAX(CAST(order_purchase_timestamp AS DATE)) AS last_date,
       CAST(MAX(CAST(order_purchase_timestamp AS DATE)) - INTERVAL 7 DAY AS DATE) AS window_start FROM fact_order""",
      "fact_order")
def fn_date_minus_interval(t, days: int = 7):
    d = F.max(F.to_date("order_purchase_timestamp"))
    return t["fact_order"].agg(d.alias("last_date"), F.date_sub(d, days).alias("window_start"))


@prim("fn_safe_ratio", f"""
SELECT order_id, payment_sequential, {R2('payment_value / NULLIF(payment_installments, 0)')} AS per_installment
FROM fact_order_payment""", "fact_order_payment")
def fn_safe_ratio(t):
    return t["fact_order_payment"].select(
        "order_id", "payment_sequential",
        X.round2(X.safe_ratio("payment_value", "payment_installments")).alias("per_installment"))


@prim("fn_integer_ratio", """
SELECT order_date, total_items_sold // NULLIF(total_orders, 0) AS items_per_order FROM gold_daily_sales_summary""",
      "gold_daily_sales_summary")
def fn_integer_ratio(t):
    return marts.gold_daily_sales_summary(t).select(
        "order_date", X.integer_ratio("total_items_sold", "total_orders").alias("items_per_order"))


@prim("fn_guarded_ratio", f"""
SELECT customer_id, CASE WHEN total_orders > 0 THEN {R2('delivered_orders / total_orders')} ELSE 0 END AS delivery_rate
FROM (SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders,
             COUNT(DISTINCT order_id) FILTER (WHERE is_delivered) AS delivered_orders
      FROM silver_fact_orders GROUP BY customer_id)""", "silver_fact_orders")
def fn_guarded_ratio(t):
    g = SilverTables(t)["silver_fact_orders"].groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.countDistinct(F.when(F.col("is_delivered"), F.col("order_id"))).alias("delivered_orders"))
    tot = F.col("total_orders")
    return g.select("customer_id", F.when(tot > 0, X.round2(F.col("delivered_orders") / tot))
                    .otherwise(F.lit(0.0)).alias("delivery_rate"))


@prim("fn_volume", """
SELECT product_id, product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3 FROM dim_product""",
      "dim_product")
def fn_volume(t):
    return t["dim_product"].select(
        "product_id", (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"))
        .alias("product_volume_cm3"))


@prim("fn_to_string_keep_null", """
SELECT review_id, CAST(review_id AS VARCHAR) AS review_id_text, CAST(review_score AS VARCHAR) AS score_text,
       strftime(review_creation_date, '%Y-%m-%d %H:%M:%S') AS created_text FROM fact_order_review""", "fact_order_review")
def fn_to_string_keep_null(t):
    return t["fact_order_review"].select(
        "review_id", F.col("review_id").cast("string").alias("review_id_text"),
        F.col("review_score").cast("string").alias("score_text"),
        X.wall_clock_text("review_creation_date").alias("created_text"))


@prim("fn_format_amount", """
SELECT order_id, payment_sequential, format('{:,.2f}', payment_value) AS amount_text FROM fact_order_payment""",
      "fact_order_payment")
def fn_format_amount(t):
    return t["fact_order_payment"].select("order_id", "payment_sequential",
                                          X.format_amount("payment_value").alias("amount_text"))


@prim("fn_char_length", """
SELECT product_id, product_category_name, length(product_category_name) AS name_length FROM dim_product
WHERE length(product_category_name) > 6""", "dim_product")
def fn_char_length(t, min_len: int = 6):
    n = F.char_length("product_category_name").cast("bigint")
    return (t["dim_product"].select("product_id", "product_category_name", n.alias("name_length"))
            .where(F.col("name_length") > min_len))


@prim("fn_profit_margin", f"""
SELECT order_id, order_item_id, CASE WHEN price > 0 THEN {R2('(price - freight_value) / price')} ELSE 0 END AS profit_margin
FROM silver_fact_order_items""", "silver_fact_order_items")
def fn_profit_margin(t):
    p = F.col("price")
    return SilverTables(t)["silver_fact_order_items"].select(
        "order_id", "order_item_id",
        F.when(p > 0, X.round2((p - F.col("freight_value")) / p)).otherwise(F.lit(0.0)).alias("profit_margin"))


@prim("fn_trunc_month", """
SELECT date_trunc('month', order_purchase_timestamp) AS month, COUNT(*) AS orders FROM fact_order GROUP BY 1""",
      "fact_order")
def fn_trunc_month(t):
    return (t["fact_order"].groupBy(X.month_start("order_purchase_timestamp").alias("month"))
            .agg(F.count(F.lit(1)).alias("orders")))


@prim("fn_titlecase", f"SELECT seller_id, trim({INITCAP('seller_city')}) AS city FROM dim_seller", "dim_seller")
def fn_titlecase(t):
    return t["dim_seller"].select("seller_id", F.trim(X.initcap_words("seller_city")).alias("city"))


@prim("fn_parse_timestamp", """
SELECT order_id, strptime(strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M') AS parsed
FROM fact_order""", "fact_order")
def fn_parse_timestamp(t):
    text = X.wall_clock_text("order_purchase_timestamp", minutes_only=True)
    return t["fact_order"].select("order_id", F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm")).alias("parsed"))


@prim("fn_epoch_to_local", """
SELECT order_id, epoch(order_purchase_timestamp) AS epoch_s,
       CAST(timezone('Asia/Bangkok', to_timestamp(epoch(order_purchase_timestamp))) AS TIMESTAMP) AS local_time
FROM fact_order""", "fact_order")
def fn_epoch_to_local(t, zone: str = "Asia/Bangkok"):
    epoch = X.epoch_seconds("order_purchase_timestamp")
    return t["fact_order"].select("order_id", epoch.cast("double").alias("epoch_s"),
                                  X.epoch_to_local(epoch, zone).alias("local_time"))
