"""Star schema over the silver layer: three dimensions and the order fact.

Every input is reduced to order grain first (payments, reviews, items), so the fact is a
chain of 1:1 joins on ``order_id``; the dimensions aggregate those order rows once more.
Unmatched rows follow the column-store's default-value rule for non-nullable results
(revenue and review average become 0, the payment type list becomes empty); timestamps
stay NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from terrace.functions.aggregates import distinct_counts, join_on_keys, small_group_counts_and_sums
from terrace.functions.exprs import boundary_days, round2

Silver = Mapping[str, DataFrame]


def payments_per_order(s: Silver, as_text: bool = False) -> DataFrame:
    """Per order: payment total, number of distinct methods and the sorted method list. The
    per-order set is bounded by the small payment-type domain, so its size doubles as the
    distinct count (no separate distinct aggregation)."""
    agg = s["silver_fact_payments"].groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment"),
        F.sort_array(F.collect_set("payment_type")).alias("_types"))
    types = F.col("_types")
    return agg.select("order_id", "total_payment", F.size(types).cast("bigint").alias("payment_method_count"),
                      (F.array_join(types, ", ") if as_text else types).alias("payment_types"))


def reviews_per_order(s: Silver) -> DataFrame:
    return s["silver_fact_reviews"].groupBy("order_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count("review_id").alias("review_count"))


def items_per_order(s: Silver) -> DataFrame:
    """Item aggregates per order, from one shuffle of the items."""
    return small_group_counts_and_sums(
        s["silver_fact_order_items"], ["order_id"],
        {"item_count": "order_item_id", "unique_products": "product_id", "unique_sellers": "seller_id"},
        {"total_price": "price", "total_freight": "freight_value", "total_order_value": F.col("price") + F.col("freight_value")})


def orders_by_customer(s: Silver) -> DataFrame:
    """One row per (order, customer): order rows, status flags and first and last purchase. The
    rows are shuffled by ``order_id`` alone, so joins of order-grain tables need no second
    exchange of the orders, and an order that occurs twice still counts as one."""
    return (s["silver_fact_orders"].select("order_id", "customer_id", "is_delivered", "is_canceled", "order_purchase_timestamp")
            .repartition("order_id").groupBy("order_id", "customer_id").agg(
                F.count(F.lit(1)).alias("n_rows"), F.max("is_delivered").alias("is_delivered"),
                F.max("is_canceled").alias("is_canceled"), F.min("order_purchase_timestamp").alias("first_ts"),
                F.max("order_purchase_timestamp").alias("last_ts")))


# ---------------------------------------------------------------- D1
def gold_dim_customers(s: Silver) -> DataFrame:
    pay = payments_per_order(s).select("order_id", "total_payment")
    rev = reviews_per_order(s).select("order_id", "avg_review_score")
    n, order = F.col("n_rows"), F.col("order_id")
    per_customer = (orders_by_customer(s).join(pay, "order_id", "left").join(rev, "order_id", "left")
                    .groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count(F.when(F.col("is_delivered"), order)).alias("delivered_orders"),
        F.count(F.when(F.col("is_canceled"), order)).alias("canceled_orders"),
        F.sum(F.coalesce("total_payment", F.lit(0.0)) * n).alias("total_revenue"),
        (F.sum(F.coalesce("avg_review_score", F.lit(0.0)) * n) / F.sum(n)).alias("avg_review_score"),
        F.min("first_ts").alias("first_order_date"), F.max("last_ts").alias("last_order_date")))
    c = s["silver_dim_customers"].join(per_customer, "customer_id", "left")
    total = F.coalesce("total_orders", F.lit(0))
    first, last = F.col("first_order_date"), F.col("last_order_date")
    return c.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state",
        total.alias("total_orders"),
        F.coalesce("delivered_orders", F.lit(0)).alias("delivered_orders"),
        F.coalesce("canceled_orders", F.lit(0)).alias("canceled_orders"),
        F.when(total > 0, round2(F.col("delivered_orders") / total)).otherwise(F.lit(0.0)).alias("delivery_rate"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        F.coalesce("avg_review_score", F.lit(0.0)).alias("avg_review_score"),
        "first_order_date", "last_order_date",
        F.when(first.isNotNull() & last.isNotNull(), boundary_days(first, last)).otherwise(F.lit(0))
        .cast("bigint").alias("customer_tenure_days"))


# ---------------------------------------------------------------- D2
def gold_dim_products(s: Silver) -> DataFrame:
    per_product = small_group_counts_and_sums(s["silver_fact_order_items"], ["product_id"], {"n_orders": "order_id", "n_sellers": "seller_id"},
                                              {"revenue": "price", "freight": "freight_value"})
    return (s["silver_dim_products"].join(per_product, "product_id", "left")
            .select("product_id", "product_category_name", "product_category_english", "product_weight_g",
                    "product_length_cm", "product_height_cm", "product_width_cm",
                    F.coalesce("n_orders", F.lit(0)).alias("total_orders"),
                    F.coalesce("revenue", F.lit(0.0)).alias("total_revenue"),
                    F.coalesce("freight", F.lit(0.0)).alias("total_freight"),
                    F.coalesce("n_sellers", F.lit(0)).alias("total_sellers")))


# ---------------------------------------------------------------- D3
def gold_dim_sellers(s: Silver) -> DataFrame:
    """Per seller. The review average is item-weighted: the SQL joins reviews to items on
    ``order_id``, so each review counts once per item the seller has in that order. Items are
    reduced to one row per (seller, order), which gives the order count and the sums as well,
    and reviews to order sums before that join."""
    items = s["silver_fact_order_items"]
    seller_orders = items.groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("price").alias("p"), F.sum("freight_value").alias("f"))
    rv = s["silver_fact_reviews"].groupBy("order_id").agg(
        F.sum("review_score").alias("rv_sum"), F.count("review_score").alias("rv_cnt"),
        F.count("review_id").alias("rv_ids"))
    n = F.col("n_items")
    sums = seller_orders.join(rv, "order_id", "left").groupBy("seller_id").agg(
        F.count("order_id").alias("n_orders"), F.sum("p").alias("revenue"), F.sum("f").alias("freight"),
        round2(F.try_divide(F.sum(F.col("rv_sum") * n).cast("double"), F.sum(F.col("rv_cnt") * n).cast("double")))
        .alias("avg_review"),
        F.sum(F.col("rv_ids") * n).alias("n_reviews"))
    per_seller = join_on_keys(sums, distinct_counts(items, ["seller_id"], {"n_products": "product_id"}), ["seller_id"])
    return (s["silver_dim_sellers"].join(per_seller, "seller_id", "left")
            .select("seller_id", "seller_city", "seller_state",
                    F.coalesce("n_orders", F.lit(0)).alias("total_orders"),
                    F.coalesce("revenue", F.lit(0.0)).alias("total_revenue"),
                    F.coalesce("freight", F.lit(0.0)).alias("total_freight"),
                    F.coalesce("n_products", F.lit(0)).alias("unique_products"),
                    F.coalesce("avg_review", F.lit(0.0)).alias("avg_customer_review"),
                    F.coalesce("n_reviews", F.lit(0)).alias("total_reviews")))


# ---------------------------------------------------------------- D4 / D5 / D6
def _order_details(s: Silver, types_as_text: bool) -> DataFrame:
    o = s["silver_fact_orders"].select(
        "order_id", "customer_id", "order_status", "is_delivered", "is_canceled", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_customer_date", "approval_hours")
    j = (o.join(items_per_order(s), "order_id", "left")
         .join(payments_per_order(s, types_as_text), "order_id", "left")
         .join(reviews_per_order(s), "order_id", "left"))
    empty_types = F.lit(None).cast("string") if types_as_text else F.array().cast("array<string>")
    return j.select(
        "order_id", "customer_id", "order_status", "is_delivered", "is_canceled", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_customer_date", "approval_hours",
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        "total_price", "total_freight", "total_order_value",
        F.coalesce("unique_products", F.lit(0)).alias("unique_products"),
        F.coalesce("unique_sellers", F.lit(0)).alias("unique_sellers"),
        F.coalesce("total_payment", F.lit(0.0)).alias("total_payment"),
        F.coalesce("payment_method_count", F.lit(0)).alias("payment_method_count"),
        F.coalesce("payment_types", empty_types).alias("payment_types"),
        F.coalesce("avg_review_score", F.lit(0.0)).alias("avg_review_score"),
        F.coalesce("review_count", F.lit(0)).alias("review_count"))


def gold_fct_orders(s: Silver) -> DataFrame:
    """One row per order that is not canceled; payment types as a sorted array."""
    return _order_details(s, False).where(~F.col("is_canceled"))


def int_order_details(s: Silver) -> DataFrame:
    """The order fact before the canceled filter, payment types as a ', '-joined string."""
    return _order_details(s, True)


def int_customer_orders(s: Silver) -> DataFrame:
    value = s["silver_fact_order_items"].groupBy("order_id").agg(F.sum(F.col("price") + F.col("freight_value")).alias("v"))
    d = orders_by_customer(s).join(value, "order_id", "left").groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum(F.col("v") * F.col("n_rows")).alias("total_revenue"),
        F.min("first_ts").alias("first_order_date"),
        F.max("last_ts").alias("last_order_date"))
    return (s["silver_dim_customers"].join(d, "customer_id", "left")
            .select("customer_id", "customer_unique_id", "customer_city", "customer_state",
                    F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
                    "total_revenue", "first_order_date", "last_order_date"))


STAR_MODELS = {
    "gold_dim_customers": gold_dim_customers,
    "gold_dim_products": gold_dim_products,
    "gold_dim_sellers": gold_dim_sellers,
    "gold_fct_orders": gold_fct_orders,
    "int_order_details": int_order_details,
    "int_customer_orders": int_customer_orders,
}
