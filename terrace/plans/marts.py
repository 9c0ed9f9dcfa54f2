"""Gold marts built straight from the raw layer (the SQL marts and their pandas variants).

Scale notes that apply to every mart here:

* The SQL definitions join items and reviews on ``order_id`` inside an aggregate, so an item
  is counted once per review of its order (the review fan-out is part of the definition).
  Materialising that join would emit every item x review pair of an order. Instead the
  reviews are first reduced to one row per order (``rv_rows``, ``rv_sum``, ``rv_cnt``) and
  each item carries a weight ``w = max(rv_rows, 1)``: ``SUM(price)`` over the fan-out equals
  ``SUM(price * w)``, ``AVG(review_score)`` over it equals ``SUM(rv_sum) / SUM(rv_cnt)``.
  All joins are then 1:1 or 1:N on ``order_id`` and every aggregate is partial-then-final.
* Item facts are reduced to order grain before they meet the order table whenever the
  mart's grain allows it (map-side partial aggregation shrinks the shuffle).
* Shares of a total over a result grouped by a small, bounded dimension (review score) use a
  window over the grouped rows, so the input is aggregated once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from terrace.functions.aggregates import counts_and_sums, distinct_counts, join_on_keys
from terrace.functions.joins import left_join_many
from terrace.functions.exprs import (
    elapsed_days, hours_between, integer_ratio, not_canceled, not_canceled_keep_null, round2, safe_ratio,
    share_of_group_total,
)

Tables = Mapping[str, DataFrame]


# ---------------------------------------------------------------- shared building blocks
def valid_orders(t: Tables) -> DataFrame:
    """Orders whose status is known and not canceled/unavailable."""
    return t["fact_order"].where(not_canceled())


def review_stats_per_order(reviews: DataFrame) -> DataFrame:
    """One row per order: review rows, sum and count of non-NULL scores."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("rv_rows"),
        F.sum("review_score").alias("rv_sum"),
        F.count("review_score").alias("rv_cnt"))


def item_stats_per_order(items: DataFrame) -> DataFrame:
    """One row per order: item rows and the price / freight sums and counts."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("it_rows"),
        F.count("order_item_id").alias("it_n"),
        F.sum("price").alias("it_price"),
        F.count("price").alias("it_price_n"),
        F.sum("freight_value").alias("it_freight"),
        F.count("freight_value").alias("it_freight_n"))


def weighted_items(t: Tables) -> DataFrame:
    """Items with their review fan-out weight.

    Reproduces ``items LEFT JOIN orders ON id AND status valid LEFT JOIN reviews ON o.id``:
    an item of a valid order with k reviews stands for k rows (k >= 1), any other item for
    one row carrying NULL review columns.
    """
    return _with_review_weight(t["fact_order_item"], t)


def _with_review_weight(rows: DataFrame, t: Tables) -> DataFrame:
    """Rows with an ``order_id`` joined to the review sums of their order, if it is valid, with
    the fan-out weight ``w``."""
    reviewed = (review_stats_per_order(t["fact_order_review"])
                .join(valid_orders(t).select("order_id").hint("shuffle_hash"), "order_id", "left_semi"))
    # A task hashes its reviewed orders; its items stream past them unsorted.
    return (rows.join(reviewed.hint("shuffle_hash"), "order_id", "left")
            .withColumn("w", F.greatest(F.coalesce("rv_rows", F.lit(0)), F.lit(1))))


def _weighted_measures() -> list:
    """Item measures over the review fan-out, from weighted item rows."""
    w = F.col("w")
    price_rows = F.sum(F.when(F.col("price").isNotNull(), w))
    return [
        F.sum(F.col("order_item_id") * w).alias("units"),
        F.sum(F.col("price") * w).alias("revenue"),
        F.try_divide(F.sum(F.col("price") * w), price_rows).alias("avg_price"),
        F.sum(F.col("freight_value") * w).alias("freight"),
        F.try_divide(F.sum("rv_sum").cast("double"), F.sum("rv_cnt").cast("double")).alias("avg_review"),
    ]


# ---------------------------------------------------------------- G1 / G1p
def gold_daily_sales_summary(t: Tables) -> DataFrame:
    per_order = item_stats_per_order(t["fact_order_item"])
    o = valid_orders(t).select("order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("order_date"))
    j = o.join(per_order, "order_id", "left")
    rev, fr = F.sum("it_price"), F.sum("it_freight")
    counts = distinct_counts(o, ["order_date"], {"total_orders": "order_id", "total_customers": "customer_id"})
    sums = (j.groupBy("order_date").agg(
        F.coalesce(F.sum("it_n"), F.lit(0)).alias("total_items_sold"),
        round2(rev).alias("total_revenue"),
        round2(fr).alias("total_freight"),
        round2(rev + fr).alias("total_gross"),
        round2(F.try_divide(rev, F.sum("it_price_n").cast("double"))).alias("avg_item_price"),
        round2(F.try_divide(fr, F.sum("it_freight_n").cast("double"))).alias("avg_freight")))
    return join_on_keys(counts, sums, ["order_date"]).select(
        "order_date", "total_orders", "total_customers", "total_items_sold", "total_revenue", "total_freight",
        "total_gross", "avg_item_price", "avg_freight")


def gold_daily_sales_summary_df(t: Tables) -> DataFrame:
    """The DataFrame-library variant: NULL status kept, NULL dates dropped, empty sums are 0."""
    per_order = item_stats_per_order(t["fact_order_item"])
    o = (t["fact_order"].where(not_canceled_keep_null())
         .select("order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("order_date"))
         .where(F.col("order_date").isNotNull()))
    j = o.join(per_order, "order_id", "left")
    rev = F.coalesce(F.sum("it_price"), F.lit(0.0))
    fr = F.coalesce(F.sum("it_freight"), F.lit(0.0))
    counts = distinct_counts(o, ["order_date"], {"total_orders": "order_id", "total_customers": "customer_id"})
    sums = (j.groupBy("order_date").agg(
        F.coalesce(F.sum("it_n"), F.lit(0)).alias("total_items_sold"),
        round2(rev).alias("total_revenue"),
        round2(fr).alias("total_freight"),
        round2(rev + fr).alias("total_gross"),
        round2(F.try_divide(F.sum("it_price"), F.sum("it_price_n").cast("double"))).alias("avg_item_price"),
        round2(F.try_divide(F.sum("it_freight"), F.sum("it_freight_n").cast("double"))).alias("avg_freight")))
    return join_on_keys(counts, sums, ["order_date"]).select(
        "order_date", "total_orders", "total_customers", "total_items_sold", "total_revenue", "total_freight",
        "total_gross", "avg_item_price", "avg_freight")


# ---------------------------------------------------------------- G2
def gold_product_performance(t: Tables) -> DataFrame:
    # Counted apart: beside a distinct count every sum would be kept per product and order.
    sums = weighted_items(t).groupBy("product_id").agg(*_weighted_measures())
    per_product = sums.join(distinct_counts(t["fact_order_item"], ["product_id"], {"n_orders": "order_id"}), "product_id")
    p = t["dim_product"]
    c = t["dim_product_category"]
    z = F.lit(0)
    return (p.join(c, "product_category_name", "left")
            .join(per_product, "product_id", "left")
            .select("product_id",
                    F.coalesce("product_category_name_english", "product_category_name", F.lit("Unknown"))
                    .alias("category_english"),
                    "product_weight_g",
                    (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"))
                    .alias("product_volume_cm3"),
                    F.coalesce("n_orders", z).alias("total_orders"),
                    F.coalesce("units", z).cast("bigint").alias("total_units_sold"),
                    F.coalesce(round2("revenue"), z.cast("double")).alias("total_revenue"),
                    F.coalesce(round2("avg_price"), z.cast("double")).alias("avg_unit_price"),
                    F.coalesce(round2("freight"), z.cast("double")).alias("total_freight_paid"),
                    F.coalesce(round2("avg_review"), z.cast("double")).alias("avg_review_score")))


# ---------------------------------------------------------------- G3
def gold_customer_ltv(t: Tables) -> DataFrame:
    """Per customer. The status predicate sits on the order join, before items and reviews.

    Each valid order stands for ``max(item rows,1) * max(review rows,1)`` joined rows; price
    sums repeat per review row and score sums per item row.
    """
    o = valid_orders(t).select("order_id", "customer_id", "order_purchase_timestamp")
    it = item_stats_per_order(t["fact_order_item"])
    rv = review_stats_per_order(t["fact_order_review"])
    ir = F.greatest(F.coalesce("it_rows", F.lit(0)), F.lit(1))
    rr = F.greatest(F.coalesce("rv_rows", F.lit(0)), F.lit(1))
    per_order = (o.join(it, "order_id", "left").join(rv, "order_id", "left")
                 .select("order_id", "customer_id", "order_purchase_timestamp",
                         (F.col("it_price") * rr).alias("p_sum"), (F.col("it_price_n") * rr).alias("p_cnt"),
                         (F.col("rv_sum") * ir).alias("s_sum"), (F.col("rv_cnt") * ir).alias("s_cnt")))
    per_customer = per_order.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("n_orders"),
        F.min("order_purchase_timestamp").alias("first_order_date"),
        F.max("order_purchase_timestamp").alias("last_order_date"),
        F.sum("p_sum").alias("rev"),
        F.try_divide(F.sum("p_sum"), F.sum("p_cnt").cast("double")).alias("avg_p"),
        F.try_divide(F.sum("s_sum").cast("double"), F.sum("s_cnt").cast("double")).alias("avg_s"))
    return (t["dim_customer"].join(per_customer, "customer_id", "left")
            .select("customer_id", "customer_unique_id", "customer_city", "customer_state",
                    F.coalesce("n_orders", F.lit(0)).alias("total_orders"),
                    "first_order_date", "last_order_date",
                    elapsed_days("first_order_date", "last_order_date").alias("customer_lifetime_days"),
                    round2("rev").alias("total_revenue"),
                    round2("avg_p").alias("avg_order_value"),
                    round2("avg_s").alias("avg_review_given")))


# ---------------------------------------------------------------- G4
def gold_seller_performance(t: Tables) -> DataFrame:
    """Per seller, over the review fan-out. An order has one review weight, so items are first
    reduced to one row per (seller, order); the orders of a seller are then a plain count."""
    items = t["fact_order_item"]
    seller_orders = items.groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_item_id").alias("units"), F.sum("price").alias("p"),
        F.count("price").alias("p_n"), F.sum("freight_value").alias("f"))
    w, n = F.col("w"), F.col("n")
    sums = _with_review_weight(seller_orders, t).groupBy("seller_id").agg(
        F.count("order_id").alias("n_orders"), F.sum(F.col("units") * w).alias("units"),
        F.sum(F.col("p") * w).alias("revenue"),
        F.try_divide(F.sum(F.col("p") * w), F.sum(F.when(F.col("p_n") > 0, F.col("p_n") * w))).alias("avg_price"),
        F.sum(F.col("f") * w).alias("freight"),
        F.try_divide(F.sum(F.col("rv_sum") * n).cast("double"), F.sum(F.col("rv_cnt") * n).cast("double")).alias("avg_review"))
    per_seller = join_on_keys(sums, distinct_counts(items, ["seller_id"], {"n_products": "product_id"}), ["seller_id"])
    return (t["dim_seller"].join(per_seller, "seller_id", "left")
            .select("seller_id", "seller_city", "seller_state",
                    F.coalesce("n_orders", F.lit(0)).alias("total_orders_served"),
                    F.coalesce("n_products", F.lit(0)).alias("unique_products_sold"),
                    F.col("units").cast("bigint").alias("total_units_sold"),
                    round2("revenue").alias("total_revenue"),
                    round2("avg_price").alias("avg_sale_price"),
                    round2("freight").alias("total_freight_charged"),
                    round2("avg_review").alias("avg_customer_review")))


# ---------------------------------------------------------------- G5 / G5p
def _payment_aggs(nonempty_sum_zero: bool) -> list:
    vol = F.sum("payment_value")
    if nonempty_sum_zero:
        vol = F.coalesce(vol, F.lit(0.0))
    return [
        F.countDistinct("order_id").alias("total_orders"),
        (F.count("order_id") if nonempty_sum_zero else F.count(F.lit(1))).alias("total_transactions"),
        round2(vol).alias("total_payment_volume"),
        round2(F.avg("payment_value")).alias("avg_payment_value"),
        round2(F.avg("payment_installments")).alias("avg_installments"),
        F.min("payment_value").alias("min_payment"),
        F.max("payment_value").alias("max_payment"),
    ]


def gold_payment_analysis(t: Tables) -> DataFrame:
    """Per payment type over *all* payments.

    The SQL left-joins orders with the status predicate in ON; with ``order_id`` unique in
    the order table (checked by ``dq_unique``) that join neither filters nor duplicates a
    payment, so the plan aggregates the payments directly and saves a shuffle of both facts.
    """
    return t["fact_order_payment"].groupBy("payment_type").agg(*_payment_aggs(False))


def gold_payment_analysis_df(t: Tables) -> DataFrame:
    """DataFrame-library variant: inner join on the valid-order id list (NULL status kept)."""
    valid_ids = t["fact_order"].where(not_canceled_keep_null()).select("order_id")
    pay = t["fact_order_payment"].join(valid_ids, "order_id", "left_semi")
    return (pay.where(F.col("payment_type").isNotNull())
            .groupBy("payment_type").agg(*_payment_aggs(True)))


# ---------------------------------------------------------------- G6
def gold_review_analysis(t: Tables) -> DataFrame:
    r = t["fact_order_review"]
    return (r.groupBy("review_score").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.countDistinct("order_id").alias("unique_orders"),
        F.count("review_comment_message").alias("reviews_with_comment"),
        F.count("review_comment_title").alias("reviews_with_title"))
        .select("review_score", "total_reviews", share_of_group_total("total_reviews").alias("pct_of_total"),
                "unique_orders", "reviews_with_comment", "reviews_with_title"))


# ---------------------------------------------------------------- G7
def delivery_measures() -> dict:
    """Hours and delivery status of an order, by output name."""
    dcd, est = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return {
        "approval_hours": hours_between("order_approved_at", "order_purchase_timestamp"),
        "fulfillment_hours": hours_between("order_delivered_customer_date", "order_purchase_timestamp"),
        "delivery_vs_estimate_hours": hours_between("order_delivered_customer_date", "order_estimated_delivery_date"),
        "delivery_status": F.when(dcd > est, "Late").when(dcd.isNotNull(), "On Time").otherwise("Not Delivered")}


def fulfilled_orders(t: Tables) -> DataFrame:
    """Valid orders with their delivery measures: the fulfillment mart before its items, sellers
    and customers, for queries that need none of them."""
    return valid_orders(t).select("order_id", *[c.alias(n) for n, c in delivery_measures().items()])


def gold_order_fulfillment(t: Tables) -> DataFrame:
    """Order x item grain. The seller lookup is joined to the items before they meet the
    orders (equivalent: the seller predicate only references item columns)."""
    o = valid_orders(t).join(
        t["dim_customer"].select("customer_id", "customer_city", "customer_state"), "customer_id", "left")
    i = (t["fact_order_item"].select("order_id", "seller_id")
         .join(t["dim_seller"].select("seller_id", "seller_city", "seller_state"), "seller_id", "left"))
    j = left_join_many(o, i, ["order_id"])
    return j.select(
        "order_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
        *[c.alias(n) for n, c in delivery_measures().items()],
        "customer_city", "customer_state", "seller_city", "seller_state")


# ---------------------------------------------------------------- G8
def gold_category_performance(t: Tables) -> DataFrame:
    products = (t["dim_product"].join(t["dim_product_category"], "product_category_name", "left")
                .select("product_id",
                        F.coalesce("product_category_name_english", "product_category_name", F.lit("Unknown"))
                        .alias("category_name")))
    per_cat_products = products.groupBy("category_name").agg(F.countDistinct("product_id").alias("total_products"))
    per_cat_items = (weighted_items(t).join(products, "product_id", "inner")
                     .groupBy("category_name").agg(F.countDistinct("order_id").alias("n_orders"),
                                                   *_weighted_measures()))
    z = F.lit(0)
    return (per_cat_products.join(per_cat_items, "category_name", "left")
            .select("category_name", "total_products",
                    F.coalesce("n_orders", z).alias("total_orders"),
                    F.coalesce("units", z).cast("bigint").alias("total_units_sold"),
                    F.coalesce(round2("revenue"), z.cast("double")).alias("total_revenue"),
                    F.coalesce(round2("avg_price"), z.cast("double")).alias("avg_price"),
                    F.coalesce(round2("freight"), z.cast("double")).alias("total_freight"),
                    F.coalesce(round2("avg_review"), z.cast("double")).alias("avg_review_score")))


# ---------------------------------------------------------------- G9
def daily_orders(t: Tables) -> DataFrame:
    """Per purchase date over ``valid orders LEFT JOIN items``. Order and customer counts need
    only the orders; the item measures only the matched items (an order without items adds
    nothing to them), so the plan is an inner join (skew-splittable on both sides) and the
    dates are taken from the orders side."""
    o = valid_orders(t).select("order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("order_date"))
    i = t["fact_order_item"].select("order_id", "order_item_id", "product_id", "price", "freight_value")
    # One join; a (date, product) row carries the sums, and a date's products are then a count.
    per_product = (o.select("order_id", "order_date").join(i, "order_id", "inner").groupBy("order_date", "product_id").agg(
        F.sum("price").alias("p"), F.sum("freight_value").alias("f"), F.count("order_item_id").alias("n")))
    item_measures = per_product.groupBy("order_date").agg(
        round2(F.sum("p")).alias("revenue"), round2(F.sum("f")).alias("freight"),
        F.sum("n").alias("items_sold"), F.count("product_id").alias("unique_products"))
    per_date = join_on_keys(counts_and_sums(o, ["order_date"], {"orders": "order_id", "unique_customers": "customer_id"}, {}),
                            item_measures, ["order_date"], "left")
    return per_date.select("order_date", "orders", "unique_customers", "revenue", "freight",
                           F.coalesce("items_sold", F.lit(0)).alias("items_sold"),
                           F.coalesce("unique_products", F.lit(0)).alias("unique_products"))


def daily_reviews(t: Tables) -> DataFrame:
    return (t["fact_order_review"].groupBy(F.to_date("review_creation_date").alias("review_date"))
            .agg(round2(F.avg("review_score")).alias("avg_daily_score"),
                 F.count(F.lit(1)).alias("total_reviews")))


def gold_daily_kpi(t: Tables) -> DataFrame:
    d, dr = daily_orders(t), daily_reviews(t)
    j = d.join(dr, d["order_date"] == dr["review_date"], "full")
    return j.select(
        F.coalesce(d["order_date"], dr["review_date"]).alias("date"),
        "orders", "unique_customers", "revenue", "freight", "items_sold", "unique_products",
        round2(safe_ratio("revenue", "orders")).alias("revenue_per_order"),
        round2(integer_ratio("items_sold", "orders").cast("double")).alias("items_per_order"),
        "avg_daily_score", "total_reviews")


GOLD_MARTS = {
    "gold_daily_sales_summary": gold_daily_sales_summary,
    "gold_daily_sales_summary_df": gold_daily_sales_summary_df,
    "gold_product_performance": gold_product_performance,
    "gold_customer_ltv": gold_customer_ltv,
    "gold_seller_performance": gold_seller_performance,
    "gold_payment_analysis": gold_payment_analysis,
    "gold_payment_analysis_df": gold_payment_analysis_df,
    "gold_review_analysis": gold_review_analysis,
    "gold_order_fulfillment": gold_order_fulfillment,
    "gold_category_performance": gold_category_performance,
    "gold_daily_kpi": gold_daily_kpi,
}
