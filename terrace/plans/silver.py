"""Silver layer: one cleaning job per raw table, full refresh.

Every function maps ``tables`` (raw layer) to one cleaned DataFrame. They are row-local
(projections only, plus one join against the small category lookup), so they never
shuffle the facts; Catalyst fuses each into a single whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from terrace.functions.exprs import (
    CANCELED_STATUSES, clamp_keep_null, hours_between_seconds, initcap_words, null_or_negative_to_zero,
)

Tables = Mapping[str, DataFrame]


def silver_dim_customers(t: Tables) -> DataFrame:
    return t["dim_customer"].select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        F.trim(initcap_words("customer_city")).alias("customer_city"),
        F.upper(F.trim("customer_state")).alias("customer_state"))


def silver_dim_sellers(t: Tables) -> DataFrame:
    return t["dim_seller"].select(
        "seller_id", "seller_zip_code_prefix",
        F.trim(initcap_words("seller_city")).alias("seller_city"),
        F.upper(F.trim("seller_state")).alias("seller_state"))


def silver_dim_products(t: Tables) -> DataFrame:
    """Products with the English category name, ``'unknown'`` when there is none.

    The category lookup is keyed by name; AQE turns this into a broadcast join when the
    lookup is small at run time and keeps a sort-merge join otherwise.
    """
    p = t["dim_product"]
    c = t["dim_product_category"]
    return (p.join(c, "product_category_name", "left")
            .select("product_id", "product_category_name",
                    F.coalesce("product_category_name_english", F.lit("unknown")).alias("product_category_english"),
                    "product_name_lenght", "product_description_lenght", "product_photos_qty",
                    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"))


def silver_fact_orders(t: Tables) -> DataFrame:
    s = F.col("order_status")
    return t["fact_order"].select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
        F.coalesce(s == F.lit("delivered"), F.lit(False)).alias("is_delivered"),
        F.when(s.isin(*CANCELED_STATUSES), True).otherwise(False).alias("is_canceled"),
        hours_between_seconds("order_approved_at", "order_purchase_timestamp").alias("approval_hours"))


def silver_fact_order_items(t: Tables) -> DataFrame:
    return t["fact_order_item"].select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
        null_or_negative_to_zero("price").alias("price"),
        null_or_negative_to_zero("freight_value").alias("freight_value"))


def silver_fact_payments(t: Tables) -> DataFrame:
    return t["fact_order_payment"].select(
        "order_id", "payment_sequential", "payment_type", "payment_installments",
        null_or_negative_to_zero("payment_value").alias("payment_value"))


def silver_fact_reviews(t: Tables) -> DataFrame:
    return t["fact_order_review"].select(
        "review_id", "order_id", clamp_keep_null("review_score").alias("review_score"),
        "review_comment_title", "review_comment_message", "review_creation_date", "review_answer_timestamp")


SILVER_MODELS = {
    "silver_dim_customers": silver_dim_customers,
    "silver_dim_sellers": silver_dim_sellers,
    "silver_dim_products": silver_dim_products,
    "silver_fact_orders": silver_fact_orders,
    "silver_fact_order_items": silver_fact_order_items,
    "silver_fact_payments": silver_fact_payments,
    "silver_fact_reviews": silver_fact_reviews,
}


class SilverTables(Mapping):
    """Lazy view of the silver layer over a raw-table mapping (each model built once)."""

    def __init__(self, raw: Tables):
        self.raw = raw
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = SILVER_MODELS[name](self.raw)
        return self._cache[name]

    def __iter__(self):
        return iter(SILVER_MODELS)

    def __len__(self) -> int:
        return len(SILVER_MODELS)
