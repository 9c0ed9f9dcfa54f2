"""Declared schemas: the relational source tables and the nested landed documents."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TS = T.TimestampNTZType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


# Relational source, one StructType per table; nullable=False marks a declared NOT NULL key.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "dim_customer": T.StructType([_f("customer_id", L, False), _f("customer_unique_id", S),
                                  _f("customer_zip_code_prefix", S), _f("customer_city", S), _f("customer_state", S)]),
    "dim_geolocation": T.StructType([_f("geolocation_zip_code_prefix", S), _f("geolocation_lat", D),
                                     _f("geolocation_lng", D), _f("geolocation_city", S), _f("geolocation_state", S)]),
    "dim_product": T.StructType([_f("product_id", L, False), _f("product_category_name", S),
                                 _f("product_name_lenght", I), _f("product_description_lenght", I),
                                 _f("product_photos_qty", I), _f("product_weight_g", D), _f("product_length_cm", D),
                                 _f("product_height_cm", D), _f("product_width_cm", D)]),
    "dim_product_category": T.StructType([_f("product_category_name", S, False),
                                          _f("product_category_name_english", S)]),
    "dim_seller": T.StructType([_f("seller_id", L, False), _f("seller_zip_code_prefix", S), _f("seller_city", S),
                                _f("seller_state", S)]),
    "fact_order": T.StructType([_f("order_id", L, False), _f("customer_id", L), _f("order_status", S),
                                _f("order_purchase_timestamp", TS), _f("order_approved_at", TS),
                                _f("order_delivered_carrier_date", TS), _f("order_delivered_customer_date", TS),
                                _f("order_estimated_delivery_date", TS)]),
    "fact_order_item": T.StructType([_f("order_id", L, False), _f("order_item_id", I, False), _f("product_id", L),
                                     _f("seller_id", L), _f("shipping_limit_date", TS), _f("price", D),
                                     _f("freight_value", D)]),
    "fact_order_payment": T.StructType([_f("order_id", L, False), _f("payment_sequential", I, False),
                                        _f("payment_type", S), _f("payment_installments", I), _f("payment_value", D)]),
    "fact_order_review": T.StructType([_f("review_id", L, False), _f("order_id", L), _f("review_score", I),
                                       _f("review_comment_title", S), _f("review_comment_message", S),
                                       _f("review_creation_date", TS), _f("review_answer_timestamp", TS)]),
}

# Declared keys (primary keys) and NOT NULL columns, used by the data-quality checks.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_customer": ("customer_id",),
    "dim_product": ("product_id",),
    "dim_product_category": ("product_category_name",),
    "dim_seller": ("seller_id",),
    "fact_order": ("order_id",),
    "fact_order_item": ("order_id", "order_item_id"),
    "fact_order_payment": ("order_id", "payment_sequential"),
    "fact_order_review": ("review_id",),
}

# Catalog of source files: (label, file name, table, category). Fixed values, in source order.
CSV_CATALOG = (
    ("dim_customer", "olist_customers_dataset.csv", "dim_customer", "DIM"),
    ("dim_geolocation", "olist_geolocation_dataset.csv", "dim_geolocation", "DIM"),
    ("dim_product", "olist_products_dataset.csv", "dim_product", "DIM"),
    ("dim_product_category", "product_category_name_translation.csv", "dim_product_category", "DIM"),
    ("dim_seller", "olist_sellers_dataset.csv", "dim_seller", "DIM"),
    ("fact_order", "olist_orders_dataset.csv", "fact_order", "FACT"),
    ("fact_order_item", "olist_order_items_dataset.csv", "fact_order_item", "FACT"),
    ("fact_order_payment", "olist_order_payments_dataset.csv", "fact_order_payment", "FACT"),
    ("fact_order_review", "olist_order_reviews_dataset.csv", "fact_order_review", "FACT"),
)

# Tables with free text, whose CSV fields may hold line breaks inside quotes.
FREE_TEXT_TABLES = frozenset({"fact_order_review"})

# Product API envelope: {products: [...], total, skip, limit}.
PRODUCT = T.StructType([_f("id", L), _f("title", S), _f("price", D), _f("stock", L), _f("category", S),
                        _f("rating", D)])
PRODUCT_ENVELOPE = T.StructType([_f("products", T.ArrayType(PRODUCT)), _f("total", L), _f("skip", L),
                                 _f("limit", L)])

# Weather history document: forecast.forecastday[].hour[] with a nested condition.
WEATHER_HOUR = T.StructType([
    _f("time", S), _f("temp_c", D), _f("feelslike_c", D), _f("humidity", L), _f("pressure_mb", D),
    _f("wind_kph", D), _f("wind_degree", L), _f("wind_dir", S), _f("cloud", L), _f("precip_mm", D),
    _f("vis_km", D), _f("uv", D), _f("is_day", L),
    _f("condition", T.StructType([_f("text", S), _f("code", L)])),
    _f("chance_of_rain", L), _f("will_it_rain", L)])
WEATHER_DOC = T.StructType([
    _f("location", T.StructType([_f("name", S)])),
    _f("forecast", T.StructType([_f("forecastday", T.ArrayType(T.StructType([
        _f("date", S), _f("hour", T.ArrayType(WEATHER_HOUR))])))]))])

# Forecast document: a regular time axis plus parallel float arrays.
FORECAST_DOC = T.StructType([
    _f("station", L), _f("time", L), _f("time_end", L), _f("interval", L), _f("utc_zone", S),
    _f("temperature_2m", T.ArrayType(T.FloatType())), _f("rain", T.ArrayType(T.FloatType())),
    _f("relative_humidity_2m", T.ArrayType(T.FloatType())), _f("weather_code", T.ArrayType(T.FloatType()))])

# Part-1 item rows: idx, name, total price, quantity (missing field = NULL).
ITEM_ROW = T.StructType([_f("idx", L), _f("nama", S), _f("harga_total", D), _f("jumlah", D)])

# Manually managed product table (declared with a default for harga).
MANUAL_PRODUCT = T.StructType([_f("id_produk", I, False), _f("nama_produk", S, False),
                               _f("harga", T.DecimalType(12, 2)), _f("stok", I, False),
                               _f("tanggal_ditambahkan", TS)])
MANUAL_PRODUCT_DEFAULTS = {"harga": 0.0}
