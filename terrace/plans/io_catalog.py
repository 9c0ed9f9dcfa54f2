"""Registry entries for sources, sinks, quality tests, table edits, pipelines and the stream.

These keys land or write files below the shared checkpoint folder and read them back, so
the oracle can check the values that went through the round trip.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrace import oracle as O
from terrace import schemas
from terrace.operators import layers as R
from terrace.operators import quality as Q
from terrace.operators import sinks as K
from terrace.operators import upsert as U
from terrace.operators import versions as V
from terrace.plans import cleaning as P, marts, star
from terrace.plans.silver import SILVER_MODELS, SilverTables
from terrace.registry import register
from terrace.session import ensure_checkpoint_dir, scratch_path
from terrace.sources import landing as L
from terrace.sources import readers as S
from terrace.sources.fixtures import Tables, read_base
from terrace.streaming.incremental import FACTS_BY_ORDER, current_fact, land_orders_by_month
from terrace.streaming.incremental import stream_incremental_orders as run_order_stream


def key(name: str, sql: str | None = None, *deps: str):
    def deco(fn):
        register(name, fn)
        if sql is not None:
            O.register(name, O.build(sql, *deps))
        return fn
    return deco


O.cte("landed_products", L.PRODUCTS_SQL)
PRODUCT_COLS = "id, title, price, stock, category, rating"


def _pages(spark: SparkSession, sf_dir: str) -> str:
    return L.land_product_pages(read_base(spark, sf_dir, "part"), scratch_path(spark, "product-pages"))


# ====================================================================== sources
@key("src_json_envelope", f"SELECT {PRODUCT_COLS} FROM landed_products", "landed_products")
def src_json_envelope(spark, sf_dir):
    return S.read_json_envelope(spark, _pages(spark, sf_dir))


@key("src_with_fallback", f"SELECT {PRODUCT_COLS} FROM landed_products", "landed_products")
def src_with_fallback(spark, sf_dir):
    primary = scratch_path(spark, "api-response-unavailable")  # never written: the API is down
    return S.read_with_fallback(spark, primary, _pages(spark, sf_dir))


def _catalog_counts_sql(status: bool) -> str:
    status_col = "'ok' AS status, " if status else ""
    parts = [f"SELECT '{t}' AS table_name, '{c}' AS category, {status_col}COUNT(*) AS rows FROM {t}"
             for _l, _f, t, c in schemas.CSV_CATALOG]
    return "\nUNION ALL ".join(parts)


def _land_catalog(spark, sf_dir) -> str:
    return L.land_csv_catalog(spark, Tables(spark, sf_dir), scratch_path(spark, "csv-drop"))


@key("src_csv_catalog", _catalog_counts_sql(False), *[t for _l, _f, t, _c in schemas.CSV_CATALOG])
def src_csv_catalog(spark, sf_dir):
    folder = _land_catalog(spark, sf_dir)
    tables = S.read_csv_catalog(spark, folder)
    cats = {t: c for _l, _f, t, c in schemas.CSV_CATALOG}
    counts = [df.agg(F.lit(t).alias("table_name"), F.lit(cats[t]).alias("category"),
                     F.count(F.lit(1)).alias("rows")) for t, df in tables.items()]
    return Q.suite(counts)


def _csv_of(spark, sf_dir, table: str) -> str:
    return L.land_csv(Tables(spark, sf_dir)[table], scratch_path(spark, f"csv-{table}"))


@key("src_csv_parse_dates", "SELECT * FROM fact_order", "fact_order")
def src_csv_parse_dates(spark, sf_dir):
    return S.read_csv_parse_dates(spark, _csv_of(spark, sf_dir, "fact_order"), "fact_order")


@key("src_csv_raw_strings", "SELECT * FROM fact_order", "fact_order")
def src_csv_raw_strings(spark, sf_dir):
    return S.read_csv_raw_strings(spark, _csv_of(spark, sf_dir, "fact_order"), "fact_order")


@key("src_csv_chunked", "SELECT * FROM fact_order_item", "fact_order_item")
def src_csv_chunked(spark, sf_dir, chunk_bytes: int = 256 * 1024):
    path = _csv_of(spark, sf_dir, "fact_order_item")
    return S.read_csv(spark, path, schemas.RAW_SCHEMAS["fact_order_item"], max_partition_bytes=chunk_bytes)


@key("src_table_scan", "SELECT * FROM gold_daily_sales_summary", "gold_daily_sales_summary")
def src_table_scan(spark, sf_dir):
    path = K.write_parquet(marts.gold_daily_sales_summary(Tables(spark, sf_dir)), scratch_path(spark, "gold-daily"))
    return S.read_table(spark, path)


@key("src_registry", "SELECT order_status, COUNT(*) AS n FROM fact_order GROUP BY order_status", "fact_order")
def src_registry(spark, sf_dir):
    t = Tables(spark, sf_dir)
    prefix = f"raw_{uuid.uuid4().hex[:8]}_"
    S.register_sources({name: t[name] for name in t}, prefix)
    return spark.sql(f"SELECT order_status, COUNT(*) AS n FROM {prefix}fact_order GROUP BY order_status")


WEATHER_SQL = """
SELECT strptime(strftime(ts, '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M') AS time, value AS temp_c,
       value - 1.5 AS feelslike_c, user_id % 100 AS humidity, CAST(1000.0 AS DOUBLE) + value AS pressure_mb,
       value / 2 AS wind_kph, event_id % 360 AS wind_degree, upper(substr(event_type, 1, 3)) AS wind_dir,
       event_id % 101 AS cloud, value / 10 AS precip_mm, CAST(10.0 AS DOUBLE) AS vis_km, value % 11 AS uv,
       CAST(CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 1 ELSE 0 END AS BIGINT) AS is_day,
       event_type AS condition_text, CAST(1000 + event_id % 7 AS BIGINT) AS condition_code,
       event_id % 100 AS chance_of_rain, CAST(CASE WHEN event_id % 100 >= 50 THEN 1 ELSE 0 END AS BIGINT) AS will_it_rain
FROM events"""
FORECAST_SQL = f"""
SELECT event_id // 24 AS station,
       CAST(timezone('Asia/Bangkok', to_timestamp({L.EPOCH_BASE} + (event_id // 24) * 86400 + pos * 3600)) AS TIMESTAMP) AS date,
       CAST(value AS FLOAT) AS temperature_2m, CAST(value / 10 AS FLOAT) AS rain,
       CAST(user_id % 100 AS FLOAT) AS relative_humidity_2m, CAST(event_id % 4 AS FLOAT) AS weather_code
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id // 24 ORDER BY event_id) - 1 AS pos FROM events)"""


def _weather(spark, sf_dir) -> DataFrame:
    path = L.land_weather_history(read_base(spark, sf_dir, "events"), scratch_path(spark, "weather-history"))
    return S.read_weather_hourly(spark, path)


def _forecast(spark, sf_dir, zone: str = "Asia/Bangkok") -> DataFrame:
    path = L.land_forecast_arrays(read_base(spark, sf_dir, "events"), scratch_path(spark, "forecast"), zone)
    return S.read_forecast_arrays(spark, path, zone)


@key("src_weather_hourly", WEATHER_SQL)
def src_weather_hourly(spark, sf_dir):
    return _weather(spark, sf_dir)


@key("src_forecast_arrays", FORECAST_SQL)
def src_forecast_arrays(spark, sf_dir):
    return _forecast(spark, sf_dir)


@key("src_seed_csv", """
SELECT p.product_id, c.product_category_name_english FROM dim_product p
LEFT JOIN dim_product_category c ON p.product_category_name = c.product_category_name""",
     "dim_product", "dim_product_category")
def src_seed_csv(spark, sf_dir):
    t = Tables(spark, sf_dir)
    seed_path = L.land_csv(t["dim_product_category"], scratch_path(spark, "seed-category"))
    seed = S.read_seed(spark, seed_path, schemas.RAW_SCHEMAS["dim_product_category"])
    return t["dim_product"].select("product_id", "product_category_name").join(
        seed, "product_category_name", "left").select("product_id", "product_category_name_english")


@key("catalog_tables", "\nUNION ALL ".join(f"SELECT '{m}' AS model, COUNT(*) AS rows FROM {m}" for m in SILVER_MODELS),
     *SILVER_MODELS)
def catalog_tables(spark, sf_dir):
    """The models that the session catalog lists, with the rows of each."""
    s = SilverTables(Tables(spark, sf_dir))
    tag = uuid.uuid4().hex[:8]
    for name in SILVER_MODELS:
        s[name].createOrReplaceTempView(f"l{tag}_{name}")
    listed = [r.tableName for r in S.catalog_tables(spark, f"l{tag}_silver_*").collect()]
    counts = [spark.table(v).agg(F.lit(v.removeprefix(f"l{tag}_")).alias("model"), F.count(F.lit(1)).alias("rows")) for v in listed]
    return Q.suite(counts)


# ====================================================================== sinks
@key("sink_parquet", "SELECT * FROM gold_daily_kpi", "gold_daily_kpi")
def sink_parquet(spark, sf_dir):
    path = K.write_parquet(marts.gold_daily_kpi(Tables(spark, sf_dir)), scratch_path(spark, "daily-kpi"))
    return spark.read.parquet(path)


@key("sink_replace", "SELECT * FROM gold_review_analysis", "gold_review_analysis")
def sink_replace(spark, sf_dir):
    df = marts.gold_review_analysis(Tables(spark, sf_dir))
    path = scratch_path(spark, "review-analysis")
    K.write_replace(df, path)
    K.write_replace(df, path)  # the second run replaces, it does not add
    return spark.read.parquet(path)


@key("sink_append_batches", "SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM fact_order",
     "fact_order")
def sink_append_batches(spark, sf_dir):
    o = Tables(spark, sf_dir)["fact_order"].select("order_id", "customer_id", "order_status",
                                                   "order_purchase_timestamp")
    part = F.pmod(F.xxhash64("order_id"), F.lit(3))  # total: every row, NULLs too, is in one batch
    batches = [o.where(part == k) for k in range(3)]
    return spark.read.parquet(K.write_in_batches(batches, scratch_path(spark, "orders-batched")))


@key("sink_ctas", "SELECT * FROM gold_review_analysis", "gold_review_analysis")
def sink_ctas(spark, sf_dir):
    name = f"review_analysis_{uuid.uuid4().hex[:8]}"
    location = K.layer_path(f"{ensure_checkpoint_dir(spark)}/terrace/warehouse", "gold", name)
    return K.create_table_as(spark, "gold", name, location, marts.gold_review_analysis(Tables(spark, sf_dir)))


@key("normalize_types", """
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id, order_status,
       CAST(order_purchase_timestamp AS VARCHAR) AS order_purchase_timestamp,
       CAST(order_approved_at AS VARCHAR) AS order_approved_at,
       CAST(order_delivered_carrier_date AS VARCHAR) AS order_delivered_carrier_date,
       CAST(order_delivered_customer_date AS VARCHAR) AS order_delivered_customer_date,
       CAST(order_estimated_delivery_date AS VARCHAR) AS order_estimated_delivery_date FROM fact_order""", "fact_order")
def normalize_types(spark, sf_dir):
    return K.normalize_types(Tables(spark, sf_dir)["fact_order"])


@key("sink_sorted_table", "SELECT * FROM silver_fact_order_items", "silver_fact_order_items")
def sink_sorted_table(spark, sf_dir):
    s = SilverTables(Tables(spark, sf_dir))
    path = K.write_sorted(s["silver_fact_order_items"], scratch_path(spark, "items-sorted"), ["order_id", "order_item_id"])
    return spark.read.parquet(path)


@key("sink_layer_name", "SELECT * FROM silver_dim_sellers", "silver_dim_sellers")
def sink_layer_name(spark, sf_dir):
    base = scratch_path(spark, "warehouse")
    path = K.layer_path(base, "silver", "silver_dim_sellers")
    K.write_parquet(SilverTables(Tables(spark, sf_dir))["silver_dim_sellers"], path)
    return spark.read.parquet(path)


@key("sink_partition_month", "SELECT order_id, strftime(order_purchase_timestamp, '%Y%m') AS ym FROM fact_order",
     "fact_order")
def sink_partition_month(spark, sf_dir):
    o = Tables(spark, sf_dir)["fact_order"]
    path = K.write_partitioned_by_month(o, scratch_path(spark, "orders-by-month"), "order_purchase_timestamp")
    return spark.read.parquet(path).select("order_id", F.col("ym").cast("string").alias("ym"))


@key("ingest_report", _catalog_counts_sql(True), *[t for _l, _f, t, _c in schemas.CSV_CATALOG])
def ingest_report(spark, sf_dir):
    folder = _land_catalog(spark, sf_dir)
    rep = K.ingest_catalog(spark, folder, scratch_path(spark, "raw-parquet"), S.read_csv_checked)
    return rep.select("table_name", "category", "status", "rows")


@key("sink_fallback_csv", "SELECT * FROM gold_seller_performance", "gold_seller_performance")
def sink_fallback_csv(spark, sf_dir):
    df = marts.gold_seller_performance(Tables(spark, sf_dir))
    # Spark brings no LZO library: the Parquet write fails and the CSV one takes its place.
    fmt, path = K.write_with_csv_fallback(df, scratch_path(spark, "sellers"), compression="lzo")
    return _written(spark, fmt, path, df.schema)


def _written(spark, fmt: str, path: str, schema) -> DataFrame:
    return spark.read.parquet(path) if fmt == "parquet" else S.read_csv(spark, path, schema, multiline=True, keep_empty=True)


MANUAL_SQL = """
SELECT TRY_CAST(product_id AS INTEGER) AS id_produk, product_category_name AS nama_produk,
       COALESCE(TRY_CAST(product_weight_g AS DECIMAL(12,2)), CAST(0.0 AS DECIMAL(12,2))) AS harga,
       TRY_CAST(product_photos_qty AS INTEGER) AS stok, CAST(NULL AS TIMESTAMP) AS tanggal_ditambahkan
FROM dim_product"""
O.cte("manual_products", MANUAL_SQL, "dim_product")


def _manual_products(t) -> DataFrame:
    src = t["dim_product"].select(
        F.col("product_id").alias("id_produk"), F.col("product_category_name").alias("nama_produk"),
        F.col("product_weight_g").alias("harga"), F.col("product_photos_qty").alias("stok"))
    return K.conform_to_declared(src, schemas.MANUAL_PRODUCT, schemas.MANUAL_PRODUCT_DEFAULTS)


@key("ddl_declared_table", "SELECT * FROM manual_products", "manual_products")
def ddl_declared_table(spark, sf_dir):
    return _manual_products(Tables(spark, sf_dir))


# ====================================================================== quality
def _unique_reports(t):
    return [Q.dq_unique(t[m], m, list(k)) for m, k in schemas.PRIMARY_KEYS.items()]


def _sql_report(model, test, column, failing_sql):
    return (f"SELECT '{model}' AS model, '{test}' AS test, '{column}' AS \"column\", CAST(n AS BIGINT) AS failing_rows, "
            f"CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({failing_sql}) q(n)")


UNIQUE_SQL = "\nUNION ALL ".join(
    _sql_report(m, "unique", ",".join(k), f"SELECT COUNT(*) FROM (SELECT {', '.join(k)} FROM {m} WHERE "
                + " AND ".join(f"{c} IS NOT NULL" for c in k) + f" GROUP BY {', '.join(k)} HAVING COUNT(*) > 1)")
    for m, k in schemas.PRIMARY_KEYS.items())


@key("dq_unique", UNIQUE_SQL, *schemas.PRIMARY_KEYS)
def dq_unique(spark, sf_dir):
    return Q.suite(_unique_reports(Tables(spark, sf_dir)))


NOT_NULL = [(m, f.name) for m, s in schemas.RAW_SCHEMAS.items() for f in s.fields if not f.nullable]
NOT_NULL_SQL = "\nUNION ALL ".join(
    _sql_report(m, "not_null", c, f"SELECT COUNT(*) FROM {m} WHERE {c} IS NULL") for m, c in NOT_NULL)


@key("dq_not_null", NOT_NULL_SQL, *sorted({m for m, _ in NOT_NULL}))
def dq_not_null(spark, sf_dir):
    t = Tables(spark, sf_dir)
    columns = {m: [c for x, c in NOT_NULL if x == m] for m, _ in NOT_NULL}
    return Q.suite([Q.dq_checks(t[m], m, [("not_null", c, F.col(c).isNull()) for c in cs]) for m, cs in columns.items()])


# Accepted order statuses and payment types of the source system.
ORDER_STATUSES = ("created", "approved", "invoiced", "processing", "shipped", "delivered", "unavailable", "canceled")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
ACCEPTED = [("fact_order", "order_status", ORDER_STATUSES), ("fact_order_payment", "payment_type", PAYMENT_TYPES)]
ACCEPTED_SQL = "\nUNION ALL ".join(
    _sql_report(m, "accepted_values", c, f"SELECT COUNT(*) FROM {m} WHERE {c} NOT IN ("
                + ", ".join(f"'{v}'" for v in vals) + ")") for m, c, vals in ACCEPTED)


@key("dq_accepted_values", ACCEPTED_SQL, "fact_order", "fact_order_payment")
def dq_accepted_values(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return Q.suite([Q.dq_accepted_values(t[m], m, c, vals) for m, c, vals in ACCEPTED])


RELATIONS = [("fact_order_item", "product_id", "dim_product", "product_id"),
             ("fact_order_item", "seller_id", "dim_seller", "seller_id"),
             ("fact_order", "customer_id", "dim_customer", "customer_id"),
             ("fact_order_review", "order_id", "fact_order", "order_id"),
             ("fact_order_payment", "order_id", "fact_order", "order_id")]
REL_SQL = "\nUNION ALL ".join(
    _sql_report(m, "relationships", c, f"SELECT COUNT(*) FROM {m} WHERE {c} IS NOT NULL AND {c} NOT IN "
                f"(SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL)") for m, c, p, pc in RELATIONS)


@key("dq_relationships", REL_SQL, *sorted({x for m, _, p, _ in RELATIONS for x in (m, p)}))
def dq_relationships(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return Q.suite([Q.dq_relationships(t[m], m, c, t[p], pc) for m, c, p, pc in RELATIONS])


SINGULAR_SQL = "\nUNION ALL ".join([
    _sql_report("gold_dim_customers", "assert_positive_revenue", "",
                "SELECT COUNT(*) FROM gold_dim_customers WHERE total_revenue < 0"),
    _sql_report("silver_fact_reviews", "assert_valid_review_score", "",
                "SELECT COUNT(*) FROM silver_fact_reviews WHERE review_score < 1 OR review_score > 5"),
    _sql_report("gold_fct_orders", "assert_customer_not_null", "",
                "SELECT COUNT(*) FROM gold_fct_orders WHERE customer_id IS NULL"),
    _sql_report("gold_fct_orders", "assert_positive_order_value", "",
                "SELECT COUNT(*) FROM gold_fct_orders WHERE total_order_value <= 0"),
])


@key("dq_singular", SINGULAR_SQL, "gold_dim_customers", "silver_fact_reviews", "gold_fct_orders")
def dq_singular(spark, sf_dir):
    s = SilverTables(Tables(spark, sf_dir))
    tests = {"gold_dim_customers": [("assert_positive_revenue", "", F.col("total_revenue") < 0)],
             "silver_fact_reviews": [("assert_valid_review_score", "", (F.col("review_score") < 1) | (F.col("review_score") > 5))],
             "gold_fct_orders": [("assert_customer_not_null", "", F.col("customer_id").isNull()),
                                 ("assert_positive_order_value", "", F.col("total_order_value") <= 0)]}
    models = {"gold_dim_customers": star.gold_dim_customers(s), "silver_fact_reviews": s["silver_fact_reviews"],
              "gold_fct_orders": star.gold_fct_orders(s)}
    return Q.suite([Q.dq_checks(models[m], m, checks) for m, checks in tests.items()])


FRESHNESS_NOW = "2001-08-03 12:00:00"


@key("dq_source_freshness", f"""
SELECT 'fact_order' AS model, 'freshness' AS test, 'order_purchase_timestamp' AS "column",
       MAX(order_purchase_timestamp) AS max_loaded_at,
       date_diff('second', MAX(order_purchase_timestamp), TIMESTAMP '{FRESHNESS_NOW}') / 3600.0 AS age_hours,
       CASE WHEN date_diff('second', MAX(order_purchase_timestamp), TIMESTAMP '{FRESHNESS_NOW}') / 3600.0 > 48 THEN 'error'
            WHEN date_diff('second', MAX(order_purchase_timestamp), TIMESTAMP '{FRESHNESS_NOW}') / 3600.0 > 24 THEN 'warn'
            ELSE 'pass' END AS status
FROM fact_order""", "fact_order")
def dq_source_freshness(spark, sf_dir, now: str = FRESHNESS_NOW):
    return Q.dq_source_freshness(Tables(spark, sf_dir)["fact_order"], "fact_order", "order_purchase_timestamp", now)


# ====================================================================== upsert and table edits
FCT_SQL = "SELECT * REPLACE (array_to_string(payment_types, ',') AS payment_types) FROM gold_fct_orders"


def _fct(raw) -> DataFrame:
    return star.gold_fct_orders(SilverTables(raw)).withColumn("payment_types", F.array_join("payment_types", ","))


def _orders_window(raw, days: int, newer: bool) -> dict:
    """The raw tables with the order table cut at ``max(purchase) - days``; orders without a
    purchase timestamp are on the older side. Of the newer side, a small part of the orders, only
    these orders' items, payments and reviews are kept."""
    o = raw["fact_order"]
    cut = o.agg(F.max("order_purchase_timestamp") - F.make_interval(days=F.lit(days))).scalar()
    scoped = {n: raw[n] for n in raw}
    ts = F.col("order_purchase_timestamp")
    scoped["fact_order"] = o.where(ts >= cut) if newer else o.where((ts < cut) | ts.isNull())
    if newer:
        ids = scoped["fact_order"].select("order_id").hint("shuffle_hash")
        for name in FACTS_BY_ORDER:
            scoped[name] = raw[name].join(ids, "order_id", "left_semi").select(raw[name].columns)
    return scoped


@key("upsert_delete_insert", FCT_SQL, "gold_fct_orders")
def upsert_delete_insert(spark, sf_dir):
    raw = Tables(spark, sf_dir)
    first_run = _fct(_orders_window(raw, 30, newer=False))   # the table as an earlier run left it
    batch = _fct(_orders_window(raw, 40, newer=True))        # the new run overlaps it by ten days
    root = scratch_path(spark, "fct")
    V.create(first_run, root, ["order_id"])
    V.upsert(batch, root, ["order_id"])
    return V.read(spark, root)


@key("dedup_replacing", "SELECT * EXCLUDE (payment_types_text) REPLACE (array_to_string(payment_types, ',') AS payment_types) "
     "FROM star_order_details", "star_order_details")
def dedup_replacing(spark, sf_dir):
    s = SilverTables(Tables(spark, sf_dir))
    older = star._order_details(s, False).withColumn("_version", F.lit(1))
    newer = star.gold_fct_orders(s).withColumn("_version", F.lit(2))
    out = U.dedup_replacing(older.unionByName(newer), ["order_id"], "_version").drop("_version")
    return out.withColumn("payment_types", F.array_join("payment_types", ","))


@key("incremental_watermark_filter", """
SELECT order_id, order_purchase_timestamp FROM fact_order
WHERE order_purchase_timestamp > (SELECT MAX(order_purchase_timestamp) FROM fact_order
    WHERE order_purchase_timestamp < (SELECT MAX(order_purchase_timestamp) - INTERVAL 30 DAY FROM fact_order))""",
     "fact_order")
def incremental_watermark_filter(spark, sf_dir):
    raw = Tables(spark, sf_dir)
    target_path = K.write_parquet(_orders_window(raw, 30, newer=False)["fact_order"], scratch_path(spark, "orders-t"))
    target = spark.read.parquet(target_path)
    return U.incremental_filter(raw["fact_order"], target, "order_purchase_timestamp").select(
        "order_id", "order_purchase_timestamp")


INSERTED_SQL = """
SELECT CAST(p_partkey + 1000000 AS INTEGER) AS id_produk, lower(p_type) AS nama_produk,
       CAST(0.0 AS DECIMAL(12,2)) AS harga, p_size AS stok, CAST(NULL AS TIMESTAMP) AS tanggal_ditambahkan FROM part"""


@key("dml_insert", "SELECT * FROM manual_products UNION ALL " + INSERTED_SQL, "manual_products")
def dml_insert(spark, sf_dir):
    t = Tables(spark, sf_dir)
    new_rows = read_base(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1000000).cast("int").alias("id_produk"), F.lower("p_type").alias("nama_produk"),
        F.col("p_size").alias("stok"))
    return U.dml_insert(_manual_products(t), new_rows, schemas.MANUAL_PRODUCT_DEFAULTS)


@key("dml_update", """
SELECT id_produk, nama_produk,
       CASE WHEN nama_produk LIKE '%brass%' THEN CAST(320000.00 AS DECIMAL(12,2)) ELSE harga END AS harga,
       CASE WHEN nama_produk LIKE '%brass%' THEN 10 ELSE stok END AS stok, tanggal_ditambahkan
FROM manual_products""", "manual_products")
def dml_update(spark, sf_dir):
    m = _manual_products(Tables(spark, sf_dir))
    return U.dml_update(m, F.col("nama_produk").like("%brass%"), {"stok": F.lit(10), "harga": F.lit(320000.00)})


@key("dml_delete", "SELECT * FROM manual_products WHERE NOT COALESCE(nama_produk LIKE '%tin%', FALSE)",
     "manual_products")
def dml_delete(spark, sf_dir):
    m = _manual_products(Tables(spark, sf_dir))
    return U.dml_delete(m, F.col("nama_produk").like("%tin%"))


LAYER_MODELS = ("gold_dim_customers", "gold_dim_products", "gold_dim_sellers", "gold_fct_orders")


# Sort keys of the stored models, as the source's models declare them.
SORT_KEYS = {"silver_dim_customers": ["customer_id"], "silver_dim_sellers": ["seller_id"], "silver_dim_products": ["product_id"],
             "silver_fact_orders": ["order_id"], "silver_fact_order_items": ["order_id", "order_item_id"],
             "silver_fact_payments": ["order_id", "payment_sequential"], "silver_fact_reviews": ["review_id"],
             "gold_dim_customers": ["customer_id"], "gold_dim_products": ["product_id"], "gold_dim_sellers": ["seller_id"]}
STAR_NEEDS = {"gold_dim_customers": ["silver_dim_customers", "silver_fact_orders", "silver_fact_payments", "silver_fact_reviews"],
              "gold_dim_products": ["silver_dim_products", "silver_fact_order_items"],
              "gold_dim_sellers": ["silver_dim_sellers", "silver_fact_order_items", "silver_fact_reviews"],
              "gold_fct_orders": ["silver_fact_orders", "silver_fact_order_items", "silver_fact_payments", "silver_fact_reviews"]}


def layer_models(raw) -> list[R.Model]:
    """The silver models over the raw tables and the star schema over the stored silver tables;
    the order fact is incremental by ``order_id``."""
    silver = [R.Model("silver", n, lambda _, n=n: SILVER_MODELS[n](raw), sort_keys=SORT_KEYS[n]) for n in SILVER_MODELS]
    gold = [R.Model("gold", n, star.STAR_MODELS[n], needs=STAR_NEEDS[n], sort_keys=SORT_KEYS.get(n, ()),
                    unique_key=["order_id"] if n == "gold_fct_orders" else ()) for n in LAYER_MODELS]
    return [*silver, *gold]


@key("run_layers", "\nUNION ALL ".join(
    [f"SELECT 'silver' AS layer, '{m}' AS model, 'ok' AS status, COUNT(*) AS rows FROM {m}" for m in SILVER_MODELS]
    + [f"SELECT 'gold' AS layer, '{m}' AS model, 'ok' AS status, COUNT(*) AS rows FROM {m}" for m in LAYER_MODELS]),
    *SILVER_MODELS, *LAYER_MODELS)
def run_layers(spark, sf_dir):
    report = R.run(spark, scratch_path(spark, "layers"), layer_models(Tables(spark, sf_dir)))
    return spark.createDataFrame(report, R.REPORT)


# ====================================================================== cleaning jobs (P1-P5)
@key("products_clean", f"""
WITH m AS (SELECT MEDIAN(price) AS med FROM landed_products),
filled AS (SELECT id, title, COALESCE(price, (SELECT med FROM m)) AS price, CAST(COALESCE(stock, 0) AS BIGINT) AS stock,
                  COALESCE(category, 'other') AS category, COALESCE(rating, 0.0) AS rating FROM landed_products)
SELECT id AS id_produk, upper(title) AS nama_produk, price AS harga, stock AS stok, category AS kategori,
       rating AS skor_rating FROM filled WHERE rating >= 4.0""", "landed_products")
def products_clean(spark, sf_dir):
    return P.products_clean(S.read_json_envelope(spark, _pages(spark, sf_dir)))


@key("products_filter_first", """
SELECT id AS id_produk, upper(title) AS nama_produk, price AS harga, stock AS stok, category AS kategori,
       rating AS skor_rating FROM landed_products WHERE rating >= 4.0""", "landed_products")
def products_filter_first(spark, sf_dir):
    return P.products_filter_first(S.read_json_envelope(spark, _pages(spark, sf_dir)))


@key("items_unit_price", """
WITH rows AS (
    SELECT order_id * 100 + order_item_id AS idx,
           CASE WHEN product_id % 7 = 0 THEN NULL ELSE 'product_' || CAST(product_id AS VARCHAR) END AS nama,
           price * order_item_id AS harga_total,
           CASE WHEN order_item_id % 4 = 0 THEN 0.0 WHEN order_item_id % 5 = 0 THEN NULL
                ELSE CAST(order_item_id AS DOUBLE) END AS jumlah
    FROM fact_order_item),
st AS (
    SELECT *, CASE WHEN harga_total IS NULL THEN 'missing_field' WHEN jumlah IS NULL THEN 'missing_field'
                   WHEN jumlah = 0 THEN 'zero_divisor' ELSE 'ok' END AS status FROM rows)
SELECT idx, COALESCE(nama, 'Barang_Tanpa_Nama_' || CAST(idx AS VARCHAR)) AS nama, status,
       CASE WHEN harga_total IS NULL THEN 'harga_total' WHEN jumlah IS NULL THEN 'jumlah' END AS missing_column,
       CASE WHEN status = 'ok' THEN harga_total / jumlah END AS harga_satuan,
       CASE WHEN status = 'ok' THEN format('{:,.2f}', harga_total / jumlah) END AS harga_satuan_text
FROM st""", "fact_order_item")
def items_unit_price(spark, sf_dir):
    return P.items_unit_price(P.item_rows_from_order_items(Tables(spark, sf_dir)["fact_order_item"]))


ITEM_ROWS_SQL = """
WITH rows AS (
    SELECT order_id * 100 + order_item_id AS idx,
           CASE WHEN product_id % 7 = 0 THEN NULL ELSE 'product_' || CAST(product_id AS VARCHAR) END AS nama,
           price * order_item_id AS harga_total,
           CASE WHEN order_item_id % 4 = 0 THEN 0.0 WHEN order_item_id % 5 = 0 THEN NULL
                ELSE CAST(order_item_id AS DOUBLE) END AS jumlah
    FROM fact_order_item)"""


@key("safe_unit_price", ITEM_ROWS_SQL + """
SELECT idx, CASE WHEN harga_total IS NULL OR jumlah IS NULL THEN 'missing_field' WHEN jumlah = 0 THEN 'zero_divisor'
                 ELSE 'ok' END AS status,
       CASE WHEN harga_total IS NOT NULL AND jumlah IS NOT NULL AND jumlah <> 0 THEN harga_total / jumlah END AS harga_satuan
FROM rows""", "fact_order_item")
def safe_unit_price(spark, sf_dir):
    out = P.items_unit_price(P.item_rows_from_order_items(Tables(spark, sf_dir)["fact_order_item"]))
    return out.select("idx", "status", "harga_satuan")


@key("default_name", ITEM_ROWS_SQL + """
SELECT idx, COALESCE(nama, 'Barang_Tanpa_Nama_' || CAST(idx AS VARCHAR)) AS nama FROM rows""", "fact_order_item")
def default_name(spark, sf_dir):
    out = P.items_unit_price(P.item_rows_from_order_items(Tables(spark, sf_dir)["fact_order_item"]))
    return out.select("idx", "nama")


@key("posts_clean", """
SELECT doc_id AS author_id, source AS title, text AS body, length(text) AS body_length FROM documents
WHERE source IS NOT NULL AND text IS NOT NULL AND length(text) > 50""")
def posts_clean(spark, sf_dir):
    posts = P.posts_from_documents(read_base(spark, sf_dir, "documents"))
    clean = P.posts_clean(posts)
    return _written(spark, *K.write_with_csv_fallback(clean, scratch_path(spark, "posts")), clean.schema)


def _profile_sql(table_sql: str, cols: list[tuple[str, str]]) -> str:
    parts = [f"SELECT '{c}' AS \"column\", '{t}' AS type, COUNT({c}) AS non_null, COUNT(*) AS rows FROM ({table_sql})"
             for c, t in cols]
    return "\nUNION ALL ".join(parts)


FACT_ORDER_TYPES = [("order_id", "bigint"), ("customer_id", "bigint"), ("order_status", "string")] + [
    (c, "timestamp_ntz") for c in ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                                   "order_delivered_customer_date", "order_estimated_delivery_date")]


@key("profile_columns", _profile_sql("SELECT * FROM fact_order", FACT_ORDER_TYPES), "fact_order")
def profile_columns(spark, sf_dir):
    return P.profile_columns(Tables(spark, sf_dir)["fact_order"])


WEATHER_TYPES = [("time", "timestamp_ntz"), ("temp_c", "double"), ("feelslike_c", "double"), ("humidity", "bigint"),
                 ("pressure_mb", "double"), ("wind_kph", "double"), ("wind_degree", "bigint"), ("wind_dir", "string"),
                 ("cloud", "bigint"), ("precip_mm", "double"), ("vis_km", "double"), ("uv", "double"),
                 ("is_day", "bigint"), ("condition_text", "string"), ("condition_code", "bigint"),
                 ("chance_of_rain", "bigint"), ("will_it_rain", "bigint")]
FORECAST_TYPES = [("station", "bigint"), ("date", "timestamp_ntz"), ("temperature_2m", "float"), ("rain", "float"),
                  ("relative_humidity_2m", "float"), ("weather_code", "float")]


@key("weather_hourly", _profile_sql(WEATHER_SQL, WEATHER_TYPES))
def weather_hourly(spark, sf_dir):
    return P.profile_columns(_weather(spark, sf_dir))


@key("forecast_hourly", _profile_sql(FORECAST_SQL, FORECAST_TYPES))
def forecast_hourly(spark, sf_dir):
    return P.profile_columns(_forecast(spark, sf_dir))


# ====================================================================== streaming
@key("stream_incremental_orders", FCT_SQL, "gold_fct_orders")
def stream_incremental_orders(spark, sf_dir):
    raw = Tables(spark, sf_dir)
    landed = land_orders_by_month(raw["fact_order"], scratch_path(spark, "orders-drop"))
    target = run_order_stream(spark, {n: raw[n] for n in raw}, landed, scratch_path(spark, "fct-stream"),
                              scratch_path(spark, "fct-stream-ckpt"), files_per_trigger=32)
    return current_fact(spark, target).withColumn("payment_types", F.array_join("payment_types", ","))
