"""Sinks, CSV readers, quality tests and table edits."""

import os
import time

from pyspark.sql import functions as F

from terrace import schemas
from terrace.operators import quality as Q
from terrace.operators import sinks as K
from terrace.operators import upsert as U
from terrace.sources import readers as S


def test_csv_round_trip_with_newline_quote_and_leading_zero(spark, tmp_dir):
    rows = [(1, 10, 5, 'says "great"\nsecond line', None, None, None)]
    reviews = spark.createDataFrame(rows, schemas.RAW_SCHEMAS["fact_order_review"])
    path = os.path.join(tmp_dir, "reviews")
    reviews.write.option("header", True).option("escape", '"').csv(path)
    back = S.read_csv(spark, path, schemas.RAW_SCHEMAS["fact_order_review"], multiline=True).collect()
    assert back[0].review_comment_title == 'says "great"\nsecond line'
    cust = spark.createDataFrame([(1, "u", "01310", "sao paulo", "SP")], schemas.RAW_SCHEMAS["dim_customer"])
    cpath = os.path.join(tmp_dir, "cust")
    cust.write.option("header", True).csv(cpath)
    assert S.read_csv(spark, cpath, schemas.RAW_SCHEMAS["dim_customer"]).collect()[0].customer_zip_code_prefix == "01310"


def test_raw_strings_bad_value_becomes_null(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders.csv")
    with open(path, "w") as f:
        f.write("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
                "1,2,delivered,2024-01-01 10:00:00,not-a-date,,,\n")
    r = S.read_csv_raw_strings(spark, path, "fact_order").collect()[0]
    assert r.order_approved_at is None and r.order_purchase_timestamp.hour == 10


def test_normalize_types(spark):
    df = spark.createDataFrame([(1, 2.5, True, "x")], "a int, b float, c boolean, d string") \
        .withColumn("t", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    out = dict(K.normalize_types(df).dtypes)
    assert out == {"a": "bigint", "b": "double", "c": "boolean", "d": "string", "t": "string"}


def test_ingest_report_counts_missing_file(spark, tmp_dir):
    raw = {t: spark.createDataFrame([], schemas.RAW_SCHEMAS[t]) for t in schemas.RAW_SCHEMAS}
    raw["fact_order"] = spark.createDataFrame([(1, 2, "delivered", None, None, None, None, None)],
                                              schemas.RAW_SCHEMAS["fact_order"])
    from terrace.sources.landing import land_csv
    land_csv(raw["fact_order"], os.path.join(tmp_dir, "csv", "olist_orders_dataset.csv"))
    rep = {r.table_name: r for r in K.ingest_catalog(spark, os.path.join(tmp_dir, "csv"), os.path.join(tmp_dir, "pq"),
                                                      S.read_csv_parse_dates).collect()}
    assert rep["fact_order"].status == "ok" and rep["fact_order"].rows == 1
    assert rep["dim_customer"].status == "missing"


def test_manual_products_insert_update_delete(spark):
    base = spark.createDataFrame([], schemas.MANUAL_PRODUCT)
    new = spark.createDataFrame([(101, "Laptop", 15000000.0, 5), (102, "Mouse", None, 50), (103, "Keyboard", 1.0, 1)],
                                "id_produk int, nama_produk string, harga double, stok int")
    t = U.dml_insert(base, new, schemas.MANUAL_PRODUCT_DEFAULTS)
    assert {r.id_produk: float(r.harga) for r in t.collect()}[102] == 0.0
    t = U.dml_update(t, F.col("id_produk") == 102, {"stok": F.lit(10), "harga": F.lit(320000.00)})
    t = U.dml_delete(t, F.col("id_produk") == 103)
    rows = {r.id_produk: r for r in t.collect()}
    assert sorted(rows) == [101, 102] and rows[102].stok == 10 and float(rows[102].harga) == 320000.0


def test_delete_keeps_null_predicate(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert sorted(r.k for r in U.dml_delete(df, F.col("v") == "a").collect()) == [2]


def test_upsert_is_idempotent(spark, tmp_dir):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "order_id long, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "order_id long, v string")
    once = U.upsert_delete_insert(target, batch, ["order_id"])
    twice = U.upsert_delete_insert(once, batch, ["order_id"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "B"), (3, "C")]


def test_dedup_replacing_keeps_latest(spark):
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "only", 1)], "k long, v string, ver int")
    assert sorted(tuple(r) for r in U.dedup_replacing(df, ["k"], "ver").collect()) == [(1, "new", 2), (2, "only", 1)]


def test_dedup_replacing_breaks_ties_by_insertion(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    schema = "k long, v string, tags array<string>, ver int"
    for v in ("z", "m", None, "a"):  # each write is a later insertion
        spark.createDataFrame([(1, v, ["x"], 1), (2, "old", None, 0)], schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    stored = spark.read.parquet(path)
    got = U.dedup_replacing(stored.withColumn("seq", U.insertion_sequence()), ["k"], "ver", ["seq"]).drop("seq")
    assert sorted(map(tuple, got.collect())) == [(1, "a", ["x"], 1), (2, "old", None, 0)]
    # Without a sequence the greatest row stays, whatever the order of reading.
    assert {r.k: r.v for r in U.dedup_replacing(stored, ["k"], "ver").collect()} == {1: "z", 2: "old"}


def test_incremental_filter(spark):
    src = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id long, ts long")
    tgt = spark.createDataFrame([(1, 10), (2, 20)], "id long, ts long")
    assert [r.id for r in U.incremental_filter(src, tgt, "ts").collect()] == [3]
    assert U.incremental_filter(src, tgt.limit(0), "ts").count() == 3


def test_quality_suite(spark):
    df = spark.createDataFrame([(1, "delivered", 7), (1, None, 8), (None, "lost", 9)], "id long, status string, fk long")
    parent = spark.createDataFrame([(7,), (8,)], "fk long")
    rep = Q.suite([Q.dq_unique(df, "t", ["id"]), Q.dq_not_null(df, "t", "id"),
                   Q.dq_accepted_values(df, "t", "status", ["delivered"]),
                   Q.dq_relationships(df, "t", "fk", parent, "fk"),
                   Q.dq_singular(df, "t", "fk_small", F.col("fk") < 0)])
    got = {r.test: (r.failing_rows, r.status) for r in rep.collect()}
    assert got == {"unique": (1, "fail"), "not_null": (1, "fail"), "accepted_values": (1, "fail"),
                   "relationships": (1, "fail"), "fk_small": (0, "pass")}


def test_freshness_levels(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    status = lambda now: Q.dq_source_freshness(df, "t", "ts", now).collect()[0].status
    assert status("2024-01-01 12:00:00") == "pass"
    assert status("2024-01-02 06:00:00") == "warn"
    assert status("2024-01-03 06:00:00") == "error"


def test_sorted_and_partitioned_writes(spark, tmp_dir):
    df = spark.range(100).select(F.col("id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, id)")
                                 .alias("ts"))
    p = K.write_partitioned_by_month(df, os.path.join(tmp_dir, "pm"), "ts")
    assert "ym=202401" in os.listdir(p)
    many = df.union(df.limit(5).withColumn("ts", F.expr("timestamp_ntz'2024-02-01 00:00:00'"))).repartition(8)
    p = K.write_partitioned_by_month(many, os.path.join(tmp_dir, "pm2"), "ts")
    files = {m: [f for f in os.listdir(os.path.join(p, m)) if f.endswith(".parquet")] for m in ("ym=202401", "ym=202402")}
    assert all(len(f) == 1 for f in files.values()), files  # one task wrote each month
    s = K.write_sorted(df, os.path.join(tmp_dir, "sorted"), ["id"], partitions=4)
    assert spark.read.parquet(s).count() == 100


def test_csv_fallback_keeps_texts(spark, tmp_dir):
    rows = [(1, 'two\nlines, "quoted"', " outer ", None), (2, "", "x", 1.5), (3, None, '"', -0.25)]
    df = spark.createDataFrame(rows, "id long, body string, title string, v double")
    fmt, path = K.write_with_csv_fallback(df, os.path.join(tmp_dir, "t"), compression="lzo")
    assert fmt == "csv"
    back = S.read_csv(spark, path, df.schema, multiline=True, keep_empty=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_csv_fallback_when_parquet_fails(spark, tmp_dir, monkeypatch):
    def broken(*a, **k):
        raise OSError("parquet writer unavailable")

    monkeypatch.setattr(K, "write_parquet", broken)
    fmt, path = K.write_with_csv_fallback(spark.range(3), os.path.join(tmp_dir, "t"))
    assert fmt == "csv" and spark.read.option("header", True).csv(path).count() == 3
