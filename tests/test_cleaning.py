"""Golden tests: the documented outputs of the course pipelines on their literal inputs."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from terrace import schemas
from terrace.plans import cleaning as P
from terrace.sources import readers as S

# The five products of the product API's fallback file.
PRODUCTS = [
    (1, "Essence Mascara Lash Princess", 9.99, 5, "beauty", 4.94),
    (2, "Eyeshadow Palette with Mirror", 19.99, None, "beauty", 3.5),
    (3, "Powder Canister", None, 10, "beauty", 4.0),
    (4, "Red Lipstick", 12.99, 0, None, 4.8),
    (5, "Green Tea Soap", 5.49, 25, "beauty", None),
]


def _envelope(tmp_dir):
    keys = ("id", "title", "price", "stock", "category", "rating")
    doc = {"products": [dict(zip(keys, p)) for p in PRODUCTS], "total": 5, "skip": 0, "limit": 5}
    path = os.path.join(tmp_dir, "products.json")
    with open(path, "w") as f:
        f.write(json.dumps(doc))
    return path


def test_products_clean_golden(spark, tmp_dir):
    df = S.read_json_envelope(spark, _envelope(tmp_dir))
    rows = [tuple(r) for r in P.products_clean(df).orderBy("id_produk").collect()]
    assert rows == [
        (1, "ESSENCE MASCARA LASH PRINCESS", 9.99, 5, "beauty", 4.94),
        (3, "POWDER CANISTER", 11.49, 10, "beauty", 4.0),
        (4, "RED LIPSTICK", 12.99, 0, "other", 4.8),
    ]


def test_products_filter_first_keeps_nulls(spark, tmp_dir):
    df = S.read_json_envelope(spark, _envelope(tmp_dir))
    rows = [tuple(r) for r in P.products_filter_first(df).orderBy("id_produk").collect()]
    assert rows == [
        (1, "ESSENCE MASCARA LASH PRINCESS", 9.99, 5, "beauty", 4.94),
        (3, "POWDER CANISTER", None, 10, "beauty", 4.0),
        (4, "RED LIPSTICK", 12.99, 0, None, 4.8),
    ]


def test_envelope_without_array_gives_no_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty.json")
    with open(path, "w") as f:
        f.write(json.dumps({"total": 0, "skip": 0, "limit": 30}))
    assert S.read_json_envelope(spark, path).count() == 0


def test_fallback_missing_everywhere_raises(spark, tmp_dir):
    import pytest
    with pytest.raises(FileNotFoundError):
        S.read_with_fallback(spark, os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b"))


def test_items_unit_price_golden(spark):
    rows = [(0, "Laptop", 50000000.0, 5.0), (1, "Mouse", 300000.0, 0.0),
            (2, "Keyboard", 1200000.0, None), (3, "Monitor", 15000000.0, 3.0), (4, None, 10.0, 4.0)]
    df = spark.createDataFrame(rows, schemas.ITEM_ROW)
    out = {r.idx: r for r in P.items_unit_price(df).collect()}
    assert out[0].status == "ok" and out[0].harga_satuan_text == "10,000,000.00"
    assert out[1].status == "zero_divisor" and out[1].harga_satuan is None
    assert out[2].status == "missing_field" and out[2].missing_column == "jumlah"
    assert out[3].harga_satuan_text == "5,000,000.00"
    assert out[4].nama == "Barang_Tanpa_Nama_4"


def test_posts_clean_length_boundary(spark):
    rows = [(1, "t", "x" * 50), (2, "t", "y" * 51), (3, None, "z" * 80), (4, "t", None)]
    df = spark.createDataFrame(rows, "userId long, title string, body string")
    out = P.posts_clean(df).collect()
    assert [r.author_id for r in out] == [2] and out[0].body_length == 51


def test_weather_hourly_uses_first_day_only(spark, tmp_dir):
    hour = {"time": "2026-07-17 00:00", "temp_c": 25.1, "feelslike_c": 27.0, "humidity": 80, "pressure_mb": 1009.0,
            "wind_kph": 5.4, "wind_degree": 200, "wind_dir": "SSW", "cloud": 50, "precip_mm": 0.0, "vis_km": 10.0,
            "uv": 0.0, "is_day": 0, "condition": {"text": "Clear", "code": 1000}, "chance_of_rain": 0,
            "will_it_rain": 0}
    later = dict(hour, time="2026-07-17 01:00", temp_c=24.0)
    other_day = dict(hour, time="2026-07-18 00:00", temp_c=-1.0)
    doc = {"location": {"name": "Jakarta"},
           "forecast": {"forecastday": [{"date": "2026-07-17", "hour": [hour, later]},
                                        {"date": "2026-07-18", "hour": [other_day]}]}}
    path = os.path.join(tmp_dir, "w.json")
    with open(path, "w") as f:
        f.write(json.dumps(doc))
    out = S.read_weather_hourly(spark, path).orderBy("time").collect()
    assert len(out) == 2 and len(out[0]) == 17
    assert out[0].time == dt.datetime(2026, 7, 17, 0, 0) and out[0].condition_text == "Clear"
    assert out[0].condition_code == 1000 and out[1].temp_c == 24.0


def test_forecast_arrays_end_exclusive_and_zone(spark, tmp_dir):
    doc = {"station": 1, "time": 1704067200, "time_end": 1704067200 + 3 * 3600, "interval": 3600,
           "utc_zone": "Asia/Bangkok", "temperature_2m": [1.5, 2.5, 3.5], "rain": [0.0, 0.1, 0.2],
           "relative_humidity_2m": [50.0, 60.0, 70.0], "weather_code": [1.0, 2.0, 3.0]}
    empty = dict(doc, station=2, time_end=doc["time"])
    path = os.path.join(tmp_dir, "f.json")
    with open(path, "w") as f:
        f.write(json.dumps(doc) + "\n" + json.dumps(empty) + "\n")
    out = S.read_forecast_arrays(spark, path, "Asia/Bangkok").orderBy("date").collect()
    assert [r.date for r in out] == [dt.datetime(2024, 1, 1, 7), dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 9)]
    assert [r.temperature_2m for r in out] == [1.5, 2.5, 3.5]


def test_profile_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "a long, b string")
    out = {r.column: r for r in P.profile_columns(df).collect()}
    assert out["a"].non_null == 2 and out["b"].non_null == 1 and out["b"].rows == 2 and out["b"].type == "string"


def test_item_rows_keep_every_row(spark):
    items = spark.createDataFrame([(1, 1, 7, 3, 10.0), (1, 4, 8, 3, 10.0), (2, 5, 9, 1, None)],
                                  "order_id long, order_item_id int, product_id long, seller_id long, price double")
    out = {r.idx: r for r in P.items_unit_price(P.item_rows_from_order_items(items)).collect()}
    assert len(out) == 3
    assert out[101].status == "ok" and out[101].nama == "Barang_Tanpa_Nama_101"
    assert out[104].status == "zero_divisor"
    assert out[205].status == "missing_field" and out[205].missing_column == "harga_total"
    assert F is not None


def test_literal_rows_missing_field_is_null(spark):
    rows = [{"idx": 0, "nama": "Laptop", "harga_total": 50000000.0, "jumlah": 5.0},
            {"idx": 2, "nama": "Keyboard", "harga_total": 1200000.0}]
    df = S.literal_rows(spark, rows, schemas.ITEM_ROW)
    assert [r.jumlah for r in df.orderBy("idx").collect()] == [5.0, None]
