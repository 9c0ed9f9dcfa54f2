"""Land source files (JSON envelopes, nested documents, CSV) derived from the given tables.

The pipelines read landed files, as they would read an API dump or a file drop. To keep
every registered query driven by the given data, the landed files are produced from it by
distributed writes; each document packs a bounded number of elements (a page of products, a
block of hourly readings), so no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from terrace import schemas
from terrace.functions.exprs import wall_clock_text

PAGE_SIZE = 30       # products per API page
HOURS_PER_DOC = 24   # hourly readings per weather / forecast document
EPOCH_BASE = 1704067200  # 2024-01-01 00:00:00 UTC, start of the synthetic forecast axis


def products_from_parts(part: DataFrame) -> DataFrame:
    """Product records (with gaps) derived from the part table."""
    k = F.col("p_partkey")
    return part.select(
        k.alias("id"), F.col("p_name").alias("title"),
        F.when(k % 11 == 3, F.lit(None)).otherwise(F.col("p_retailprice")).cast("double").alias("price"),
        F.when(k % 7 == 2, F.lit(None)).otherwise(F.col("p_size")).cast("bigint").alias("stock"),
        F.when(k % 13 == 4, F.lit(None)).otherwise(F.lower("p_brand")).alias("category"),
        F.when(k % 17 == 5, F.lit(None)).otherwise((F.col("p_size") % 50) / F.lit(10.0)).alias("rating"))


PRODUCTS_SQL = """
SELECT p_partkey AS id, p_name AS title,
       CAST(CASE WHEN p_partkey % 11 = 3 THEN NULL ELSE p_retailprice END AS DOUBLE) AS price,
       CAST(CASE WHEN p_partkey % 7 = 2 THEN NULL ELSE p_size END AS BIGINT) AS stock,
       CASE WHEN p_partkey % 13 = 4 THEN NULL ELSE lower(p_brand) END AS category,
       CASE WHEN p_partkey % 17 = 5 THEN NULL ELSE (p_size % 50) / 10.0 END AS rating
FROM part"""


def land_product_pages(part: DataFrame, path: str, page_size: int = PAGE_SIZE) -> str:
    """Write API-style pages ``{products:[...], total, skip, limit}`` as JSON Lines."""
    prods = products_from_parts(part)
    total = prods.agg(F.count(F.lit(1))).scalar()
    page = F.floor((F.col("id") - 1) / page_size)
    pages = (prods.groupBy(page.alias("page"))
             .agg(F.sort_array(F.collect_list(F.struct(*[c for c in schemas.PRODUCT.fieldNames()]))).alias("products"))
             .select("products", total.alias("total"), (F.col("page") * page_size).cast("bigint").alias("skip"),
                     F.lit(page_size).cast("bigint").alias("limit")))
    pages.write.mode("overwrite").json(path)
    return path


def _event_blocks(events: DataFrame) -> DataFrame:
    """Events numbered inside fixed-size blocks of consecutive event ids."""
    block = F.floor(F.col("event_id") / HOURS_PER_DOC)
    w = Window.partitionBy(block).orderBy("event_id")
    return events.withColumn("block", block).withColumn("pos", F.row_number().over(w) - 1)


def weather_hours(events: DataFrame) -> DataFrame:
    """Hourly weather readings derived from events (one reading per event)."""
    e = F.col("event_id")
    return events.select(
        "event_id",
        wall_clock_text("ts", minutes_only=True).alias("time"),
        F.col("value").alias("temp_c"), (F.col("value") - 1.5).alias("feelslike_c"),
        (F.col("user_id") % 100).alias("humidity"), (F.lit(1000.0) + F.col("value")).alias("pressure_mb"),
        (F.col("value") / 2).alias("wind_kph"), (e % 360).alias("wind_degree"),
        F.upper(F.substring("event_type", 1, 3)).alias("wind_dir"), (e % 101).alias("cloud"),
        (F.col("value") / 10).alias("precip_mm"), F.lit(10.0).alias("vis_km"), (F.col("value") % 11).alias("uv"),
        F.when(F.hour("ts").between(6, 17), 1).otherwise(0).cast("bigint").alias("is_day"),
        F.struct(F.col("event_type").alias("text"), (F.lit(1000) + e % 7).cast("bigint").alias("code"))
        .alias("condition"),
        (e % 100).alias("chance_of_rain"), F.when(e % 100 >= 50, 1).otherwise(0).cast("bigint").alias("will_it_rain"))


def land_weather_history(events: DataFrame, path: str) -> str:
    """Write weather history documents (JSON Lines). Each document holds the readings of one
    block of events in ``forecastday[0]``; ``forecastday[1]`` repeats them with a shifted
    date and must be ignored by the reader."""
    hours = weather_hours(events).withColumn("block", F.floor(F.col("event_id") / HOURS_PER_DOC))
    hour_struct = F.struct(*[F.col(f) for f in schemas.WEATHER_HOUR.fieldNames()])
    per_block = hours.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("event_id", hour_struct.alias("h")))).alias("hs"))
    day0 = F.struct(F.lit("day0").alias("date"), F.transform("hs", lambda x: x["h"]).alias("hour"))
    day1 = F.struct(F.lit("day1").alias("date"),
                    F.transform("hs", lambda x: x["h"].withField("temp_c", F.lit(-99.0))).alias("hour"))
    docs = per_block.select(
        F.struct(F.concat(F.lit("station-"), F.col("block").cast("string")).alias("name")).alias("location"),
        F.struct(F.array(day0, day1).alias("forecastday")).alias("forecast"))
    docs.write.mode("overwrite").json(path)
    return path


def land_forecast_arrays(events: DataFrame, path: str, zone: str = "Asia/Bangkok") -> str:
    """Write forecast documents: a regular hourly axis per block plus four parallel arrays."""
    b = _event_blocks(events)
    per_block = b.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct(
            "pos", F.col("value").cast("float").alias("t2m"), (F.col("value") / 10).cast("float").alias("rain"),
            (F.col("user_id") % 100).cast("float").alias("rh"), (F.col("event_id") % 4).cast("float").alias("code"))))
        .alias("vals"), F.count(F.lit(1)).alias("n"))
    start = F.lit(EPOCH_BASE) + F.col("block") * HOURS_PER_DOC * 3600
    docs = per_block.select(
        F.col("block").alias("station"), start.cast("bigint").alias("time"),
        (start + F.col("n") * 3600).cast("bigint").alias("time_end"), F.lit(3600).cast("bigint").alias("interval"),
        F.lit(zone).alias("utc_zone"),
        F.transform("vals", lambda v: v["t2m"]).alias("temperature_2m"),
        F.transform("vals", lambda v: v["rain"]).alias("rain"),
        F.transform("vals", lambda v: v["rh"]).alias("relative_humidity_2m"),
        F.transform("vals", lambda v: v["code"]).alias("weather_code"))
    docs.write.mode("overwrite").json(path)
    return path


def land_csv(df: DataFrame, path: str) -> str:
    """Header CSV, quoted as needed (embedded quotes doubled)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    return path


def land_csv_catalog(spark: SparkSession, raw: dict[str, DataFrame], folder: str,
                     catalog=schemas.CSV_CATALOG) -> str:
    """Write each catalog table as a CSV 'file' (a folder of part files) under ``folder``."""
    for _label, fname, table, _cat in catalog:
        land_csv(raw[table], f"{folder.rstrip('/')}/{fname}")
    return folder
