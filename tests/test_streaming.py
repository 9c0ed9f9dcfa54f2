"""The incremental order stream: restart with the same checkpoint continues correctly."""

import os

from pyspark.sql import functions as F

from scripts.check_oracle import canon
from terrace.functions.exprs import year_month
from terrace.plans import silver, star
from terrace.sources.fixtures import Tables
from terrace.streaming.incremental import current_fact, current_versions, stream_incremental_orders

SF = "/root/testdata/sf0.001"


def same_rows(got, want):
    """Equal rows; sums of doubles may differ in the last digits."""
    got = got.select(want.columns)
    return canon(got.columns, got.collect()) == canon(want.columns, want.collect())


def test_stream_restart_matches_batch(spark, tmp_dir):
    raw = Tables(spark, SF)
    tables = {n: raw[n] for n in raw}
    orders = tables["fact_order"].withColumn("ym", year_month("order_purchase_timestamp"))
    landed, target, ckpt = (os.path.join(tmp_dir, x) for x in ("landed", "target", "ckpt"))
    early = orders.where(F.year("order_purchase_timestamp") < 1998)
    early.write.partitionBy("ym").parquet(landed)
    stream_incremental_orders(spark, tables, landed, target, ckpt, files_per_trigger=40)
    assert current_fact(spark, target).count() == star.gold_fct_orders(
        silver.SilverTables({**tables, "fact_order": early.drop("ym")})).count()
    # More files land; a new query on the same checkpoint processes only the new ones.
    orders.where(F.year("order_purchase_timestamp") >= 1998).write.mode("append").partitionBy("ym").parquet(landed)
    before = current_versions(spark, target)
    stream_incremental_orders(spark, tables, landed, target, ckpt, files_per_trigger=40)
    after = current_versions(spark, target)
    # Months the second run did not touch keep the version the first run wrote.
    assert all(after[m] == v for m, v in before.items() if m < "199801")
    assert set(after) > set(before)
    want = star.gold_fct_orders(silver.SilverTables(tables))
    got = current_fact(spark, target)
    assert got.count() == want.count()
    assert same_rows(got, want)


def _ends_as_batch(spark, tables, target, orders):
    want = star.gold_fct_orders(silver.SilverTables({**tables, "fact_order": orders}))
    got = current_fact(spark, target)
    assert same_rows(got, want)
    return got


def test_orders_that_move_between_months_are_stored_once(spark, tmp_dir):
    raw = Tables(spark, SF)
    tables = {n: raw[n] for n in raw}
    orders = tables["fact_order"].where("year(order_purchase_timestamp) = 1995 AND month(order_purchase_timestamp) < 5")
    landed, target, ckpt = (os.path.join(tmp_dir, x) for x in ("landed", "target", "ckpt"))
    late = F.col("order_id") % 3 == 0
    undated = orders.withColumn("order_purchase_timestamp", F.when(~late, F.col("order_purchase_timestamp")))

    def land(df, ym):
        df.withColumn("ym", ym).write.mode("append").partitionBy("ym").parquet(landed)
        stream_incremental_orders(spark, tables, landed, target, ckpt, index_buckets=5)

    land(undated, F.coalesce(year_month("order_purchase_timestamp"), F.lit("none")))
    _ends_as_batch(spark, tables, target, undated)
    assert "none" in current_versions(spark, target)
    # Their timestamps arrive: the orders leave the bucket without a month, which empties.
    land(orders.where(late), year_month("order_purchase_timestamp"))
    got = _ends_as_batch(spark, tables, target, orders)
    assert got.groupBy("order_id").count().where("count > 1").count() == 0
    assert "none" not in current_versions(spark, target)
    # A corrected timestamp moves orders again; months that the batch does not touch keep their version.
    before = current_versions(spark, target)
    first = orders.agg(F.min("order_id")).first()[0]
    fixed = F.when(F.col("order_id") == first, F.col("order_purchase_timestamp") - F.expr("INTERVAL 60 DAY")).otherwise(F.col("order_purchase_timestamp"))
    moved = orders.withColumn("order_purchase_timestamp", fixed)
    land(moved.where(F.col("order_id") == first), year_month("order_purchase_timestamp"))
    _ends_as_batch(spark, tables, target, moved)
    after = current_versions(spark, target)
    assert len([m for m in before if before[m] != after.get(m)]) <= 2 < len(before)


def test_an_order_that_lands_twice_in_a_batch_counts_once(spark, tmp_dir):
    raw = Tables(spark, SF)
    tables = {n: raw[n] for n in raw}
    orders = tables["fact_order"].where("year(order_purchase_timestamp) = 1996 AND month(order_purchase_timestamp) < 4")
    landed, target, ckpt = (os.path.join(tmp_dir, x) for x in ("landed", "target", "ckpt"))
    undated = orders.withColumn("order_purchase_timestamp", F.lit(None).cast("timestamp_ntz"))
    for df in (undated, orders):
        ym = F.coalesce(year_month("order_purchase_timestamp"), F.lit("none"))
        df.withColumn("ym", ym).write.mode("append").partitionBy("ym").parquet(landed)
    stream_incremental_orders(spark, tables, landed, target, ckpt, files_per_trigger=10_000)
    _ends_as_batch(spark, tables, target, orders)
