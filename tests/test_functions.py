"""Expression helpers and distributed order statistics."""

import random
import statistics

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from terrace.functions import exprs as X
from terrace.functions.stats import exact_median, global_row_number


def test_initcap_word_boundaries(spark):
    df = spark.createDataFrame([("mogi-guacu sao d'oeste",), ("  porto-united states ",), (None,)], "c string")
    out = [r[0] for r in df.select(F.trim(X.initcap_words("c"))).collect()]
    assert out == ["Mogi-Guacu Sao D'Oeste", "Porto-United States", None]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(0,), (3,), (6,), (None,)], "s int")
    assert [r[0] for r in df.select(X.clamp_keep_null("s")).collect()] == [1, 3, 5, None]


def test_round2_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.125,)], "x double")
    assert [r[0] for r in df.select(X.round2("x")).collect()] == [1.01, 2.68, -1.01, 0.13]


def test_integer_ratio_and_safe_ratio(spark):
    df = spark.createDataFrame([(7, 2), (5, 0), (None, 3)], "a long, b long")
    out = df.select(X.integer_ratio("a", "b").alias("i"), X.safe_ratio("a", "b").alias("r")).collect()
    assert [r.i for r in out] == [3, None, None]
    assert [r.r for r in out] == [3.5, None, None]


def test_day_meanings(spark):
    df = spark.createDataFrame([("2024-01-01 23:00:00", "2024-01-02 01:00:00")], "a string, b string") \
        .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    r = df.select(X.elapsed_days("a", "b").alias("e"), X.boundary_days("a", "b").alias("m"),
                  X.hours_between("b", "a").alias("h")).collect()[0]
    assert (r.e, r.m, r.h) == (0, 1, 2.0)


def test_not_canceled_variants(spark):
    df = spark.createDataFrame([("delivered",), ("canceled",), (None,)], "order_status string")
    assert df.where(X.not_canceled()).count() == 1
    assert df.where(X.not_canceled_keep_null()).count() == 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float), st.floats(-1e6, 1e6)), max_size=60))
def test_exact_median_matches_statistics(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_median(df, "x", buckets=8).collect()[0][0]
    clean = [v for v in values if v is not None]
    if not clean:
        assert got is None
    else:
        assert abs(got - statistics.median(clean)) <= 1e-9 * max(1.0, abs(statistics.median(clean)))


def test_exact_median_heavy_duplicates(spark):
    vals = [5.0] * 3000 + [random.random() for _ in range(1001)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert exact_median(df, "x").collect()[0][0] == statistics.median(vals)


def test_global_row_number_with_ties(spark):
    df = spark.range(2000).select("id", (F.col("id") % 13).cast("double").alias("k"))
    out = global_row_number(df, [F.col("k").desc_nulls_first(), F.col("id")], "rn", partitions=5)
    got = [r.id for r in out.orderBy("rn").collect()]
    want = [r.id for r in sorted(df.collect(), key=lambda r: (-r.k, r.id))]
    assert got == want
    assert out.agg(F.min("rn"), F.max("rn")).collect()[0] == (1, 2000)


def test_ranked_matches_window_on_hot_key(spark):
    from pyspark.sql import Window

    from terrace.functions.stats import ranked
    # One key holds most rows; NULL keys and NULL / tied values included.
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 == 9, F.lit(None)).otherwise(
            (F.col("id") % 5).cast("string")).alias("k"),
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise((F.col("id") % 41).cast("double")).alias("v"),
        F.col("id"))
    order = [F.col("v").desc_nulls_first(), F.col("id")]
    got = ranked(df, ["k"], order, ["v"], row_number="rn", rank="rk", lead=("v", "next_v"), partitions=6)
    w = Window.partitionBy("k").orderBy(*order)
    want = df.select("id", F.row_number().over(w).alias("rn"),
                     F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc_nulls_first())).alias("rk"),
                     F.lead("v").over(w).alias("next_v"))
    g = {r.id: (r.rn, r.rk, r.next_v) for r in got.collect()}
    e = {r.id: (r.rn, r.rk, r.next_v) for r in want.collect()}
    assert g == e


def test_time_helpers_ignore_session_time_zone(spark):
    # 1999-10-03 00:00 does not exist on São Paulo wall clocks (DST gap); NTZ math must not care.
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.sql("SELECT timestamp_ntz'1999-10-03 00:00:00' AS a, timestamp_ntz'1999-10-03 01:00:00' AS b")
        r = df.select(X.hours_between("b", "a").alias("h"), X.hours_between_seconds("b", "a").alias("hs"),
                      X.wall_clock_text("a").alias("t"), X.epoch_seconds("a").alias("e"),
                      X.year_month("a").alias("ym"), X.month_start("b").alias("m")).collect()[0]
        assert (r.h, r.hs, r.t, r.e, r.ym) == (1.0, 1.0, "1999-10-03 00:00:00", 938908800, "199910")
        assert str(r.m) == "1999-10-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_cluster_conf_sizes_shuffle_for_the_data():
    from terrace.session import cluster_conf
    conf = cluster_conf(total_cores=8000, shuffle_bytes_tb=20)
    assert int(conf["spark.sql.shuffle.partitions"]) == 81920
    assert conf["spark.sql.adaptive.enabled"] == "true" and conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(total_cores=100000, shuffle_bytes_tb=1)["spark.sql.shuffle.partitions"]) == 300000
