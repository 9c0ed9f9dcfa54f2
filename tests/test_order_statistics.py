"""Medians by rank selection, numbers by borders, dense ranks by lists of best values."""

import random
import statistics

import pytest
from pyspark.sql import Window, functions as F

from terrace.functions import stats
from terrace.functions.stats import exact_median, global_row_number, ranked, top_distinct_ranked


def median(spark, values, **kw):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    return exact_median(df, "v", **kw).first()["median"]


@pytest.mark.parametrize("limit", [5, 50_000])
def test_median_of_hostile_columns(spark, limit):
    rng = random.Random(2)
    columns = [[1.5], [1.0, 2.0], [rng.random() for _ in range(3001)], [rng.expovariate(1e-6) ** 3 for _ in range(3000)],
               [7.0] * 2000 + [rng.random() * 14 for _ in range(1500)], [0.0] * 1000 + [1.0] * 1000, [-5.0, 5.0] * 700 + [None] * 900,
               [float(i % 3) for i in range(2999)], [1e300, -1e300] * 600 + [0.0]]
    for values in columns:
        want = statistics.median([v for v in values if v is not None])
        assert median(spark, values, limit=limit, buckets=16) == want, len(values)
    assert median(spark, [None, None], limit=limit) is None and median(spark, [], limit=limit) is None


def test_median_of_a_continuous_column_sorts_a_fixed_number(spark, monkeypatch):
    df = spark.range(0, 400_000, 1, 8).select((F.xxhash64("id") / 3.0).alias("v"))
    rounds = []
    keep = stats.materialize
    monkeypatch.setattr(stats, "materialize", lambda d: (rounds.append(d.count()), keep(d))[1])
    want = df.agg(F.expr("percentile(v, 0.5)")).first()[0]
    assert exact_median(df, "v", limit=100).first()[0] == want
    assert len(rounds) >= 2 and rounds[0] < 400_000 / 50 and rounds[-1] <= rounds[0] / 50


def table(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a"] * 8 + ["b", "c", None, "d"]), rng.choice([None, 1.0, 2.0, 2.0, 3.5] + [rng.random()] * 3), i) for i in range(3000)]
    rows += [("only", None, 5000 + i) for i in range(400)] + [("z", 1.0, 9000)]
    return spark.createDataFrame(rows, "k string, v double, id long").repartition(5)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_numbers_ranks_and_leads_equal_windows(spark, partitions):
    df = table(spark)
    order = [F.col("v").desc_nulls_first(), F.col("id")]
    got = ranked(df, ["k"], order, ["v"], row_number="n", rank="r", lead=("v", "next"), partitions=partitions)
    w = Window.partitionBy("k").orderBy(*order)
    want = df.select("*", F.row_number().over(w).cast("bigint").alias("n"),
                     F.rank().over(Window.partitionBy("k").orderBy(order[0])).cast("bigint").alias("r"), F.lead("v").over(w).alias("next"))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan  # one range exchange, behind the checkpoint
    only = ranked(df, ["k"], order, ["v"], rank="r", partitions=partitions)
    assert only.columns == ["k", "v", "id", "r"]
    assert ranked(df.limit(0), ["k"], order, ["v"], rank="r", partitions=partitions).collect() == []


def test_numbers_over_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_numbers_ranks_and_leads_equal_windows(spark, 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_global_row_number_takes_one_exchange(spark):
    df = table(spark)
    got = global_row_number(df, [F.col("v").desc_nulls_first(), F.col("id")], "n", partitions=6)
    want = df.select("*", F.row_number().over(Window.orderBy(F.col("v").desc_nulls_first(), F.col("id"))).cast("bigint").alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_pid" not in plan.replace("#", "").split("BroadcastExchange")[0]


@pytest.mark.parametrize("k", [1, 3])
def test_top_distinct_equals_dense_rank(spark, k):
    df = table(spark)
    w = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_first())
    want = df.withColumn("r", F.dense_rank().over(w).cast("bigint")).where(F.col("r") <= k)
    got = top_distinct_ranked(df, ["k"], "v", k, "r")
    assert sorted(map(str, got.select("k", "v", "id", "r").collect())) == sorted(map(str, want.collect()))
