"""Skew-aware join and aggregation shapes against their plain equivalents."""

from pyspark.sql import functions as F

from terrace.functions.aggregates import distinct_counts, join_on_keys
from terrace.functions.joins import left_join_many


def test_left_join_many_equals_left_join_with_hot_key(spark):
    one = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("a")) \
        .union(spark.createDataFrame([(None, -1)], "k long, a long"))
    # Key 7 holds most of the right side; keys >= 40 have no match.
    many = spark.range(5000).select(F.when(F.col("id") % 10 < 8, F.lit(7)).otherwise(F.col("id") % 40).alias("k"),
                                    F.col("id").alias("b"))
    got = sorted(left_join_many(one, many, ["k"]).select("k", "a", "b").collect(), key=repr)
    want = sorted(one.join(many, "k", "left").select("k", "a", "b").collect(), key=repr)
    assert got == want


def test_distinct_counts_match_count_distinct_including_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "y"), ("a", 2, None), (None, 3, "x"), (None, 3, "x"), ("b", None, None)],
        "g string, v long, w string")
    got = distinct_counts(df, ["g"], {"nv": "v", "nw": "w", "nv_odd": F.when(F.col("v") % 2 == 1, F.col("v"))})
    want = df.groupBy("g").agg(F.countDistinct("v").alias("nv"), F.countDistinct("w").alias("nw"),
                               F.countDistinct(F.when(F.col("v") % 2 == 1, F.col("v"))).alias("nv_odd"))
    assert sorted(got.collect(), key=repr) == sorted(want.select(*got.columns).collect(), key=repr)


def test_join_on_keys_matches_null_to_null(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    assert sorted(join_on_keys(a, b, ["k"]).collect(), key=repr) == sorted([(None, 1, 10), ("x", 2, 20)], key=repr)


def test_small_group_counts_match_with_large_groups_and_null_keys(spark):
    from terrace.functions.aggregates import counts_and_sums, small_group_counts_and_sums

    rows = [(g, i % 3, i % 4 if i % 5 else None, float(i)) for g, n in (("a", 9), ("b", 2), (None, 7), ("c", 1)) for i in range(n)] + [("d", None, None, None)]
    df = spark.createDataFrame(rows, "g string, v int, w int, x double")
    want = df.groupBy("g").agg(F.countDistinct("v").alias("nv"), F.countDistinct("w").alias("nw"), F.sum("x").alias("x"))
    want = sorted(want.collect(), key=repr)
    args = (["g"], {"nv": "v", "nw": "w"}, {"x": "x"})
    for most in (100, 4, 0):
        assert sorted(small_group_counts_and_sums(df, *args, group_rows=most).collect(), key=repr) == want
    assert sorted(counts_and_sums(df, *args).collect(), key=repr) == want


def test_a_shuffled_left_join_sorts_no_rows_of_the_many(spark):
    one, many = spark.range(50).withColumnRenamed("id", "k"), spark.range(500).selectExpr("id % 60 AS k", "id AS b")
    plan = left_join_many(one, many, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
