"""Versioned tables, file-level upserts and the published layer run."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from scripts.check_oracle import canon
from terrace.operators import layers as R
from terrace.operators import quality as Q
from terrace.operators import versions as V
from terrace.plans import star
from terrace.plans.io_catalog import layer_models
from terrace.plans.silver import SilverTables
from terrace.sources.fixtures import Tables

SF = "/root/testdata/sf0.001"


def paths(spark, root, version):
    return {r.path for r in V.manifest(spark, root, version).collect()}


def test_upsert_rewrites_only_files_that_hold_a_key(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    assert V.create(rows, root, ["k"], partitions=10) == 0
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        runs.add(1)
        yield from batches

    batch = spark.createDataFrame([(5, "new"), (5, "twice"), (2000, "far"), (None, "no key")], "k long, v string").coalesce(1)
    assert V.upsert(batch.mapInArrow(count, batch.schema), root, ["k"], partitions=2) == 1
    got = {(r.k, r.v) for r in V.read(spark, root).collect()}
    assert got == {(i, "old") for i in range(1000) if i != 5} | {(5, "new"), (5, "twice"), (2000, "far"), (None, "no key")}
    before, after = paths(spark, root, 0), paths(spark, root, 1)
    assert len(before) == 10 and len(before - after) == 1  # nine files live on untouched
    assert V.read(spark, root, 0).where("v = 'old'").count() == 1000  # the old version is still there
    # A key that lies in a file's range but in none of its rows rewrites nothing.
    gap = spark.range(0, 100, 10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    other = os.path.join(tmp_dir, "gap")
    V.create(gap, other, ["k"], partitions=2)
    V.upsert(spark.createDataFrame([(15, "y")], "k long, v string"), other, ["k"])
    assert paths(spark, other, 0) < paths(spark, other, 1)
    assert sorted(r.k for r in V.read(spark, other).collect()) == sorted([*range(0, 100, 10), 15])


def test_upsert_twice_is_the_same_and_empty_batches_change_nothing(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    schema = "d date, n int, v string"
    day = dt.date(2024, 1, 1)
    V.create(spark.createDataFrame([(day, 1, "a"), (day, 2, "b"), (None, 1, "c")], schema), root, ["d", "n"])
    batch = spark.createDataFrame([(day, 2, "B"), (day, 3, "C")], schema)
    for _ in range(2):
        V.upsert(batch, root, ["d", "n"])
        assert sorted(map(str, V.read(spark, root).collect())) == sorted(map(str, spark.createDataFrame(
            [(day, 1, "a"), (day, 2, "B"), (day, 3, "C"), (None, 1, "c")], schema).collect()))
    before = paths(spark, root, 2)
    V.upsert(batch.limit(0), root, ["d", "n"])
    assert before <= paths(spark, root, 3) and V.read(spark, root).count() == 4
    empty = os.path.join(tmp_dir, "e")
    V.create(batch.limit(0), empty, ["d", "n"])
    assert V.read(spark, empty).collect() == []
    V.upsert(batch, empty, ["d", "n"])
    assert V.read(spark, empty).count() == 2


def test_a_version_without_manifest_is_never_seen(spark, tmp_dir, monkeypatch):
    root = os.path.join(tmp_dir, "t")
    V.create(spark.range(10).withColumnRenamed("id", "k"), root, ["k"])
    monkeypatch.setattr(V, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError):
        V.upsert(spark.range(5, 20).withColumnRenamed("id", "k"), root, ["k"])
    monkeypatch.undo()
    assert V.newest(spark, root) == 0 and V.read(spark, root).count() == 10
    V.upsert(spark.range(5, 20).withColumnRenamed("id", "k"), root, ["k"])
    assert V.read(spark, root).count() == 20
    with pytest.raises(Exception, match="(?i)exist"):
        V.publish(V.manifest(spark, root), root, 1)  # two writers of a version cannot both succeed


def test_a_failing_model_leaves_the_old_run_current(spark, tmp_dir):
    root = os.path.join(tmp_dir, "layers")
    value = {"n": 3, "fail": False}

    def broken(inputs):
        if value["fail"]:
            raise ValueError("no such column\nand more")
        return inputs["a"].withColumn("b", F.lit(value["n"]))

    models = [R.Model("gold", "c", lambda i: i["b"].agg(F.count(F.lit(1)).alias("n")), needs=["b"]),
              R.Model("gold", "b", broken, needs=["a"], sort_keys=["id"]),
              R.Model("silver", "a", lambda i: spark.range(value["n"]), tests={"small": F.col("id") > 100}),
              R.Model("silver", "src", lambda i: i["raw"].where("id > 1"), needs=["raw"]),
              R.Model("gold", "f", lambda i: i["src"].withColumn("v", F.lit(value["n"])), needs=["src"], unique_key=["id"])]
    sources = {"raw": spark.range(4)}
    report = R.run(spark, root, models, sources)
    assert report == [("gold", "c", "ok", 1), ("gold", "b", "ok", 3), ("silver", "a", "ok", 3), ("silver", "src", "ok", 2), ("gold", "f", "ok", 2)]
    value.update(n=5, fail=True)
    with pytest.raises(R.LayerRunError, match="gold.b: error: ValueError: no such column") as e:
        R.run(spark, root, models, {"raw": spark.range(3, 9)})
    assert [r[2] for r in e.value.report] == ["skipped: needs b", "error: ValueError: no such column", "ok", "ok", "ok"]
    assert R.read_model(spark, root, "a").count() == 3 and R.read_model(spark, root, "c").first().n == 3
    assert sorted(map(tuple, R.read_model(spark, root, "f").collect())) == [(2, 3), (3, 3)]
    value.update(n=200, fail=False)  # a failing test counts as a failure too
    with pytest.raises(R.LayerRunError, match=r"silver.a: error: ValueError: failed tests: small \(99 rows\)"):
        R.run(spark, root, models, sources)
    assert R.read_model(spark, root, "a").count() == 3
    value.update(n=7)
    R.run(spark, root, models, {"raw": spark.range(3, 5)})
    # The incremental model keeps rows that the batch does not replace, and knows nothing of failed runs.
    assert sorted(map(tuple, R.read_model(spark, root, "f").collect())) == [(2, 3), (3, 7), (4, 7)]
    assert R.read_model(spark, root, "a").count() == 7
    R.run(spark, root, models, {"raw": spark.range(3, 5)}, full_refresh=True)
    assert sorted(map(tuple, R.read_model(spark, root, "f").collect())) == [(3, 7), (4, 7)]
    for bad in ([R.Model("s", "x", broken, needs=["nowhere"])], [R.Model("s", "x", broken, needs=["y"]), R.Model("s", "y", broken, needs=["x"])]):
        with pytest.raises(ValueError):
            R.run(spark, root, bad)


def test_layers_of_the_shop_incrementally(spark, tmp_dir):
    raw = dict(Tables(spark, SF).items())
    root = os.path.join(tmp_dir, "shop")
    early = {**raw, "fact_order": raw["fact_order"].where("order_purchase_timestamp < '1996-01-01'")}
    R.run(spark, root, layer_models(early))
    late = {**raw, "fact_order": raw["fact_order"].where("order_purchase_timestamp >= '1995-06-01'")}
    R.run(spark, root, layer_models(late))
    want = star.gold_fct_orders(SilverTables(raw))
    got = R.read_model(spark, root, "gold_fct_orders").select(want.columns)
    assert canon(got.columns, got.collect()) == canon(want.columns, want.collect())  # sums of doubles may differ in the last digits
    row = R.current(spark, root)["silver_fact_order_items"]
    order = [r.order_id for r in spark.read.parquet(row.path).limit(50).collect()]
    assert order == sorted(order)


def test_several_checks_in_one_scan(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (None, "c", 7), (None, "d", 7), (2, None, -1)], "id long, s string, n int")
    checks = [("not_null", "s", F.col("s").isNull()), ("positive", "n", F.col("n") < 0)]
    want = {"not_null": (1, "fail"), "positive": (1, "fail"), "unique": (1, "fail")}
    got = Q.dq_checks(df, "m", checks, keys=["id"])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert {r.test: (r.failing_rows, r.status) for r in got.collect()} == want
    del want["unique"]
    assert {r.test: (r.failing_rows, r.status) for r in Q.dq_checks(df, "m", checks).collect()} == want
    assert [r.failing_rows for r in Q.dq_checks(df.limit(0), "m", checks, keys=["id"]).collect()] == [0, 0, 0]
