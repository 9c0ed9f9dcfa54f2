"""Incremental order fact with Structured Streaming.

The periodic re-run of the order fact becomes a stream over landed order files: a declared
schema, ``trigger(availableNow=True)`` (process what has landed, then stop) and
``foreachBatch`` that rebuilds the fact rows of the orders in each micro-batch and upserts
them (delete + insert on ``order_id``) into the stored fact.

Storage: the fact is kept per purchase month, and beside it a key-location index (order_id ->
month) in buckets by hash of the order. A micro-batch rewrites only the months and index buckets
it touches: it stores its fact rows once (``staged/v<batch>``), finds in the index where its
orders lie, replaces them in the current version of these months, and writes them in one
partitioned job to ``data/v<batch>/ym=<month>`` (and ``index/v<batch>/kb=<bucket>``). An order
that moves to another month, because its purchase timestamp arrives late or is corrected, is so
removed from its old one. After the data is written, a small marker ``committed/v<batch>`` lists
the parts and their rows; the current fact is the newest committed version of every month. So
the work per batch is bounded by the months and buckets it touches (not by the whole table), a
crashed or replayed batch never exposes partial data (it is not marked), and a restarted query
resumes from its checkpoint and the markers.

An order that lands several times in a batch counts once: the file that landed last wins, then
the row with the later purchase timestamp (none is earliest).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from terrace import schemas
from terrace.functions.exprs import year_month
from terrace.operators.sinks import write_rebalanced
from terrace.operators.upsert import dedup_replacing, upsert_delete_insert
from terrace.plans import silver, star
from terrace.session import path_exists

MARKER_SCHEMA = "batch int, kind string, part string, n bigint"
NO_MONTH = "none"  # bucket of orders without a purchase timestamp
FACTS_BY_ORDER = ("fact_order_item", "fact_order_payment", "fact_order_review")


def _month() -> Column:
    return F.coalesce(year_month("order_purchase_timestamp"), F.lit(NO_MONTH))


def land_orders_by_month(orders: DataFrame, folder: str) -> str:
    """Land raw orders as one folder of files per purchase month (the file drop)."""
    write_rebalanced(orders.withColumn("ym", _month()), folder, "ym")
    return folder


def current_versions(spark: SparkSession, target: str, below: int | None = None, kind: str = "ym") -> dict[str, str]:
    """``part -> folder`` of the newest committed version of every stored part that has rows:
    months (kind "ym") or index buckets (kind "kb"); with ``below``, of versions written by
    earlier batches only. One row per part reaches the driver (bounded by the calendar and
    the number of buckets)."""
    root = target.rstrip("/")
    if not path_exists(spark, f"{root}/committed"):
        return {}
    markers = spark.read.schema(MARKER_SCHEMA).csv(f"{root}/committed/*").where(F.col("kind") == kind)
    if below is not None:
        markers = markers.where(F.col("batch") < below)
    latest = markers.groupBy("part").agg(F.max(F.struct("batch", "n")).alias("last")).collect()
    folder = {"ym": "data", "kb": "index"}[kind]
    return {r.part: f"{root}/{folder}/v{r['last'].batch:06d}/{kind}={r.part}" for r in latest if r["last"].n > 0}


def current_fact(spark: SparkSession, target: str) -> DataFrame | None:
    """The stored order fact: the newest committed version of each month."""
    paths = current_versions(spark, target)
    return spark.read.parquet(*paths.values()) if paths else None


def _one_per_order(batch: DataFrame) -> DataFrame:
    return dedup_replacing(batch, ["order_id"], "_landed", ["order_purchase_timestamp"]).drop("_landed")


def _parts(spark: SparkSession, versions: Mapping[str, str], wanted, kind: str, schema: T.StructType) -> DataFrame | None:
    """The stored rows of the wanted parts: one scan for each version that holds some."""
    by_version: dict[str, list[str]] = {}
    for w in wanted:
        if w in versions:
            by_version.setdefault(versions[w].rsplit("/", 1)[0], []).append(versions[w])
    found = [spark.read.schema(schema).option("basePath", base).parquet(*paths).select(schema.names)
             for base, paths in sorted(by_version.items())]
    return reduce(DataFrame.unionByName, found) if found else None


def stream_incremental_orders(spark: SparkSession, raw: Mapping[str, DataFrame], landed: str, target: str,
                              checkpoint: str, files_per_trigger: int = 8, index_buckets: int = 64) -> str:
    """Run the stream to completion; returns ``target`` (read it with ``current_fact``).
    ``index_buckets`` must stay the same for a target."""
    schema = T.StructType(schemas.RAW_SCHEMAS["fact_order"].fields + [T.StructField("ym", T.StringType())])
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(landed).select("*", F.col("_metadata.file_modification_time").alias("_landed")))
    root = target.rstrip("/")
    bucket = F.pmod(F.xxhash64("order_id"), F.lit(index_buckets)).cast("string")

    def apply(batch: DataFrame, batch_id: int) -> None:
        version = f"v{batch_id:06d}"
        # Fact rows for the batch's orders, from the silver layer with the batch as order source.
        scoped = dict(raw)
        scoped["fact_order"] = _one_per_order(batch.drop("ym"))
        ids = batch.select("order_id").distinct().hint("shuffle_hash")  # hashed: the facts stream past unsorted
        for name in FACTS_BY_ORDER:  # only the batch's orders are aggregated
            scoped[name] = raw[name].join(ids, "order_id", "left_semi").select(raw[name].columns)
        fact = star.gold_fct_orders(silver.SilverTables(scoped)).withColumns({"ym": _month(), "kb": bucket})
        # Stored once: the keys, the replaced rows and the new ones below are all read from here.
        fact.write.mode("overwrite").parquet(f"{root}/staged/{version}")
        staged = spark.read.schema(fact.schema).parquet(f"{root}/staged/{version}")
        touched = staged.agg(F.collect_set("ym").alias("ym"), F.collect_set("kb").alias("kb")).first()
        if not touched.ym:
            return
        places = staged.select("order_id", "ym", "kb")
        known = _parts(spark, current_versions(spark, root, batch_id, "kb"), touched.kb, "kb", places.schema)
        months = set(touched.ym)
        if known is not None:  # months that orders of the batch leave
            moved = known.join(places.select("order_id", F.col("ym").alias("_new")), "order_id").where("ym != _new")
            months |= {r.ym for r in moved.select("ym").distinct().collect()}
            places = upsert_delete_insert(known, places, ["order_id"])
        rows = staged.drop("kb")
        stored = _parts(spark, current_versions(spark, root, batch_id), sorted(months), "ym", rows.schema)
        if stored is not None:
            rows = upsert_delete_insert(stored, rows, ["order_id"])
        marks = None
        for df, folder, kind, parts in ((rows, "data", "ym", sorted(months)), (places, "index", "kb", touched.kb)):
            write_rebalanced(df, f"{root}/{folder}/{version}", kind)
            counts = spark.read.schema(df.schema).parquet(f"{root}/{folder}/{version}").groupBy(kind).count()
            n = {r[0]: r[1] for r in counts.collect()}  # a month that lost all its orders has no folder
            made = spark.createDataFrame([(batch_id, kind, p, n.get(p, 0)) for p in parts], MARKER_SCHEMA)
            marks = made if marks is None else marks.unionByName(made)
        marks.coalesce(1).write.mode("overwrite").csv(f"{root}/committed/{version}")

    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return root
