"""Sinks and write modes (Parquet / CSV tables under a layer folder).

Writes are single distributed jobs; file counts are controlled by the partitioning of the
DataFrame being written (``repartition`` / ``repartitionByRange``) and ``maxRecordsPerFile``,
not by driver-side batching.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from terrace import schemas
from terrace.functions.exprs import year_month
from terrace.session import path_exists


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", max_records_per_file: int | None = None) -> str:
    """Write Parquet; a failure is re-raised to the caller."""
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.parquet(path)
    return path


def write_replace(df: DataFrame, path: str) -> str:
    """Drop-and-recreate semantics: the folder is replaced by the new contents."""
    return write_parquet(df, path, "overwrite")


def write_in_batches(batches: Sequence[DataFrame], path: str) -> str:
    """First batch replaces the target, later batches append."""
    for i, b in enumerate(batches):
        write_parquet(b, path, "overwrite" if i == 0 else "append")
    return path


def layer_path(base: str, layer: str | None, table: str, default_layer: str = "default") -> str:
    """The layer name is used verbatim as the folder (database) name, else the default."""
    return f"{base.rstrip('/')}/{layer or default_layer}/{table}"


def create_table_as(spark: SparkSession, database: str, table: str, location: str, query_df: DataFrame,
                    database_location: str | None = None) -> DataFrame:
    """``CREATE DATABASE IF NOT EXISTS db; DROP TABLE IF EXISTS db.t; CREATE TABLE db.t USING
    parquet LOCATION ... AS SELECT``. Both locations are explicit, so nothing lands in a
    machine-local warehouse folder; the database lies where its tables do, in the layer's folder
    (the parent of ``location``), unless ``database_location`` names another."""
    db_loc = database_location or location.rstrip("/").rpartition("/")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{db_loc}'")
    view = f"_ctas_{table}"
    query_df.createOrReplaceTempView(view)
    spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    spark.sql(f"CREATE TABLE {database}.{table} USING parquet LOCATION '{location}' AS SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    return spark.table(f"{database}.{table}")


def normalize_types(df: DataFrame) -> DataFrame:
    """Any integer -> bigint, any float -> double, boolean stays boolean, everything else ->
    string (timestamps included); all columns nullable."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            target = T.LongType()
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            target = T.DoubleType()
        elif isinstance(t, T.BooleanType):
            target = T.BooleanType()
        else:
            target = T.StringType()
        cols.append(F.col(f.name).cast(target).alias(f.name))
    return df.select(cols)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], partitions: int | None = None,
                 observe: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Full-refresh table stored ordered by its (possibly composite) key: range-partitioned
    on the key and sorted inside each file, so readers can skip row groups by min/max.
    ``observe`` may attach metrics to the rows as they are written (before the sort they would
    also count the rows that the range bounds are sampled from)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return write_parquet(observe(rows) if observe else rows, path)


def write_rebalanced(df: DataFrame, path: str, part_col: str, mode: str = "overwrite") -> str:
    """Partitioned write with few files a folder: the rows are rebalanced by ``part_col``
    first, so that one task writes a small folder, while a folder that holds a large share of
    the rows is split over several tasks by size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)
    instead of landing in one."""
    df.hint("rebalance", part_col).write.mode(mode).partitionBy(part_col).parquet(path)
    return path


def write_partitioned_by_month(df: DataFrame, path: str, ts_col: str, part_col: str = "ym") -> str:
    """Partition a fact by ``yyyyMM`` of a timestamp; readers filtering on ``ym`` prune folders."""
    return write_rebalanced(df.withColumn(part_col, year_month(ts_col)), path, part_col)


def write_with_csv_fallback(df: DataFrame, path: str, compression: str | None = None) -> tuple[str, str]:
    """Write Parquet (with a codec, if given); if that fails, for want of the codec's library for
    instance, write CSV at ``path + '_csv'``. Returns (format, path). The CSV keeps line breaks,
    quotes and outer blanks: ``readers.read_csv(..., multiline=True, keep_empty=True)`` gives the same rows."""
    try:
        if compression is None:
            write_parquet(df, path)
        else:
            df.write.mode("overwrite").option("compression", compression).parquet(path)
        return "parquet", path
    except Exception:  # noqa: BLE001 - any writer failure falls back
        csv_path = path + "_csv"
        (df.write.mode("overwrite").option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(csv_path))
        return "csv", csv_path


def conform_to_declared(df: DataFrame, declared: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Cast to the declared types (``try_cast``: bad values become NULL), apply column defaults
    and add any missing declared column as NULL/default."""
    defaults = defaults or {}
    cols = []
    for f in declared.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = c.try_cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(cols)


MALFORMED = "_malformed"  # column of a checked reader: the text of a row that does not fit


def _good_rows(df: DataFrame) -> DataFrame:
    """Rows of a checked reader, without its column; a malformed row fails the job, so that a
    write commits nothing."""
    if MALFORMED not in df.columns:
        return df
    bad = F.col(MALFORMED)
    fail = F.raise_error(F.concat(F.lit("malformed row: "), F.left(bad, F.lit(200))))
    return df.where(F.when(bad.isNull(), True).otherwise(fail.cast("boolean"))).drop(MALFORMED)


def _reason(df: DataFrame | None, error: Exception) -> str:
    """Malformed rows, counted, where a checked reader has some, else the error's first line."""
    if df is not None and MALFORMED in df.columns:
        try:
            # The CSV source answers no query over its column of malformed rows alone.
            bad = df.where(F.col(MALFORMED).isNotNull()).agg(
                F.count(F.lit(1)).alias("n"), F.min(MALFORMED).alias("e"), F.count(df.columns[0]).alias("_other")).first()
            if bad.n:
                return f"error: {bad.n} malformed rows, such as {bad.e[:200]!r}"
        except Exception:  # noqa: BLE001 - the read itself fails: the first error tells
            pass
    first = str(error).splitlines()[0][:300] if str(error) else ""
    return f"error: {type(error).__name__}: {first}"


def ingest_catalog(spark: SparkSession, csv_folder: str, out_folder: str,
                   reader: Callable[[SparkSession, str, str], DataFrame],
                   catalog=schemas.CSV_CATALOG, threads: int = 4) -> DataFrame:
    """Per catalog entry: read the CSV, write Parquet, count rows. The tables are independent
    and load as concurrent Spark jobs. A missing file or an error is recorded and skipped; an
    entry with malformed rows (column ``_malformed`` of the reader) is an error that names their
    number and one of them, and writes nothing. The report is a small DataFrame ``(table_name,
    category, status, rows, seconds)`` in catalog order; ``ingest_outcome`` sums it up."""

    def load(entry) -> tuple:
        _label, fname, table, cat = entry
        src = f"{csv_folder.rstrip('/')}/{fname}"
        t0 = time.time()
        if not path_exists(spark, src):
            return (table, cat, "missing", None, 0.0)
        df = None
        try:
            dst = f"{out_folder.rstrip('/')}/{table}"
            df = reader(spark, src, table)
            write_parquet(_good_rows(df), dst)
            n = spark.read.parquet(dst).count()
            return (table, cat, "ok", n, round(time.time() - t0, 3))
        except Exception as e:  # noqa: BLE001 - counted and skipped, like the source job
            return (table, cat, _reason(df, e), None, round(time.time() - t0, 3))

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        report = list(pool.map(load, catalog))
    schema = "table_name string, category string, status string, rows bigint, seconds double"
    return spark.createDataFrame(report, schema)


def ingest_outcome(report: DataFrame) -> DataFrame:
    """One row over an ingest report: tables loaded, missing and failed, rows, and ``success``,
    which is true if nothing failed and at least one table loaded."""
    def n(cond):
        return F.count(F.when(cond, 1))

    ok, missing = F.col("status") == "ok", F.col("status") == "missing"
    return report.agg(n(ok).alias("loaded"), n(missing).alias("missing"), n(~ok & ~missing).alias("failed"),
                      F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                      ((n(~ok & ~missing) == 0) & (n(ok) > 0)).alias("success"))
