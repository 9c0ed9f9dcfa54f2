"""Tables kept as versions: immutable data files and, for each version, a manifest.

A manifest is one small Parquet file below ``<root>/manifest/version=<n>`` that lists the data
files of the version with their rows and the least and greatest key. It appears with the commit
of its write, after all data are written: the newest manifest is the table, a run that fails
before leaves the old version current, and two writers of one version cannot both succeed.

An upsert rewrites only the files that hold a key of the batch. The manifest's key ranges give
candidates (on the driver, which sees one row per file), the key column of these tells which of
them really hold one, and all other files belong to the new version as they are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrace.operators.sinks import write_sorted
from terrace.session import path_exists

Observe = Callable[[DataFrame], DataFrame]


def newest(spark: SparkSession, root: str) -> int | None:
    """Number of the newest committed version."""
    folder = f"{root.rstrip('/')}/manifest"
    if not path_exists(spark, f"{folder}/version=*"):
        return None
    return spark.read.parquet(folder).agg(F.max("version")).first()[0]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Entries of a version (the newest one by default)."""
    root = root.rstrip("/")
    version = newest(spark, root) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no version is committed below {root}")
    return spark.read.parquet(f"{root}/manifest/version={version:06d}")


def publish(entries: DataFrame, root: str, version: int) -> int:
    """Commit a version: its manifest appears as one file."""
    entries.coalesce(1).write.mode("errorifexists").parquet(f"{root.rstrip('/')}/manifest/version={version:06d}")
    return version


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version."""
    return spark.read.parquet(*[r.path for r in manifest(spark, root, version).select("path").collect()])


def _entries(spark: SparkSession, folder: str, keys: Sequence[str]) -> DataFrame:
    """Manifest entries of the files of a folder; a folder without rows is one entry, which
    keeps the schema. Reads the key column only."""
    stored = spark.read.parquet(folder)
    key = F.col(keys[0])
    files = (stored.groupBy(F.col("_metadata.file_path").alias("path"))
             .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high")))
    if files.isEmpty():
        files = (spark.createDataFrame([(folder, 0)], "path string, rows bigint")
                 .withColumns({c: F.lit(None).cast(stored.schema[keys[0]].dataType) for c in ("low", "high")}))
    return files


def create(df: DataFrame, root: str, keys: Sequence[str], version: int = 0, partitions: int | None = None,
           observe: Observe | None = None) -> int:
    """Write a table, sorted by its keys, as a first (or a wholly new) version."""
    folder = f"{root.rstrip('/')}/data/v{version:06d}"
    write_sorted(df, folder, keys, partitions, observe)
    return publish(_entries(df.sparkSession, folder, keys), root, version)


def _overlapping(files: list, ranges: list) -> list:
    """Of (path, low, high) files those that overlap one of the (low, high) ranges."""
    merged: list[list] = []
    for low, high in sorted(r for r in ranges if r[0] is not None):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    ends = [high for _, high in merged]
    out = []
    for path, low, high in files:
        at = bisect_left(ends, low) if low is not None else len(ends)
        if at < len(merged) and merged[at][0] <= high:
            out.append(path)
    return out


def upsert(batch: DataFrame, root: str, keys: Sequence[str], base: int | None = None, partitions: int | None = None,
           observe: Observe | None = None) -> int:
    """Delete the rows whose key is in the batch from the version ``base`` (the newest one by
    default), insert the batch, and commit the result as a new version; returns its number.

    The batch's plan runs once: its rows are written as data files of the new version, and keys
    are read from there. Rows with a NULL key are inserted and never deleted. A key that repeats
    in the batch is inserted as often.
    """
    spark, root, keys = batch.sparkSession, root.rstrip("/"), list(keys)
    last = newest(spark, root)
    version = last + 1
    old = manifest(spark, root, last if base is None else base)
    folder = f"{root}/data/v{version:06d}"
    write_sorted(batch, f"{folder}/new", keys, partitions, observe)
    added = _entries(spark, f"{folder}/new", keys)
    files = [(r.path, r.low, r.high) for r in old.select("path", "low", "high").collect()]
    candidates = _overlapping(files, [(r.low, r.high) for r in added.select("low", "high").collect()])
    fresh = spark.read.parquet(f"{folder}/new").select(*keys).distinct()
    touched: list[str] = []
    if candidates:
        held = spark.read.parquet(*candidates).select(*keys, F.col("_metadata.file_path").alias("_file"))
        touched = [r[0] for r in held.join(fresh, keys, "left_semi").select("_file").distinct().collect()]
    entries = old.join(F.broadcast(spark.createDataFrame([(p,) for p in touched], "path string")), "path", "left_anti")
    if touched:
        kept = spark.read.parquet(*touched).join(fresh, keys, "left_anti")
        write_sorted(kept, f"{folder}/kept", keys, partitions)
        entries = entries.unionByName(_entries(spark, f"{folder}/kept", keys))
    return publish(entries.unionByName(added), root, version)
