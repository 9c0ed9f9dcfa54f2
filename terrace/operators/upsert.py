"""Incremental maintenance of stored tables without a transactional table format.

These functions give the edited table as a DataFrame: a distributed anti join + union, or a
per-key ``max`` aggregate. Parquet cannot be overwritten while it is being read; ``versions``
stores the result of an upsert as a new version of a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def upsert_delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete target rows whose key appears in the batch, then insert the batch."""
    keep = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return keep.unionByName(batch)


def dedup_replacing(df: DataFrame, keys: Sequence[str], version: str, sequence: Sequence[str | Column] = ()) -> DataFrame:
    """Keep the row with the highest ``version`` per key (a replacing-merge). Of equal versions
    the one inserted last by ``sequence`` stays (see ``insertion_sequence``), of those the
    greatest row, so the result never depends on the order in which rows are read; NULL is
    lowest throughout. Done as a partial-then-final ``max`` of a struct, so a hot key is
    reduced map-side."""
    payload = [c for c in df.columns if c not in keys]
    rank = [F.col(version).alias("_v"), *[(F.col(c) if isinstance(c, str) else c).alias(f"_s{i}") for i, c in enumerate(sequence)]]
    best = F.max(F.struct(*rank, F.struct(*payload).alias("_row"))).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best._row")[c].alias(c) for c in payload])


def insertion_sequence() -> Column:
    """The order in which rows of a stored table were written: age of the file, then the place
    in it. Only for DataFrames that read files."""
    return F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index")


def incremental_filter(source: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Rows of ``source`` newer than the newest ``ts`` already in ``target`` (all rows when
    the target is empty)."""
    high = target.agg(F.max(ts)).scalar()
    return source.where(high.isNull() | (F.col(ts) > high))


def dml_insert(table: DataFrame, rows: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """INSERT: missing columns take the declared default (else NULL)."""
    out = table.unionByName(rows, allowMissingColumns=True)
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(dict(table.dtypes)[c])))
    return out


def dml_update(table: DataFrame, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET col = value WHERE predicate (a NULL predicate leaves the row alone)."""
    hit = F.coalesce(predicate, F.lit(False))
    return table.select([F.when(hit, assignments[c].cast(t)).otherwise(F.col(c)).alias(c) if c in assignments
                         else F.col(c) for c, t in table.dtypes])


def dml_delete(table: DataFrame, predicate: Column) -> DataFrame:
    """DELETE WHERE predicate; rows where the predicate is NULL are kept."""
    return table.where(~F.coalesce(predicate, F.lit(False)))
