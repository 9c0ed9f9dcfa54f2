"""Data-quality tests. Each test is a distributed aggregate returning one report row
``(model, test, column, failing_rows, status)``; a suite is the union of its tests, so the
whole report is computed by Spark and only the final handful of rows reach the caller.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from terrace.functions.exprs import hours_between

REPORT_COLS = ("model", "test", "column", "failing_rows", "status")


def _report(failing: DataFrame, model: str, test: str, column: str, warn_only: bool = False) -> DataFrame:
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    status = F.when(n == 0, "pass").otherwise("warn" if warn_only else "fail")
    return failing.select(F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(column).alias("column"),
                          n.alias("failing_rows"), status.alias("status"))


def dq_unique(df: DataFrame, model: str, keys: Sequence[str]) -> DataFrame:
    """Fails for every (non-NULL) key value that occurs more than once."""
    k = [F.col(c) for c in keys]
    dup = (df.where(reduce(lambda a, b: a & b, [c.isNotNull() for c in k])).groupBy(*k)
           .agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1))
    return _report(dup.agg(F.count(F.lit(1)).alias("n")), model, "unique", ",".join(keys))


def dq_not_null(df: DataFrame, model: str, column: str) -> DataFrame:
    return _report(df.agg(F.count(F.when(F.col(column).isNull(), 1)).alias("n")), model, "not_null", column)


def dq_checks(df: DataFrame, model: str, checks: Sequence[tuple[str, str, Column]], keys: Sequence[str] = ()) -> DataFrame:
    """Several tests of a model in one scan: a report row for each (test, column, condition of a
    failing row), and with ``keys`` one for their uniqueness. Without keys all counts are one
    aggregate; with keys rows are counted by key first, and the other counts ride along."""
    counts = {f"c{i}": F.count(F.when(c, 1)) for i, (_, _, c) in enumerate(checks)}
    rows = [(test, column, f"c{i}") for i, (test, column, _) in enumerate(checks)]
    if keys:
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
        each = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in counts.items()])
        df, counts = each, {n: F.sum(n) for n in counts} | {"u": F.count(F.when(complete & (F.col("_n") > 1), 1))}
        rows.append(("unique", ",".join(keys), "u"))
    one = df.agg(*[c.alias(n) for n, c in counts.items()])
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("test"), F.lit(c).alias("column"), F.col(n).alias("n")) for t, c, n in rows]))
    one = one.select(each.alias("x")).select("x.*")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    return one.select(F.lit(model).alias("model"), "test", "column", n.alias("failing_rows"),
                      F.when(n == 0, "pass").otherwise("fail").alias("status"))


def dq_accepted_values(df: DataFrame, model: str, column: str, values: Sequence) -> DataFrame:
    """Fails for values outside the list (NULL is not a failure, as in SQL ``NOT IN``)."""
    bad = ~F.col(column).isin(*values)
    return _report(df.agg(F.count(F.when(bad, 1)).alias("n")), model, "accepted_values", column)


def dq_relationships(child: DataFrame, model: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Fails for child rows whose non-NULL foreign key has no parent row (anti join)."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    orphans = child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")
    return _report(orphans.agg(F.count(F.lit(1)).alias("n")), model, "relationships", column)


def dq_singular(df: DataFrame, model: str, name: str, violation: Column) -> DataFrame:
    """A violation predicate; the test passes when no row satisfies it."""
    return _report(df.agg(F.count(F.when(violation, 1)).alias("n")), model, name, "")


def dq_source_freshness(df: DataFrame, model: str, loaded_at: str, now: str,
                        warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """Age of the newest ``loaded_at`` against a fixed 'now' (deterministic): warn after
    ``warn_hours``, error after ``error_hours``."""
    newest = F.max(loaded_at)
    age = hours_between(F.lit(now).cast("timestamp_ntz"), newest).alias("age_hours")
    a = df.agg(newest.alias("max_loaded_at"), age)
    status = (F.when(F.col("age_hours") > error_hours, "error").when(F.col("age_hours") > warn_hours, "warn")
              .otherwise("pass"))
    return a.select(F.lit(model).alias("model"), F.lit("freshness").alias("test"), F.lit(loaded_at).alias("column"),
                    "max_loaded_at", "age_hours", status.alias("status"))


def suite(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), reports)
