"""Aggregation shapes for several exact distinct counts per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terrace.session import materialize

#: Rows of a group that may meet in one task.
GROUP_ROWS = 1_000_000


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where a NULL key matches a NULL key (group keys may be NULL)."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_rk_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_rk_{k}" for k in keys])


def distinct_counts(source: DataFrame, keys: Sequence[str], counts: Mapping[str, str | Column]) -> DataFrame:
    """``keys`` plus ``COUNT(DISTINCT value)`` per group for every entry of ``counts``.

    Each count is its own two-phase aggregation over distinct (keys, value) pairs: the pair
    dedup is partial-then-final (a hot group is spread over many tasks) and only one row per
    group reaches the join. Compared with one aggregate holding several distinct counts
    (which expands every input row once per count), each pass reads just two columns, and
    the source can be the narrowest table that determines the values.
    """
    out = None
    for name, value in counts.items():
        v = F.col(value) if isinstance(value, str) else value
        part = (source.select(*keys, v.alias("_v")).distinct()
                .groupBy(*keys).agg(F.count("_v").alias(name)))
        out = part if out is None else join_on_keys(out, part, keys)
    return out


def counts_and_sums(source: DataFrame, keys: Sequence[str], counts: Mapping[str, str | Column],
                    sums: Mapping[str, str | Column]) -> DataFrame:
    """Per group several exact distinct counts and sums in one scan of ``source``.

    Every row becomes one narrow row per count, (keys, number of the count, value); the first
    of them carries what is summed. These are aggregated by (keys, number, value), partially
    before the shuffle, which leaves each distinct value once however large a group is, and then
    by keys. Unlike ``distinct_counts`` the source is read once; unlike ``countDistinct`` of
    several columns the sums add no further copy of each row.
    """
    values = [F.col(v) if isinstance(v, str) else v for v in counts.values()]
    carried = {n: F.col(v) if isinstance(v, str) else v for n, v in sums.items()}
    tagged = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), v.alias("v"), *[(c if i == 0 else F.lit(None)).cast("double").alias(n) for n, c in carried.items()])
        for i, v in enumerate(values)]))
    rows = source.select(*keys, tagged.alias("x")).select(*keys, "x.*")
    each = rows.groupBy(*keys, "i", "v").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(n).alias(n) for n in carried])
    return each.groupBy(*keys).agg(*[F.count(F.when(F.col("i") == i, F.col("v"))).alias(n) for i, n in enumerate(counts)],
                                   *[F.sum(n).alias(n) for n in carried])


def small_group_counts_and_sums(source: DataFrame, keys: Sequence[str], counts: Mapping[str, str | Column],
                                sums: Mapping[str, str | Column], group_rows: int = GROUP_ROWS) -> DataFrame:
    """``counts_and_sums`` for groups that are mostly small, as the items of an order: the rows of
    a group meet in one shuffle of the columns in use, where ``counts_and_sums`` shuffles a row per
    count, which small groups hardly reduce. Groups are counted first; those of more than
    ``group_rows`` rows are spread by ``counts_and_sums``."""
    keys = list(keys)
    large = materialize(source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > group_rows).select(*keys))
    small = source
    if not large.isEmpty():
        small = join_on_keys(source, large, keys, "left_anti")
        spread = counts_and_sums(join_on_keys(source, large, keys, "left_semi"), keys, counts, sums)
    column = lambda v: F.col(v) if isinstance(v, str) else v
    rows = small.select(*keys, *[column(v).alias(f"_v{i}") for i, v in enumerate(counts.values())],
                        *[column(v).cast("double").alias(f"_s{i}") for i, v in enumerate(sums.values())])
    out = rows.repartition(*keys).groupBy(*keys).agg(
        *[F.size(F.collect_set(f"_v{i}")).cast("long").alias(n) for i, n in enumerate(counts)],
        # Doubles are added in the order of their values, as rows arrive from a shuffle in any order.
        *[F.when(F.count(f"_s{i}") > 0, F.aggregate(F.array_sort(F.collect_list(f"_s{i}")), F.lit(0.0), lambda a, v: a + v)).alias(n)
          for i, n in enumerate(sums)])
    return out if small is source else out.unionByName(spread)
