"""Join shapes that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def left_join_many(one: DataFrame, many: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``one LEFT JOIN many USING (keys)`` when ``many`` may hold hot keys (one order with a
    third of all items).

    AQE can split a skewed partition on either side of an inner join, but only on the
    preserved side of an outer join, so a hot key on the right of a left join would stay in
    one task. The join is therefore the inner join plus the rows of ``one`` that have no
    match (an anti join against the *distinct* keys of ``many``, which cannot be skewed).

    Where rows are shuffled, the narrower side is hashed and the other one streams past it: a
    task holds its rows of ``one`` (and its keys), and sorts none of ``many``.
    """
    keys = list(keys)
    matched = one.hint("shuffle_hash").join(many, keys, "inner")
    unmatched = one.join(many.select(*keys).distinct().hint("shuffle_hash"), keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
