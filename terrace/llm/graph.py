"""Connected components of a link table, by alternating star contraction.

Every node is moved to the least node it knows of, until nothing changes; the number of rounds
grows with the logarithm of the longest path. All steps are joins and aggregates on narrow rows;
each round is written to the shared folder, so a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terrace.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of the links (columns a, b): component is the least id.
    Links to itself and repeated links do no harm."""
    a, b = F.col("a"), F.col("b")
    edges = stored(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u")
        new = (small.where("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
               .unionByName(root.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(new, "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
