"""Binds every model to a registry key and its oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace import oracle as O
from terrace.plans import analytics, marts, practice, primitives, silver, star
from terrace.plans.silver import SilverTables
from terrace.registry import model


def _star(fn):
    def run(t):
        out = fn(SilverTables(t))
        if "payment_types" in out.columns and dict(out.dtypes)["payment_types"].startswith("array"):
            # Arrays are reported as a ','-joined string so both engines hash the same text.
            out = out.withColumn("payment_types", F.array_join("payment_types", ","))
        return out
    return run


# Silver layer (M1-M7) and gold marts (G1-G9 with the DataFrame variants).
for _key, _fn in {**silver.SILVER_MODELS, **marts.GOLD_MARTS}.items():
    model(_key, _fn)
    O.register(_key, O.table(_key))

# Star schema (D1-D6) over the silver layer.
for _key, _fn in star.STAR_MODELS.items():
    model(_key, _star(_fn))
    O.register(_key, O.table(_key))
O.register("gold_fct_orders", O.build(
    "SELECT * REPLACE (array_to_string(payment_types, ',') AS payment_types) FROM gold_fct_orders",
    "gold_fct_orders"))

# Analytic queries (Q1-Q10) over the gold marts.
for _key, _fn in analytics.ANALYTIC_QUERIES.items():
    model(_key, _fn)
    O.register(_key, O.build(O.AQ[_key][0], *O.AQ[_key][1]))

# Primitive operators (C, J, A, W, O, F rows) and the practice queries of the guides.
for _key, (_fn, _sql, _deps) in {**primitives.PRIMS, **practice.PRACTICE}.items():
    model(_key, _fn)
    O.register(_key, O.build(_sql, *_deps))

# Sources, sinks, quality tests, table edits, cleaning jobs and the stream register
# themselves on import.
from terrace.plans import io_catalog  # noqa: E402,F401
