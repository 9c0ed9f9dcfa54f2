"""terrace: a layered (raw -> silver -> gold) e-commerce analytics pipeline on Spark.

Every model is a function ``f(tables: Mapping[str, DataFrame]) -> DataFrame`` built from
the DataFrame / SQL API; Catalyst and AQE choose the physical plan.
"""

__all__ = ["session", "schemas"]
