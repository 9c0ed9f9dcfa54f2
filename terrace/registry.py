"""Registry of every implemented query: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrace.sources.fixtures import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
_loaded = False


def register(key: str, fn: QueryFn) -> None:
    if key in QUERIES:
        raise KeyError(f"duplicate query key {key}")
    QUERIES[key] = fn


def model(key: str, build: Callable[[Tables], DataFrame]) -> None:
    """Register a model that reads the raw tables of the data folder."""
    register(key, lambda spark, sf_dir: build(Tables(spark, sf_dir)))


def _load() -> None:
    """Import the catalog modules, which fill QUERIES and the oracle table; some of them may have
    been imported before, so what is registered does not tell."""
    global _loaded
    if not _loaded:
        from terrace.plans import catalog  # noqa: F401

        _loaded = True


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    from terrace.oracle import ORACLE
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
