"""A layered run: models that need each other, run in order, published together.

Models form a graph. A model starts when those it needs are stored, and independent ones run as
concurrent Spark jobs from a small thread pool. It reads what this run stored, is written in a
place of its own, sorted by its keys, and its tests are counted while it is written. Only if
every model and test succeeds does the run's manifest appear, which names the place of every
model: a reader sees either all of the old run or all of the new one. After a failure the old
run stays current, and the error carries the whole report with each reason.

A model with a ``unique_key`` is incremental: its rows replace those with the same key in the
current table (delete + insert), other rows stay; files without such a key are not rewritten.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from terrace.operators import versions as V
from terrace.operators.sinks import layer_path, write_sorted, write_parquet

ENTRY = "layer string, model string, path string, version bigint, rows bigint"
REPORT = "layer string, model string, status string, rows bigint"


@dataclass(frozen=True)
class Model:
    layer: str
    name: str
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    needs: Sequence[str] = ()
    sort_keys: Sequence[str] = ()
    unique_key: Sequence[str] = ()
    #: Name -> condition of a violating row; a model with one fails.
    tests: Mapping[str, Column] = field(default_factory=dict)


class LayerRunError(RuntimeError):
    """A run that was not published; ``report`` has a (layer, model, status, rows) per model."""

    def __init__(self, report: list[tuple]):
        self.report = report
        super().__init__("; ".join(f"{layer}.{name}: {status}" for layer, name, status, _ in report if status.startswith("error")))


def current(spark: SparkSession, root: str) -> dict[str, object]:
    """Manifest row of every model of the published run; empty before the first one."""
    if V.newest(spark, root) is None:
        return {}
    return {r.model: r for r in V.manifest(spark, root).collect()}


def _stored(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    return spark.read.parquet(path) if version is None else V.read(spark, path, version)


def read_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A model as the published run left it."""
    row = current(spark, root)[name]
    return _stored(spark, row.path, row.version)


def _write(spark: SparkSession, root: str, run: int, m: Model, df: DataFrame, before) -> tuple[str, int | None, int]:
    """Store a model; returns its path, its version if it is incremental, and its rows."""
    counts = {"rows": F.count(F.lit(1))} | {t: F.count(F.when(c, 1)) for t, c in m.tests.items()}
    seen = Observation()

    def observe(rows: DataFrame) -> DataFrame:
        return rows.observe(seen, *[c.alias(n) for n, c in counts.items()])

    path, version = layer_path(root, m.layer, m.name), None
    if m.unique_key:
        path = f"{path}/table"
        if before is None:
            last = V.newest(spark, path)
            version = V.create(df, path, m.unique_key, 0 if last is None else last + 1, observe=observe)
        else:
            version = V.upsert(df, path, m.unique_key, base=before.version, observe=observe)
    else:
        path = f"{path}/run={run:06d}"
        write_sorted(df, path, m.sort_keys, observe=observe) if m.sort_keys else write_parquet(observe(df), path)
    got = seen.get
    broken = [f"{t} ({got[t]} rows)" for t in m.tests if got[t]]
    if broken:
        raise ValueError("failed tests: " + ", ".join(broken))
    rows = V.manifest(spark, path, version).agg(F.sum("rows")).first()[0] if m.unique_key else got["rows"]
    return path, version, rows


def run(spark: SparkSession, root: str, models: Sequence[Model], sources: Mapping[str, DataFrame] | None = None,
        full_refresh: bool = False, threads: int = 4) -> list[tuple]:
    """Run all models and publish them; returns the report in the order of ``models``. Raises
    ``LayerRunError`` if a model or one of its tests fails (models that need it are skipped,
    others still run) and ``ValueError`` for an unknown need or a cycle."""
    by_name, sources = {m.name: m for m in models}, dict(sources or {})
    unknown = {n for m in models for n in m.needs} - set(by_name) - set(sources)
    if unknown or len(by_name) < len(models):
        raise ValueError(f"unknown or repeated models: {sorted(unknown)}")
    graph = TopologicalSorter({m.name: [n for n in m.needs if n in by_name] for m in models})
    graph.prepare()
    published = current(spark, root)
    number = V.newest(spark, root)
    number = 0 if number is None else number + 1
    while V.path_exists(spark, f"{root.rstrip('/')}/attempts/run={number:06d}"):
        number += 1  # a run that failed has written below this number
    spark.range(1).coalesce(1).write.mode("errorifexists").parquet(f"{root.rstrip('/')}/attempts/run={number:06d}")
    done: dict[str, tuple] = {}

    def one(m: Model) -> tuple:
        inputs = {n: _stored(spark, *done[n][:2]) if n in by_name else sources[n] for n in m.needs}
        before = None if full_refresh else published.get(m.name)
        return _write(spark, root, number, m, m.build(inputs), before)

    status: dict[str, str] = {}
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        running = {}
        while graph.is_active():
            for name in graph.get_ready():
                missing = [n for n in by_name[name].needs if n in by_name and n not in done]
                if missing:
                    status[name] = f"skipped: needs {', '.join(missing)}"
                    graph.done(name)
                else:
                    running[pool.submit(one, by_name[name])] = name
            for f in wait(running, return_when=FIRST_COMPLETED).done if running else ():
                name = running.pop(f)
                try:
                    done[name] = f.result()
                    status[name] = "ok"
                except Exception as e:  # noqa: BLE001 - reported and raised below
                    first = str(e).strip().splitlines()
                    status[name] = f"error: {type(e).__name__}: {first[0][:300] if first else ''}"
                graph.done(name)
    report = [(m.layer, m.name, status[m.name], done[m.name][2] if m.name in done else None) for m in models]
    if any(s != "ok" for s in status.values()):
        raise LayerRunError(report)
    entries = [(m.layer, m.name, *done[m.name]) for m in models]
    V.publish(spark.createDataFrame(entries, ENTRY), root, number)
    return report
