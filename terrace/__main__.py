"""Command line: run any registered model or query.

    python -m terrace list
    python -m terrace show  gold_daily_kpi --data /root/testdata/sf0.01 [--rows 20]
    python -m terrace run   gold_fct_orders --data /root/testdata/sf0.1 --out <folder> [--format parquet|csv]
    python -m terrace explain q04_top3_per_category --data /root/testdata/sf0.01

``--master`` defaults to ``local[*]``; under spark-submit the session given by the cluster is used.
"""

from __future__ import annotations

import argparse
import sys

from terrace import registry


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="terrace")
    p.add_argument("command", choices=["list", "show", "run", "explain"])
    p.add_argument("key", nargs="?")
    p.add_argument("--data", help="folder with the input parquet tables")
    p.add_argument("--out", help="output folder for 'run'")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--rows", type=int, default=20)
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)

    queries = registry.queries()
    if a.command == "list":
        print("\n".join(sorted(queries)))
        return 0
    if a.key not in queries or not a.data:
        p.error("a registered key and --data are required")

    from pyspark.sql import SparkSession

    from terrace.session import DEFAULT_CONF, ensure_checkpoint_dir
    builder = SparkSession.builder.appName(f"terrace-{a.key}")
    if a.master:
        builder = builder.master(a.master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    df = queries[a.key](spark, a.data)
    if a.command == "show":
        df.show(a.rows, truncate=False)
    elif a.command == "explain":
        df.explain("formatted")
    else:
        if not a.out:
            p.error("--out is required for 'run'")
        writer = df.write.mode("overwrite")
        (writer.option("header", True).csv(a.out) if a.format == "csv" else writer.parquet(a.out))
        print(f"wrote {a.key} to {a.out}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
