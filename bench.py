"""Headline timings on the given tables; prints one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores), BENCH_RUNS (timed runs).
Each query runs once to warm up; the value kept is the median of the timed runs,
from building the plan to the last row.  The tables are first written anew in as many
files as there are cores, as large tables are, so that the plans timed are those of production.
"""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from tallyweir.plans.catalog import QUERIES

HEADLINES = (
    "hits",
    "status",
    "upstreams_response_time_mean",
    "upstreams_status",
    "reject_reasons",
    "metrics_wide",
    "points_long",
    "line_protocol",
    "order_contacts_means",
    "order_contacts_status",
    "stream_closed_buckets",
)
SLOW = ("stream_closed_buckets",)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyweir-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
    )
    with tempfile.TemporaryDirectory(prefix="run-") as scratch:
        spark = builder.config("spark.checkpoint.dir", scratch).getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        times = {}
        tables = _in_files(spark, sf_dir, f"{scratch}/tables", int(cpus) if cpus.isdigit() else 8)
        for name in HEADLINES:
            timed = 1 if name in SLOW else runs
            taken = [_seconds(spark, name, tables) for _ in range(timed + 1)][1:]
            times[name] = round(statistics.median(taken), 3)
            print(f"{name}: {times[name]} s", file=sys.stderr)
        lines = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        with contextlib.suppress(Exception):
            spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "log_lines": lines,
                "lines_per_second": {n: round(lines / times[n]) for n in HEADLINES if not n.startswith("order_")},
            }
        )
    )


def _in_files(spark: SparkSession, sf_dir: str, folder: str, files: int) -> str:
    for name in ("events", "orders", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def _seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


if __name__ == "__main__":
    main()
