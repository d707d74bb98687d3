"""Time the headline queries and print one JSON line.

`BENCH_SF_DIR` names the tables, `BENCH_CPUS` the number of local threads, `BENCH_RUNS` the timed runs
per query (the median counts; one run before them warms up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from suite.queries import REGISTRY

HEADLINE = [
    "hourly_traffic_by_segment",
    "hourly_air_quality",
    "combined_outer",
    "combined_aligned",
    "critical_periods",
    "critical_periods_aligned",
    "summary_stats",
    "day_grain_volume",
    "critical_islands",
    "readings_in_bad_air_hours",
    "dedupe_first",
    "upsert_last",
    "parse_traffic",
    "parse_air",
    "station_enrichment",
    "table_roundtrip",
    "stream_hourly_air",
    "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
