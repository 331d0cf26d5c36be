"""Times the headline queries, those named, or "all", and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores. Each query is planned and run
into a sink that drops the rows: one warm-up, then the median of the runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from farelane.session import local_session
from workload.queries import QUERIES

RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "daily_kpis",
    "daily_kpis_one_day",
    "month_to_date_revenue",
    "revenue_running_month",
    "zone_kpis",
    "part_of_day_mix",
    "clean_trips_strict",
    "clean_trips_intent",
    "clean_audit",
    "fact_rollup_all",
    "top_customers",
    "top_customer_habits",
    "customer_habits",
    "customer_profile",
    "customer_profile_one",
    "trips_with_ids",
    "trips_with_customers",
    "trip_sample",
    "write_roundtrip",
    "publish_twice",
    "cdc_parse",
    "cdc_stream_append",
    "cdc_stream_customer_count",
    "media_decode",
    "media_stream_objects",
)


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def measure(queries: dict, spark, sf_dir: str) -> dict[str, float]:
    seconds = {}
    for name, query in queries.items():
        runs = [timed(query, spark, sf_dir) for _ in range(RUNS + 1)]
        seconds[name] = round(statistics.median(runs[1:]), 3)
    return seconds


def main(*names: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    chosen = QUERIES if names == ("all",) else names or HEADLINE
    seconds = measure({name: QUERIES[name] for name in chosen}, spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(*sys.argv[1:])
