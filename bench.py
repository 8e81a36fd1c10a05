"""Benchmark the headline queries.

Runs on local[$BENCH_CPUS] against $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints one JSON line. Each query is fully executed (rows written to a
no-op sink); the reported time per query is the median of $BENCH_REPEAT runs
(default 3) after one warm-up run of the whole set; a query whose first
run takes over 30 s is measured by that run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meridian.plans.registry import QUERIES  # noqa: E402
from meridian.session import get_session  # noqa: E402

LONG = 30

HEADLINE = [
    "fact_reviews_alloc", "dim_users", "nearest_stations", "dim_weather", "star_query",
    "weather_upsert", "weather_combine", "checkin_explode", "dq_reconcile",
    "local_competition", "city_reviews", "weather_footfall",
]


def run_once(spark, name, sf_dir):
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session(f"local[{cpus}]", app="meridian-bench",
                        shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    # warm-up: JIT, file listing caches; a query that takes LONG seconds then is not run again
    warm = {n: run_once(spark, n, sf_dir) for n in names}
    times = {}
    for n in names:
        times[n] = round(warm[n] if warm[n] >= LONG else statistics.median(run_once(spark, n, sf_dir) for _ in range(repeat)), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
