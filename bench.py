"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_RUNS``
timed runs, each forced through the ``noop`` sink (full execution, nothing
collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lifetide.plans.queries import EARLIER_NAMES, REGISTRY  # noqa: E402
from lifetide.session import local_session  # noqa: E402

HEADLINE = [
    "dim_users", "event_ordinal", "user_day_spine", "growth_daily", "growth_weekly", "growth_monthly",
    "growth_consolidated", "growth_weekly_strict", "triangle_daily", "triangle_weekly", "triangle_monthly",
    "dim_users_orders", "event_ordinal_orders", "growth_daily_orders", "growth_weekly_orders",
    "growth_monthly_orders", "growth_consolidated_orders", "growth_weekly_strict_orders",
    "triangle_daily_orders", "triangle_weekly_orders", "triangle_monthly_orders",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    # Default: every registered query, headline ones first.
    # A query with two names runs once, under the earlier one.
    again = set(EARLIER_NAMES.values())
    names = sys.argv[1:] or HEADLINE + [n for n in REGISTRY if n not in HEADLINE and n not in again]
    min_part = os.environ.get("BENCH_MIN_PARTITION", "")
    spark = local_session(cpus, shuffle_partitions=cpus, min_partition_size=min_part or None)
    times: dict[str, float] = {}
    for name in names:
        run = REGISTRY[name].run
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run is the warm-up
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "headline_sum": round(sum(v for k, v in times.items() if k in HEADLINE), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
