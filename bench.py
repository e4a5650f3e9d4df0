"""Time the headline queries and print one line of JSON.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. All queries run once to warm the
session up, then each runs once more and is timed ``BENCH_RUNS`` times in full into the no-op sink; the median counts.
``BENCH_ALL=1`` takes every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from casepulse.plans.order_queries import QUERIES  # noqa: E402

HEADLINE = (
    "case_facts",
    "series_tidsbruk_monthly",
    "series_all",
    "ewma_all",
    "trend_crosstab",
    "trend_active",
    "cusum_all",
    "cusum_active",
    "shift_stats",
    "changepoint_shifts",
    "cohort_matrix",
    "cohort_baseline",
    "open_at",
    "latest_milestone",
    "case_state",
    "portfolio_snapshot",
    "early_processing",
    "ytd_rate",
    "seasonal_profile",
    "projection",
    "projection_rag",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("casepulse-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(query) -> float:
        begun = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    timings = {}
    names = list(QUERIES if os.environ.get("BENCH_ALL") else HEADLINE)
    for name in names:  # the first queries of a session pay for what later ones find compiled and cached
        once(QUERIES[name])
    for name in names:
        once(QUERIES[name])
        timings[name] = round(statistics.median(once(QUERIES[name]) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the timed queries, median per query",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
