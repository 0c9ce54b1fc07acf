"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is run once to warm up and then timed ``$BENCH_RUNS`` times (3); the median counts.
Results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "as_of_keyed",
    "current_view",
    "as_of_by_practice",
    "extract_diff",
    "fk_orphans_asof",
    "fk_all",
    "fk_samples",
    "fk_as_of_mode",
    "practice_counts",
    "code_counts",
    "code_counts_refreshed",
    "route_direct",
    "route_via_parent",
    "residual_rows",
    "constraint_checks",
    "parse_names",
    "quoted_text_rows",
    "check_widths",
    "run_lines",
    "fk_result_pivot",
    "as_of_bucketed",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
    total = round(sum(times.values()), 4)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
