"""Times the headline queries over whole tables; prints one JSON line.

BENCH_SF_DIR names the test directory, BENCH_CPUS the local cores, BENCH_RUNS the
timed runs per query (the median counts; one run before them warms up). `build` is the part of
a query's time that passes before its result is run: measuring lookups, writing intermediate tables.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from tagquality.fixtures.workload import QUERIES
from tagquality.plans.session import SETTINGS

HEADLINE = [
    "universal_scan",
    "rule_row_flags",
    "error_rate_all_time",
    "dq_daily_trend",
    "freshness_check",
    "completeness_check",
    "health_summary",
    "health_by_project",
    "chargeback_units",
    "chargeback_cost",
    "chargeback_by_table",
    "billing_units",
    "billing_cost",
    "run_timeline_cost",
    "query_usage_by_project",
    "query_usage_exact",
    "full_chargeback",
    "event_anomalies_only",
    "request_validation",
    "dispatch_scans",
    "table_results",
]


def run(df: DataFrame) -> None:
    """Compute every row and column, without bringing them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds, build = {}, {}
    for name in HEADLINE:
        timed, built = [], []
        for _ in range(runs + 1):
            start = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            built.append(time.perf_counter() - start)
            run(df)
            timed.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timed[1:] or timed), 3)
        build[name] = round(statistics.median(built[1:] or built), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "build": build,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
