"""Compares ways of doing the same work; prints one JSON line per comparison.

    python bench_compare.py [sf directory]
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from bench import run
from tagquality.fixtures.views import ORDERS_AS_OF, SampleTables
from tagquality.fixtures.workload import QUERIES
from tagquality.operators import chargeback, query_usage, scan, tags
from tagquality.operators.rules import BoundRule
from tagquality.plans.session import SETTINGS


def seconds(work: Callable[[], object], runs: int = 3) -> float:
    work()
    timed = []
    for _ in range(runs):
        start = time.perf_counter()
        work()
        timed.append(time.perf_counter() - start)
    return round(statistics.median(timed), 2)


def report(name: str, **values: float) -> None:
    print(json.dumps({"comparison": name, **values}), flush=True)


def rule_passes(t: SampleTables) -> None:
    """All rules of a table in one pass, against one job per rule."""
    table = t.base("lineitem")
    for count in (4, 20, 100):
        rules = [BoundRule("l_quantity", f"r{i}", f"l_quantity > {i / 2}", "error") for i in range(count)]
        one = seconds(lambda: run(scan.scan_table(table, "t", rules, "run", ORDERS_AS_OF)))
        each = seconds(
            lambda: [run(scan.scan_table(table, "t", [r], "run", ORDERS_AS_OF)) for r in rules], 1
        )
        report(
            f"scan of lineitem with {count} rules", one_pass_sec=one, job_per_rule_sec=each
        )


def text_matches(t: SampleTables) -> None:
    """Keys cut from the text, against every statement with every schema."""
    dim = tags.tag_dim(t.schema_tags, t.schemata, "askid")
    history = t.query_history.select("statement_id", "statement_text")
    pattern = F.concat(F.lit("%"), F.upper("catalog_name"), F.lit("."), F.upper("schema_name"), F.lit("%"))
    every = history.join(dim, F.like(F.upper("statement_text"), pattern))
    # Comparing all pairs takes many minutes on the larger directories.
    slow = {"all_pairs_sec": seconds(lambda: run(every), 1)} if history.count() < 50_000 else {}
    report(
        "statements to schemas",
        **slow,
        like_keys_sec=seconds(lambda: run(query_usage.match_by_like(history, dim))),
        identifiers_sec=seconds(lambda: run(query_usage.match_by_identifier(history, dim))),
        like_matches=query_usage.match_by_like(history, dim).count(),
        identifier_matches=query_usage.match_by_identifier(history, dim).count(),
    )


def stream_throughput(t: SampleTables) -> None:
    rows = t.base("events").count()
    taken = seconds(lambda: QUERIES["event_stream"](t.spark, t.sf_dir))
    report("stream of events to files", seconds=taken, rows_per_sec=round(rows / taken))


def hot_key(t: SampleTables) -> None:
    """Usage with a third of its rows on one schema, against the even table."""
    even = t.usage
    third = F.pmod(F.xxhash64("usage_start_time", "sku_name", "usage_quantity"), F.lit(3)) == 0
    hot = even.withColumn(
        "usage_metadata",
        F.col("usage_metadata").withField(
            "schema_id", F.when(third, F.lit("1")).otherwise(F.col("usage_metadata.schema_id"))
        ),
    )
    dim = tags.tag_dim(t.schema_tags, t.schemata, "tenant")
    report(
        "units per tenant",
        even_sec=seconds(lambda: run(chargeback.chargeback_units(even, dim))),
        third_on_one_schema_sec=seconds(lambda: run(chargeback.chargeback_units(hot, dim))),
    )


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    builder = SparkSession.builder.master("local[8]").appName("compare")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = SampleTables(spark, sf_dir)
    for comparison in (rule_passes, text_matches, stream_throughput, hot_key):
        comparison(t)
    spark.stop()


if __name__ == "__main__":
    main()
