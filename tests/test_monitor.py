from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tagquality.operators import monitor
from tagquality.schemas import COMMITS, JOB_RUN_TIMELINE, LINEAGE, QUERY_HISTORY, SCHEMATA, TABLE_RESULTS, TABLES

NOW = datetime(2024, 1, 31)
AS_OF = "2024-01-31 00:00:00"


def commits(spark, table, *hours_ago):
    return spark.createDataFrame([(table, NOW - timedelta(hours=h), 1) for h in hours_ago], COMMITS)


def test_freshness(spark):
    late = commits(spark, "late", *range(10, 40))
    fine = commits(spark, "fine", *[h + 0.1 * (h % 3) for h in range(0, 30)])
    young = commits(spark, "young", 100, 200, 300)
    future = commits(spark, "fine", -5)
    got = monitor.freshness(late.union(fine).union(young).union(future), AS_OF)
    rows = {r["table_id"]: r for r in got.collect()}
    assert {t: r["freshness_status"] for t, r in rows.items()} == {
        "late": "Unhealthy", "fine": "Healthy", "young": "Unknown",
    }
    assert rows["late"]["predicted_commit"] == NOW - timedelta(hours=8, minutes=54)
    assert rows["young"]["predicted_commit"] is None and rows["young"]["num_gaps"] == 2
    assert rows["fine"]["last_commit"] == NOW


def test_only_the_last_gaps_count(spark):
    slow_then_fast = [h / 10 for h in range(31)] + [1000 * i for i in range(1, 50)]
    row = monitor.freshness(commits(spark, "t", *slow_then_fast), AS_OF).first()
    assert row["num_gaps"] == 30 and abs(row["median_gap_sec"] - 360) < 1e-6


def test_newest_rows_of_a_hot_key(spark):
    rng = random.Random(3)
    data = [("hot", NOW - timedelta(minutes=rng.randint(0, 10_000))) for _ in range(3000)]
    data += [("cold", NOW - timedelta(days=100 * i)) for i in range(3)]
    data += [("sparse", NOW - timedelta(days=i)) for i in range(30)]
    df = spark.createDataFrame(data, "k STRING, ts TIMESTAMP").repartition(6)
    got = monitor.newest_per_key(df, ["k"], "ts", 20).collect()
    for key in ("hot", "sparse"):
        newest = sorted((t for k, t in data if k == key), reverse=True)[:20]
        assert sorted((r["ts"] for r in got if r["k"] == key), reverse=True) == newest
    assert sum(r["k"] == "cold" for r in got) == 3


def events(spark, per_day, key="t"):
    """`per_day[i]` rows of the key in the i-th day before now."""
    rows = [
        (key, NOW - timedelta(days=day, minutes=1 + i)) for day, n in enumerate(per_day) for i in range(n)
    ]
    return spark.createDataFrame(rows, "k STRING, ts TIMESTAMP")


def volume(df):
    return {r["k"]: r for r in monitor.completeness(df, ["k"], "ts", AS_OF, known=df).collect()}


def test_completeness(spark):
    steady = [100 + (i * 7) % 11 - 5 for i in range(14)]
    df = (
        events(spark, [0, *steady], "stopped")
        .union(events(spark, [98, *steady], "steady"))
        .union(events(spark, [5, 5, 5, 5], "young"))
        .union(events(spark, [1] + [0] * 13 + [9], "gaps"))
        .union(events(spark, [0] * 30 + [50], "ancient"))
    )
    got = volume(df)
    assert got["stopped"]["completeness_status"] == "Unhealthy" and got["stopped"]["actual_rows"] == 0
    assert got["steady"]["completeness_status"] == "Healthy"
    assert (got["young"]["completeness_status"], got["young"]["baseline_days"]) == ("Unknown", 3)
    # Empty days count as zero rows, so the floor is not below zero.
    assert got["gaps"]["baseline_days"] == 14 and got["gaps"]["min_predicted_rows"] == 0.0
    ancient = got["ancient"]
    assert (ancient["completeness_status"], ancient["actual_rows"], ancient["baseline_days"]) == ("Unhealthy", 0, 0)
    assert ancient["min_predicted_rows"] is None and len(got) == 5
    assert monitor.completeness(df, ["k"], "ts", AS_OF).count() == 4


def test_a_table_that_rests_on_weekdays_is_not_flagged(spark):
    """Rows and commits on Saturdays and Sundays only; the 31st is a Wednesday, the 28th a Sunday."""
    weekend = [i for i in range(0, 60) if (NOW - timedelta(days=i)).weekday() >= 5]
    df = events(spark, [200 if (NOW - timedelta(days=d, minutes=1)).weekday() >= 5 else 0 for d in range(29)])
    assert volume(df)["t"]["completeness_status"] == "Healthy"
    got = monitor.freshness(commits(spark, "t", *[24 * i for i in weekend]), AS_OF).first()
    assert got["freshness_status"] == "Healthy" and got["predicted_commit"] > NOW + timedelta(days=3)
    # The same table without its last weekend is late, and a weekend day without rows is short.
    assert monitor.freshness(commits(spark, "t", *[24 * i for i in weekend[2:]]), AS_OF).first()["freshness_status"] == "Unhealthy"
    sunday = "2024-01-29 00:00:00"
    short = df.where(F.col("ts") < F.lit("2024-01-28").cast("timestamp"))
    assert monitor.completeness(short, ["k"], "ts", sunday).first()["completeness_status"] == "Unhealthy"
    assert monitor.completeness(df, ["k"], "ts", sunday).first()["completeness_status"] == "Healthy"


def test_one_outlier_does_not_widen_the_baseline(spark):
    steady = [100, 101, 99] * 9
    got = volume(events(spark, [70, *steady, 10_000], "t"))["t"]
    assert got["completeness_status"] == "Unhealthy" and 99 <= got["expected_rows"] <= 101


def test_filters_on_outcomes_do_not_repeat_the_medians(spark):
    events = commits(spark, "late", *range(10, 40)).union(commits(spark, "fine", *range(0, 30)))
    fresh = monitor.freshness(events, AS_OF)
    volume = monitor.completeness(events, ["table_id"], "commit_time", AS_OF)
    found = monitor.unhealthy_tables(fresh, volume)
    assert "lambdafunction" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.table_id for r in found.collect()} == {r.table_id for r in fresh.collect() if r.freshness_status == "Unhealthy"}


def test_totals_of_a_table(spark):
    rows = [("t", NOW - timedelta(days=3), 100), ("t", NOW - timedelta(hours=5), -20), ("new", NOW, 5), ("t", NOW + timedelta(days=1), 9)]
    got = {r[0]: (r[1], r[2]) for r in monitor.table_totals(spark.createDataFrame(rows, COMMITS), AS_OF).collect()}
    assert got == {"t": (80, 90), "new": (5, None)}


def reachable(edges, root):
    out, here = set(), {root}
    while here:
        here = {b for a, b in edges if a in here} - out
        out |= here
    return out - {root}


def test_downstream_tables_with_cycles_and_a_hub(spark):
    rng = random.Random(2)
    edges = {(f"n{rng.randrange(30)}", f"n{rng.randrange(30)}") for _ in range(45)}
    edges |= {(f"in{i}", "hub") for i in range(60)} | {("hub", f"out{i}") for i in range(40)}
    edges |= {("a", "b"), ("b", "c"), ("c", "a"), ("c", "c"), ("x", "x")} | {(f"chain{i}", f"chain{i + 1}") for i in range(12)}
    lineage = spark.createDataFrame(sorted(edges) * 2, LINEAGE)
    got = {}
    for r in monitor.downstream_tables(lineage).collect():
        assert r["table_id"] not in got.setdefault(r["_root"], set())
        got[r["_root"]].add(r["table_id"])
    want = {root: reachable(edges, root) for root, _ in edges}
    assert got == {root: tables for root, tables in want.items() if tables}
    assert monitor.downstream_tables(lineage.where("false")).isEmpty()


def test_root_causes_are_the_nearest_failed_runs(spark):
    edges = [("job1", "mid"), ("job2", "mid"), ("mid", "end"), ("far", "job2"), ("end", "mid"), ("lone", "lone"), ("ok", "fine")]
    writes = [("job1", 1), ("job1", 2), ("job2", 3), ("far", 4), ("mid", 5), ("end", 6), ("own", 7), ("job2", 9), ("ok", 5)]
    state = {1: "SUCCESS", 2: "FAILED", 3: "FAILED", 4: "FAILED", 5: "SUCCESS", 6: "SUCCESS", 7: "TIMEDOUT", 9: "RUNNING"}
    runs = [(i, f"run{i}", s, NOW, None if s == "RUNNING" else NOW - timedelta(hours=10 - i)) for i, s in state.items()]
    got = monitor.root_causes(
        spark.createDataFrame([(t,) for t in ("end", "own", "lone", "fine", "mid", "unknown")], "table_id STRING"),
        spark.createDataFrame(edges, LINEAGE),
        spark.createDataFrame(writes, "table_id STRING, run_id LONG"),
        spark.createDataFrame(runs, JOB_RUN_TIMELINE),
        AS_OF,
    )
    # job1 failed last, job2 failed and is running again; far is further away than both.
    assert {r[0]: r[1] for r in got.collect()} == {"end": ["run2", "run3"], "mid": ["run2", "run3"], "own": ["run7"]}


def test_day_borders(spark):
    rows = [("t", NOW), ("t", NOW - timedelta(days=1)), ("t", NOW + timedelta(seconds=1)), ("t", NOW - timedelta(days=29))]
    row = volume(spark.createDataFrame(rows, "k STRING, ts TIMESTAMP"))["t"]
    assert (row["actual_rows"], row["baseline_days"]) == (1, 1)


def test_percent_null(spark):
    df = events(spark, [50] * 15).withColumns(
        {
            "late": F.when(F.col("ts") < F.lit(NOW) - F.expr("INTERVAL 1 DAY"), F.lit(1)),
            "never": F.lit(1),
            "rare": F.when(F.rand(5) >= 0, F.lit(1)),
        }
    )
    got = {r["column_name"]: r for r in monitor.percent_null(df, ["late", "never", "rare"], "ts", AS_OF).collect()}
    assert (got["late"]["null_pct"], got["late"]["null_status"]) == (100.0, "Unhealthy")
    assert (got["never"]["null_pct"], got["never"]["null_status"]) == (0.0, "Healthy")
    assert got["rare"]["max_predicted_pct"] == 1.0
    few = monitor.percent_null(events(spark, [5] * 4), ["k"], "ts", AS_OF).first()
    assert few["null_status"] == "Unknown"


def test_assembled_record(spark):
    tables = spark.createDataFrame([(f"{i}", "c", "s", f"t{i}") for i in range(1, 5)], TABLES)
    lineage = spark.createDataFrame([("1", "2"), ("1", "2"), ("1", "3"), ("2", "3")], LINEAGE)
    history = spark.createDataFrame(
        [
            ("a", NOW, "select * from c.s.t2 join c.s.t3", "FINISHED", 1, 1, 1),
            ("b", NOW, "select * from C.S.T3", "FINISHED", 1, 1, 1),
            ("c", NOW, "select * from c.s.t33", "FINISHED", 1, 1, 1),
        ],
        QUERY_HISTORY,
    )
    impact = monitor.downstream_impact(tables, lineage, history, high_tables=2, high_queries=9)
    got = {r[0]: tuple(r)[1:] for r in impact.collect()}
    assert got == {"1": ("HIGH", 2, 2), "2": ("MEDIUM", 1, 2), "3": ("MEDIUM", 0, 2), "4": ("LOW", 0, 0)}

    fresh = monitor.freshness(commits(spark, "1", *range(10, 40)).union(commits(spark, "2", 1)), AS_OF)
    full = monitor.completeness(
        events(spark, [100] * 15, "2").withColumnRenamed("k", "table_id"), ["table_id"], "ts", AS_OF
    )
    schemata = spark.createDataFrame([("c", "s", "77")], SCHEMATA)
    totals = spark.createDataFrame([("1", 80, 90)], "table_id STRING, total_rows LONG, min_total_rows LONG")
    causes = spark.createDataFrame([("1", ["run7"])], "table_id STRING, upstream_jobs ARRAY<STRING>")
    whole = monitor.assemble_results(fresh, full, tables, schemata, impact, AS_OF, totals, causes)
    one, two = whole.orderBy("table_id").collect()
    assert one["completeness"]["total_row_count"].asDict() == {
        "status": "Unhealthy", "error_code": "ROWS_LOST", "last_value": 80, "min_predicted_value": 90,
    }
    assert (one["completeness"]["status"], one["root_cause_analysis"]["upstream_jobs"]) == ("Unhealthy", ["run7"])
    assert two["root_cause_analysis"] is None and two["completeness"]["total_row_count"]["status"] == "Unknown"
    records = monitor.assemble_results(fresh, full, tables, schemata, impact, AS_OF)
    assert [(f.name, f.dataType) for f in records.schema] == [(f.name, f.dataType) for f in TABLE_RESULTS]
    rows = {r["table_id"]: r for r in records.collect()}
    assert set(rows) == {"1", "2"}
    assert (rows["1"]["status"], rows["1"]["completeness"]["status"]) == ("Unhealthy", "Unknown")
    assert (rows["2"]["status"], rows["2"]["freshness"]["status"]) == ("Healthy", "Unknown")
    assert rows["2"]["completeness"]["daily_row_count"]["min_predicted_value"] == 90
    assert rows["2"]["schema_id"] == "77" and rows["2"]["event_time"] == NOW
