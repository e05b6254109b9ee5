from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tagquality.operators import scores
from tagquality.schemas import DQ_RESULTS


def results(spark, *rows):
    """Rows of (table, rule, total, errors, day, run)."""
    return spark.createDataFrame(
        [(t, "c", r, n, e, 0, datetime(2024, 1, d), run) for t, r, n, e, d, run in rows], DQ_RESULTS
    )


def test_newest_run_and_largest_id_differ(spark):
    df = results(spark, ("old", "r", 10, 1, 1, "zz"), ("new", "r", 10, 2, 2, "aa"))
    assert scores.latest_run_rates(df).first()["table_name"] == "new"
    assert scores.latest_run_rates(df, "run_id").first()["table_name"] == "old"
    assert scores.fn_score(df, "", "run_id").first()["table_name"] == "old"
    with pytest.raises(ValueError):
        scores.latest_run(df, "luck")


def test_status_of_rate_and_of_score_differ_at_the_edge(spark):
    df = results(spark, ("t", "r", 100_000, 5_004, 1, "a"))
    by_score = scores.table_scores(df).first()
    assert (by_score["score"], by_score["status"]) == (95.0, "PASS")
    by_rate = scores.fn_score(df, "t").first()
    assert (by_rate["error_rate_pct"], by_rate["status"]) == (5.0, "WARN")


@pytest.mark.parametrize(("errors", "status"), [(5, "PASS"), (6, "WARN"), (20, "WARN"), (21, "FAIL")])
def test_status_limits(spark, errors, status):
    df = results(spark, ("t", "r", 100, errors, 1, "a"))
    assert scores.fn_score(df, "t").first()["status"] == status
    assert scores.table_scores(df).first()["status"] == status


def test_tables_without_data(spark):
    df = results(spark, ("zero", "r", 0, 0, 1, "a"), ("full", "r", 10, 0, 1, "a"))
    wanted = spark.createDataFrame([("zero",), ("full",), ("never",)], "table_name STRING")
    got = {r["table_name"]: (r["score"], r["status"]) for r in scores.table_scores(df, wanted).collect()}
    assert got == {"zero": (None, "NO DATA"), "never": (None, "NO DATA"), "full": (100.0, "PASS")}
    assert scores.fn_score(df, "zero").first()["status"] == "NO DATA"
    assert scores.error_rates(df).where("table_name = 'zero'").first()["error_rate_pct"] is None


def test_rates_round_half_up(spark):
    df = results(spark, ("t", "r", 800, 1, 1, "a"), ("u", "r", 200_000, 2_010, 1, "a"))
    got = {r["table_name"]: r["error_rate_pct"] for r in scores.error_rates(df).collect()}
    assert got == {"t": 0.13, "u": 1.01}


def test_mean_of_rates_is_not_rate_of_sums(spark):
    df = results(spark, ("t", "r", 10, 10, 1, "a"), ("t", "r", 990, 0, 1, "b"))
    assert scores.daily_trend(df).first()["avg_error_rate"] == 50.0
    assert scores.error_rates(df).first()["error_rate_pct"] == 1.0


def test_trend_window(spark):
    df = results(spark, ("t", "r", 10, 1, 1, "a"), ("t", "r", 10, 3, 20, "b"), ("x", "r", 10, 3, 20, "b"))
    got = scores.fn_trend(df, "t", 15, "2024-01-31 00:00:00").collect()
    assert [(str(r["scan_day"]), r["avg_error_rate"], r["total_scans"]) for r in got] == [
        ("2024-01-20", 30.0, 1)
    ]
    assert scores.fn_trend(df, "t", 30, "2024-01-31 00:00:00").count() == 2


def test_scorecard_and_top(spark):
    df = results(
        spark, *[(f"t{i}", "r", 100, i * 5, 1, "a") for i in range(8)], ("t7", "s", 100, 0, 1, "a")
    )
    failing = scores.scorecard(df, "FAIL").select("table_name").collect()
    assert [r[0] for r in failing] == ["t6", "t5"]
    top = scores.top_tables(df, 3).collect()
    assert [(r["table_name"], r["error_rate_pct"]) for r in top] == [
        ("t6", 30.0), ("t5", 25.0), ("t4", 20.0),
    ]


def test_partitioning_does_not_matter(spark):
    df = results(spark, *[("t", "r", 7 + i, i % 5, 1 + i % 20, f"{i}") for i in range(200)])
    for build in (scores.daily_trend, scores.error_rates, scores.scorecard):
        one = build(df.coalesce(1)).collect()
        many = build(df.repartition(7, F.rand(1))).collect()
        assert sorted(one) == sorted(many)
