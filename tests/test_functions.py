from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from tagquality.functions import table_functions
from tagquality.operators import chargeback, scores
from tagquality.schemas import DQ_RESULTS, USAGE


def test_score_function(spark):
    df = spark.createDataFrame(
        [
            ("a.b.people", "c", "r", 100, 6, 0, datetime(2024, 1, 2), "a"),
            ("a.b.places", "c", "r", 0, 0, 0, datetime(2024, 1, 2), "a"),
            ("a.b.people", "c", "r", 100, 50, 0, datetime(2024, 1, 1), "z"),
        ],
        DQ_RESULTS,
    )
    df.createOrReplaceTempView("fn_results")
    table_functions.register_score_function(spark, "fn_results", "fn_score")
    got = spark.sql("SELECT * FROM fn_score('people')").collect()
    assert got == scores.fn_score(df, "people").collect()
    assert spark.sql("SELECT status FROM fn_score('places')").first()[0] == "NO DATA"
    table_functions.register_score_function(spark, "fn_results", "fn_by_id", "run_id")
    assert spark.sql("SELECT status FROM fn_by_id('people')").first()[0] == "FAIL"
    joined = spark.sql("SELECT n, f.status FROM VALUES ('people') AS v(n), LATERAL fn_score(v.n) AS f")
    assert joined.collect() == [("people", "WARN")]


def test_trend_function_defaults_to_thirty_days(spark):
    now = datetime.now()
    df = spark.createDataFrame(
        [("t", "c", "r", 100, 10, 0, now - timedelta(days=d), "a") for d in (1, 29, 31)], DQ_RESULTS
    )
    df.createOrReplaceTempView("fn_trend_results")
    table_functions.register_trend_function(spark, "fn_trend_results", "fn_trend")
    assert spark.sql("SELECT * FROM fn_trend('t')").count() == 2
    assert spark.sql("SELECT * FROM fn_trend('t', 40)").count() == 3
    assert sorted(spark.sql("SELECT * FROM fn_trend('t')").collect()) == sorted(
        scores.fn_trend(df, "t").collect()
    )


def test_chargeback_function_defaults(spark):
    now = datetime.now()
    tags = {"cost_center": "DQ-Scanning", "requesting_team": "T"}
    rows = [(0, "A"), (40, "B"), (400, "A"), (1, None)]
    df = spark.createDataFrame(
        [
            ((now - timedelta(days=d)).date(), now, "w", "s", Decimal(2), "P", ("1", "2", "3", "4", None),
             {**tags, **({"billing_code": c} if c else {})})
            for d, c in rows
        ],
        USAGE,
    )
    df.createOrReplaceTempView("fn_usage")
    table_functions.register_chargeback_function(spark, "fn_usage", "fn_charge")

    def codes(call):
        return sorted(r["billing_code"] for r in spark.sql(f"SELECT * FROM {call}").collect())

    assert codes("fn_charge()") == ["A", "B"]
    assert codes("fn_charge('A')") == ["A"]
    assert codes("fn_charge(NULL, 24)") == ["A", "A", "B"]
    assert codes("fn_charge(months_back => 24, target_billing_code => 'A')") == ["A", "A"]
    assert sorted(spark.sql("SELECT * FROM fn_charge()").collect()) == sorted(
        chargeback.fn_chargeback(df).collect()
    )
