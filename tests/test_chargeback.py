from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tagquality.functions import table_functions
from tagquality.operators import chargeback
from tagquality.schemas import JOB_RUN_TIMELINE, JOBS, LIST_PRICES, POLICIES, USAGE
from tagquality.sources.tables import promote_tags, write_promoted

PRODUCT = "DATA_QUALITY_MONITORING"
SCAN = {"cost_center": "DQ-Scanning"}


def usage(spark, *rows):
    """Rows of (start, sku, quantity, schema, table, run, tags)."""
    full = [
        (s.date(), s, "ws", sku, Decimal(q), PRODUCT, (schema, table, "job", run, None), tags)
        for s, sku, q, schema, table, run, tags in rows
    ]
    return spark.createDataFrame(full, USAGE)


def prices(spark, *rows):
    return spark.createDataFrame([(k, a, b, ((Decimal(p),),)) for k, a, b, p in rows], LIST_PRICES)


def dim(spark, *rows):
    return spark.createDataFrame(
        rows, "tenant STRING, schema_id STRING, catalog_name STRING, schema_name STRING"
    )


def at(day, hour=0, month=1):
    return datetime(2024, month, day, hour)


def test_price_edges(spark):
    df = usage(
        spark,
        (at(1), "A", 1, "1", "t", "r", {}),
        (at(10), "A", 1, "1", "t", "r", {}),
        (at(20), "OPEN", 1, "1", "t", "r", {}),
        (at(20), "NONE", 1, "1", "t", "r", {}),
        (at(5), "TWICE", 1, "1", "t", "r", {}),
    )
    listed = prices(
        spark,
        ("A", at(1), at(10), "0.5"),
        ("OPEN", at(1), None, "2"),
        ("TWICE", at(1), at(9), "1"),
        ("TWICE", at(4), None, "3"),
    )
    priced = chargeback.price_usage(df, listed)
    got = sorted((r["sku_name"], r["usage_start_time"].day, float(r["cost_usd"])) for r in priced.collect())
    assert got == [("A", 1, 0.5), ("OPEN", 20, 2.0), ("TWICE", 5, 1.0), ("TWICE", 5, 3.0)]
    overlaps = chargeback.check_price_overlaps(listed).collect()
    assert [r["sku_name"] for r in overlaps] == ["TWICE"]


def test_many_periods_of_a_sku_are_met_by_time(spark):
    """10,000 hourly prices of one SKU, overlapping and open ones beside: a usage row meets a few of them."""
    listed = spark.range(10_000).selectExpr(
        "'A' AS sku_name", "TIMESTAMP '2023-01-01' + make_dt_interval(0, CAST(id AS INT)) AS price_start_time",
        "TIMESTAMP '2023-01-01' + make_dt_interval(0, CAST(id AS INT) + 1) AS price_end_time",
        "named_struct('effective_list', named_struct('default', CAST(id % 7 + 1 AS DECIMAL(18, 6)))) AS pricing",
    )
    more = prices(
        spark, ("A", datetime(2023, 1, 1), None, "100"), ("A", datetime(2023, 3, 1), datetime(2023, 3, 9), "50"),
        ("B", datetime(2023, 1, 1), None, "2"), ("A", datetime(2023, 5, 1), datetime(2023, 4, 1), "999"),
    )
    listed = listed.unionByName(more.select(listed.columns))
    df = spark.range(400).selectExpr(
        "CAST(TIMESTAMP '2022-12-30' + make_dt_interval(0, CAST(id AS INT) * 31) AS TIMESTAMP) AS usage_start_time",
        "IF(id % 10 = 0, 'B', 'A') AS sku_name", "CAST(1 AS DECIMAL(18, 6)) AS usage_quantity", "id",
    )
    by_time = chargeback.price_usage(df, listed)
    plain = chargeback.price_usage(df, listed, few=1_000_000)
    assert by_time.columns == plain.columns
    assert sorted(map(str, by_time.collect())) == sorted(map(str, plain.collect()))
    periods = listed.selectExpr(
        "sku_name", "price_start_time AS _from", "COALESCE(price_end_time, TIMESTAMP '2099-12-31') AS _until"
    )
    placed = chargeback.binned_periods(periods, chargeback.price_grid(periods))
    met = placed.groupBy("sku_name", "_bin").count().orderBy(F.desc("count")).first()["count"]
    assert met <= 6 and placed.count() <= 4 * 10_000
    assert chargeback.price_usage(df, listed.where("false")).isEmpty()


def test_promoted_tags_let_the_scan_skip_row_groups(spark, tmp_path):
    rows = [
        (at(1 + i % 28), "A", 1, "1", "t", f"{i}", {"cost_center": f"center {i % 50:02}", "billing_code": f"code {i % 997}"})
        for i in range(6000)
    ]
    df = usage(spark, *rows)
    path = str(tmp_path / "usage")
    spark.conf.set("parquet.block.size", "4096")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "4096")
    try:
        write_promoted(df, path, ["cost_center", "billing_code", "requesting_team"], partitions=2)
    finally:
        spark.conf.unset("parquet.block.size")
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    stored = spark.read.parquet(path)
    files = [f for f in (tmp_path / "usage").glob("*.parquet")]
    assert sum(pq.ParquetFile(f).num_row_groups for f in files) >= 10
    report = chargeback.billing_units(stored, "center 07")
    text = report._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(cost_center)" in text and "EqualTo(cost_center,center 07)" in text
    assert rows_read(stored.where("cost_center = 'center 07'")) <= 6000 / 4
    assert rows_read(stored.where("billing_code = 'code 5'")) <= 6000 / 2
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, chargeback.billing_units(df, "center 07").collect()))
    stored.createOrReplaceTempView("promoted_usage")
    df.createOrReplaceTempView("mapped_usage")
    answers = []
    for view in ("promoted_usage", "mapped_usage"):
        table_functions.register_chargeback_function(spark, view, f"fn_{view}", "center 07")
        answers.append(sorted(map(tuple, spark.sql(f"SELECT * FROM fn_{view}(NULL, 3, DATE '2024-02-01')").collect())))
    assert answers[0] == answers[1] != []
    sql = spark.sql("SELECT * FROM fn_promoted_usage(NULL, 3, DATE '2024-02-01')")._jdf.queryExecution().toString()
    assert "EqualTo(cost_center,center 07)" in sql


def rows_read(df):
    """Rows that the parquet scan of a plan has handed on, after row groups were left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def test_overlap_with_an_early_long_period(spark):
    listed = prices(
        spark, ("A", at(1), at(30), "1"), ("A", at(2), at(3), "1"), ("A", at(5), at(6), "1"),
        ("B", at(1), at(2), "1"), ("B", at(2), at(3), "1"),
    )
    found = chargeback.check_price_overlaps(listed)
    assert sorted(r["price_start_time"].day for r in found.collect()) == [2, 5]


def test_units_and_cost_per_tenant(spark):
    df = usage(
        spark,
        (at(1), "A", 2, "1", "t", "r", {}),
        (at(2), "A", 3, "2", "t", "r", {}),
        (at(2), "A", 5, None, "t", "r", {}),
        (at(2, month=2), "A", 7, "1", "t", "r", {}),
        (at(2), "A", 9, "untagged", "t", "r", {}),
    )
    owners = dim(spark, ("T", "1", "c", "s1"), ("T", "2", "c", "s2"), ("U", "1", "c", "s1"))
    units = chargeback.chargeback_units(df, owners)
    got = {(r[0], r[2], r[3].month): (float(r[4]), r[5]) for r in units.collect()}
    assert got == {
        ("T", "s1", 1): (2.0, 1), ("T", "s2", 1): (3.0, 1), ("T", "s1", 2): (7.0, 1),
        ("U", "s1", 1): (2.0, 1), ("U", "s1", 2): (7.0, 1),
    }
    listed = prices(spark, ("A", at(1), None, "0.10"))
    cost = chargeback.chargeback_cost(df, owners, listed)
    got = {(r[0], r[1].month): (float(r[2]), float(r[3])) for r in cost.collect()}
    assert got == {("T", 1): (5.0, 0.5), ("T", 2): (7.0, 0.7), ("U", 1): (2.0, 0.2), ("U", 2): (7.0, 0.7)}
    assert isinstance(cost.first()["estimated_cost_usd"], Decimal)


def test_cost_by_table_keeps_all_usage(spark):
    df = usage(
        spark,
        (at(1), "A", 1, "1", "t1", "r", {}),
        (at(1), "A", 2, "1", "unknown", "r", {}),
        (at(1), "A", 4, None, None, "r", {}),
    )
    names = spark.createDataFrame(
        [("t1", "c", "s", "orders")],
        "table_id STRING, catalog_name STRING, schema_name STRING, table_name STRING",
    )
    got = chargeback.chargeback_by_table(df, dim(spark, ("T", "1", "c", "s")), names)
    rows = sorted(((r[0], r[1], float(r[3]), r[4]) for r in got.collect()), key=repr)
    assert rows == [("T", "c.s.orders", 1.0, 1), ("T", "unknown", 2.0, 1), (None, None, 4.0, 1)]
    total = got.agg(F.sum("total_dbus")).first()[0]
    assert float(total) == 7.0


def tagged(spark):
    orchid = {**SCAN, "billing_code": "ORCHID", "requesting_team": "Orchid"}
    return usage(
        spark,
        (at(1), "A", 1, "1", "t", "7", orchid),
        (at(2), "A", 2, "1", "t", "7", orchid),
        (at(3), "A", 4, "1", "t", "8", SCAN),
        (at(4), "A", 8, "1", "t", "9", {**orchid, "cost_center": "Other"}),
        (at(5, month=6), "A", 16, "1", "t", None, {**orchid, "billing_code": "BASALT"}),
    )


def test_tags_on_usage(spark):
    df = tagged(spark)
    assert [float(r["dbus"]) for r in chargeback.tagged_usage(df).collect()] == [16.0, 2.0, 1.0]
    assert chargeback.tagged_usage(df, n=1).count() == 1
    units = {(r[0], r[2].month): (float(r[3]), r[4], r[5]) for r in chargeback.billing_units(df).collect()}
    assert units == {("ORCHID", 1): (3.0, 1, 2), ("BASALT", 6): (16.0, 0, 1)}
    summary = {r["billing_code"]: float(r["dbus"]) for r in chargeback.billing_summary(df).collect()}
    assert summary == {"ORCHID": 3.0, None: 4.0, "BASALT": 16.0}
    listed = prices(spark, ("A", at(1), at(2), "0.5"))
    assert [float(r["estimated_cost_usd"]) for r in chargeback.billing_cost(df, listed).collect()] == [0.5]
    assert [r["scan_type"] for r in chargeback.run_detail(df).collect()] == [None] * 3


def test_promoted_tags_give_the_same(spark):
    df = tagged(spark)
    keys = ["billing_code", "requesting_team", "cost_center"]
    promoted = promote_tags(df, keys)
    assert chargeback.billing_units(promoted).collect() == chargeback.billing_units(df).collect()
    assert promoted.select("usage_month").distinct().count() == 2


def test_months_back(spark):
    df = tagged(spark)
    assert chargeback.fn_chargeback(df, as_of="2024-06-30").count() == 1
    assert chargeback.fn_chargeback(df, months_back=6, as_of="2024-06-30").count() == 2
    one = chargeback.fn_chargeback(df, "ORCHID", 6, "2024-06-30").collect()
    assert [(r["billing_code"], r["total_dbus"], r["scan_runs"]) for r in one] == [("ORCHID", 3.0, 1)]


def test_run_cost(spark):
    timeline = spark.createDataFrame(
        [
            (7, "seven", "SUCCESS", at(1), datetime(2024, 1, 1, 0, 1, 59)),
            (7, "seven", "SUCCESS", at(2), datetime(2024, 1, 2, 0, 0, 59)),
            (8, "eight", "FAILED", at(3), at(3, 2)),
            (9, "nine", "FAILED", at(3), at(3, 2)),
        ],
        JOB_RUN_TIMELINE,
    )
    rows = chargeback.run_cost(timeline, tagged(spark)).collect()
    got = [(r["run_name"], r["duration_minutes"], r["billing_code"], float(r["total_dbus"])) for r in rows]
    assert got == [("eight", 120, None, 4.0), ("seven", 0, "ORCHID", 3.0), ("seven", 1, "ORCHID", 3.0)]


def test_tags_come_from_policy_or_job(spark):
    base = usage(spark, *[(at(1), "A", i, "1", "t", "r", {"old": "x"}) for i in (1, 2, 3)])
    df = base.withColumns(
        {
            "is_serverless": F.col("usage_quantity") < 3,
            "policy_id": F.when(F.col("usage_quantity") == 1, "p"),
        }
    )
    policies = spark.createDataFrame([("p", "P", [("billing_code", "POL")])], POLICIES)
    jobs = spark.createDataFrame([("job", "J", {"billing_code": "JOB"})], JOBS)
    got = chargeback.resolve_tags(df, policies, jobs).collect()
    assert {int(r["usage_quantity"]): r["custom_tags"] for r in got} == {
        1: {"billing_code": "POL"}, 2: {}, 3: {"billing_code": "JOB"},
    }


def test_month_is_a_date(spark):
    df = tagged(spark)
    assert dict(chargeback.billing_units(df).dtypes)["usage_month"] == "date"
    assert chargeback.billing_summary(df).first()["month"] == date(2024, 6, 1)
