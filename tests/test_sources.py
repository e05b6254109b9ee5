from __future__ import annotations

from datetime import datetime

from tagquality.operators import profile, scan
from tagquality.operators.rules import BoundRule
from tagquality.schemas import COLUMN_TAGS, DQ_RESULTS, RULE_MAPPING
from tagquality.sources import tables


def test_create_insert_append(spark):
    tables.create_table(spark, "rule_mapping_t", RULE_MAPPING)
    columns = ["tag_name", "tag_value", "rule_name", "sql_expression", "criticality"]
    rows = tables.rows_of(spark, RULE_MAPPING, columns, [("dq", "x", "Positive", "{col} > 0", "error")])
    tables.append_table(rows, "rule_mapping_t")
    assert tuple(spark.table("rule_mapping_t").first())[-1] is None
    tables.create_table(spark, "rule_mapping_t", RULE_MAPPING)
    assert spark.table("rule_mapping_t").count() == 1
    tables.create_table(spark, "rule_mapping_t", RULE_MAPPING, replace=True)
    assert spark.table("rule_mapping_t").count() == 0
    spark.sql("DROP TABLE rule_mapping_t")


def test_scan_from_catalog_into_partitioned_results(spark, tmp_path):
    spark.createDataFrame([(1,), (-1,)], "n INT").write.mode("overwrite").saveAsTable("numbers_t")
    tags = spark.createDataFrame([("spark_catalog", "default", "numbers_t", "n", "dq", "x")], COLUMN_TAGS)
    columns = ["tag_name", "tag_value", "rule_name", "sql_expression", "criticality"]
    mapping = tables.rows_of(spark, RULE_MAPPING, columns, [("dq", "x", "Positive", "{col} > 0", "error")])
    path = str(tmp_path / "results")
    run_id = scan.run_scan_into(
        tags, mapping, tables.catalog_resolver(spark), lambda df: tables.append_results(df, path)
    )
    row = spark.read.parquet(path).first()
    assert (row["run_id"], row["total_rows"], row["rows_error"]) == (run_id, 2, 1)
    assert list((tmp_path / "results").glob("scan_day=*"))
    spark.sql("DROP TABLE numbers_t")


def test_results_have_the_declared_columns(spark):
    df = spark.createDataFrame([(1,)], "n INT")
    got = scan.scan_table(df, "t", [BoundRule("n", "r", "n > 0", "error")], "run", "2024-01-01")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in DQ_RESULTS]
    assert got.first()["scan_date"] == datetime(2024, 1, 1)


def test_parquet_resolver(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "things.parquet"))
    resolve = tables.parquet_resolver(spark, str(tmp_path))
    assert resolve("catalog.schema.things").count() == 3


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "v STRING, `odd name` INT")
    counts = {r[0]: r[1] for r in profile.row_counts({"t": df, "none": df.where("false")}).collect()}
    assert counts == {"t": 3, "none": 0}
    nulls = {r["column_name"]: (r["null_rows"], r["null_pct"]) for r in profile.null_profile(df).collect()}
    assert nulls == {"v": (1, 33.33), "odd name": (1, 33.33)}
    assert profile.null_profile(df.where("false")).count() == 0
    assert {r["v"]: r["count"] for r in profile.value_counts(df, "v").collect()} == {"a": 2, None: 1}
