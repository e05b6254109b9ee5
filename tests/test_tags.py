from __future__ import annotations

from datetime import datetime

from tagquality.operators import tags
from tagquality.schemas import COLUMN_TAGS, MONITORS, SCHEMA_TAGS, SCHEMATA, TABLE_TAGS


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def schema_tags(spark, *entries):
    return spark.createDataFrame(entries, SCHEMA_TAGS)


def test_a_later_tag_replaces_the_earlier(spark):
    old = schema_tags(spark, ("c", "s", "tenant", "A"), ("c", "s", "askid", "1"), ("c", "t", "tenant", "A"))
    new = schema_tags(spark, ("c", "s", "tenant", "B"), ("c", "u", "tenant", "B"))
    assert rows(tags.set_tags(old, new)) == [
        ("c", "s", "askid", "1"), ("c", "s", "tenant", "B"), ("c", "t", "tenant", "A"), ("c", "u", "tenant", "B"),
    ]


def test_the_last_of_several_new_tags_wins(spark):
    new = spark.createDataFrame(
        [("c", "s", "tenant", "Z", 1), ("c", "s", "tenant", "A", 2)],
        "catalog_name STRING, schema_name STRING, tag_name STRING, tag_value STRING, seq INT",
    )
    got = tags.set_tags(schema_tags(spark, ("x", "y", "n", "v")), new, applied_order="seq")
    assert rows(got) == [("c", "s", "tenant", "A"), ("x", "y", "n", "v")]


def test_listings(spark):
    df = schema_tags(
        spark, ("c", "s", "dqm_monitor", "enabled"), ("c", "s", "dqm_monitor", "enabled"),
        ("c", "t", "dqm_monitor", "off"), ("d", "s", "askid", "P"),
    )
    assert rows(tags.tagged_schemas(df)) == [("c", "s")]
    assert rows(tags.tagged_schemas(df, audit=True)) == [("c", "s", "dqm_monitor", "enabled")]
    assert tags.list_tags(df, "c").count() == 3
    assert tags.list_tag_values(df).columns == ["catalog_name", "schema_name", "dqm_tag_value"]
    assert rows(tags.owner_inventory(df, "askid")) == [("P", "d", "s", "askid")]


def test_enrolment(spark):
    df = schema_tags(
        spark,
        *[("c", s, "dqm_monitor", "enabled") for s in ("new", "old", "x" * 200)],
        ("c", "other", "dqm_monitor", "no"),
    )
    schemata = spark.createDataFrame([("c", s, s) for s in ("new", "old", "other")], SCHEMATA)
    monitors = spark.createDataFrame([("c", "old", datetime(2020, 1, 1))], MONITORS)
    after, report = tags.enrol(df, schemata, monitors, as_of="2024-01-01")
    status = {r[0]: r[1] for r in report.collect()}
    assert status["c.new"] == "ENABLED" and status["c.old"] == "ALREADY ENABLED"
    error = status["c." + "x" * 200]
    assert error == f"ERROR: Schema 'c.{'x' * 200}' does not exist."
    assert len(status) == 3
    assert rows(after) == [("c", "new", datetime(2024, 1, 1)), ("c", "old", datetime(2020, 1, 1))]
    again = tags.enrol_schema(schemata, after, "c", "old", as_of="2024-02-02")
    assert rows(again) == [("c", "new", datetime(2024, 1, 1)), ("c", "old", datetime(2024, 2, 2))]
    assert rows(tags.enrol_schema(schemata, after, "c", "missing")) == rows(after)


def test_excluded_tables(spark):
    bindings = spark.createDataFrame(
        [("c", "s", t, "col") for t in ("a", "b")],
        "catalog_name STRING, schema_name STRING, table_name STRING, column_name STRING",
    )
    marks = spark.createDataFrame(
        [("c", "s", "a", "dqm_exclude", "true"), ("c", "s", "b", "dqm_exclude", "false")], TABLE_TAGS
    )
    kept, excluded = tags.split_excluded(bindings, marks)
    assert [r["table_name"] for r in kept.collect()] == ["b"]
    assert [r["table_name"] for r in excluded.collect()] == ["a"]


def test_bindings_are_not_sorted_to_leave_out_excluded_tables(spark):
    columns = "catalog_name STRING, schema_name STRING, table_name STRING, rule_name STRING"
    bindings = spark.createDataFrame([("c", "s", f"t{k % 50}", f"r{k}") for k in range(500)] + [("c", "s", None, "r")], columns)
    marks = spark.createDataFrame([("c", "s", f"t{k}", "dqm_exclude", "true") for k in range(10)] * 2, TABLE_TAGS)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, "-1")
    try:
        kept, excluded = tags.split_excluded(bindings, marks)
        assert (kept.count(), excluded.count()) == (401, 100)
        for part in (kept, excluded):
            assert "Sort" not in part._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(limit)


def test_dimension_repeats_a_schema_of_two_owners(spark):
    schemata = spark.createDataFrame([("c", "s", "1"), ("c", "t", "2")], SCHEMATA)
    df = schema_tags(spark, ("c", "s", "askid", "P"), ("c", "s", "askid", "Q"), ("c", "gone", "askid", "R"))
    assert rows(tags.tag_dim(df, schemata, "askid")) == [("P", "1", "c", "s"), ("Q", "1", "c", "s")]


def test_tagged_columns(spark):
    df = spark.createDataFrame(
        [("c", "s", "t", "x", "dq", "name"), ("d", "s", "t", "y", "dq", "mail"), ("c", "u", "t", "z", "dq", "n")],
        COLUMN_TAGS,
    )
    assert tags.tagged_columns(df, "dq", "s").count() == 2
    assert [r["column_name"] for r in tags.tagged_columns(df, "dq", "s", "c").collect()] == ["x"]
