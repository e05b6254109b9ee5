from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tagquality.operators import registry
from tagquality.schemas import CLIENT_REGISTRY, SCAN_AUDIT_LOG, SCAN_REQUESTS

BINDING = (
    "catalog_name STRING, schema_name STRING, table_name STRING, column_name STRING, "
    "rule_name STRING, sql_expression STRING, criticality STRING"
)
T0 = datetime(2020, 1, 1)


def clients(spark):
    return spark.createDataFrame(
        [
            ("A", "Orchid", "a@a.co", "c.s, c.t", True, T0),
            ("B", "Busy", None, None, True, T0),
            ("X", "Gone", None, "c.s", False, T0),
        ],
        CLIENT_REGISTRY,
    )


def requests(spark):
    return spark.createDataFrame(
        [
            ("known", "A", "c.s", "me"),
            ("default", "A", None, "me"),
            ("empty", "A", "", "me"),
            ("two", "A", " c.s , c.t,c.s,", "me"),
            ("outside", "A", "c.secret", "me"),
            ("unknown", "Z", "c.s", "me"),
            ("inactive", "X", "c.s", "me"),
            ("nothing", "B", None, "me"),
            ("nocode", None, None, "me"),
        ],
        SCAN_REQUESTS,
    )


def bindings(spark):
    return spark.createDataFrame(
        [
            ("c", "s", "t1", "n", "Positive", "{col} > 0", "error"),
            ("c", "t", "t2", "n", "Positive", "{col} > 0", "error"),
            ("c", "secret", "t3", "n", "Positive", "{col} > 0", "error"),
        ],
        BINDING,
    )


def test_merge_never_changes_a_client(spark):
    new = spark.createDataFrame([("A", "Renamed"), ("N", "New")], "billing_code STRING, client_name STRING")
    rows = {r["billing_code"]: r for r in registry.register_clients(clients(spark), new, "2024-05-05").collect()}
    assert rows["A"]["client_name"] == "Orchid" and rows["A"]["created_at"] == T0
    assert rows["N"]["is_active"] is True and rows["N"]["created_at"] == datetime(2024, 5, 5)
    assert rows["N"]["contact_email"] is None and len(rows) == 4


def test_merge_refuses_a_null_key(spark):
    new = spark.createDataFrame([(None, "Nobody")], "billing_code STRING, client_name STRING")
    with pytest.raises(Exception, match="billing_code must not be null"):
        registry.register_clients(clients(spark), new).collect()


def test_validation(spark):
    rows = {r["request_id"]: r for r in registry.validate_requests(requests(spark), clients(spark)).collect()}
    assert {k for k, r in rows.items() if r["is_valid"]} == {"known", "default", "empty", "two", "outside", "nothing"}
    assert rows["default"]["target_schemas"] == rows["empty"]["target_schemas"] == "c.s, c.t"
    assert rows["unknown"]["reason"] == rows["inactive"]["reason"] == "Unknown or inactive billing code"
    assert rows["nothing"]["target_schemas"] is None


def test_dispatch_and_rejects(spark):
    work = registry.dispatch(requests(spark), clients(spark), bindings(spark))
    got = sorted((r["request_id"], r["schema_name"]) for r in work.collect())
    assert got == [
        ("default", "s"), ("default", "t"), ("empty", "s"), ("empty", "t"), ("known", "s"), ("two", "s"), ("two", "t"),
    ]
    assert work.first()["cost_center"] == "DQ-Scanning"
    refused = registry.rejected(requests(spark), clients(spark))
    assert {(r["request_id"], r["schema_full_name"]) for r in refused.collect()} == {
        ("unknown", None), ("inactive", None), ("nocode", None), ("outside", "c.secret"),
    }
    free = registry.dispatch(requests(spark), clients(spark), bindings(spark), enforce_allowed=False)
    assert ("outside", "secret") in {(r["request_id"], r["schema_name"]) for r in free.collect()}
    assert registry.rejected(requests(spark), clients(spark), enforce_allowed=False).count() == 3


def test_summary_counts_pairs_without_making_them(spark):
    args = requests(spark), clients(spark), bindings(spark)
    pairs = registry.dispatch(*args).groupBy("billing_code", "schema_name", "rule_name").agg(
        F.countDistinct("request_id"), F.count(F.lit(1))
    )
    summary = registry.dispatch_summary(*args)
    got = summary.select("billing_code", "schema_name", "rule_name", "requests", "bindings")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pairs.collect()))
    # A thousand requests of one client make no more rows in the join than one.
    known = clients(spark)
    many = spark.createDataFrame([(f"{i}", "A", "c.s", "me") for i in range(1000)], SCAN_REQUESTS)
    work = spark.range(500).selectExpr(
        "'c' AS catalog_name", "'s' AS schema_name", "'t' || id AS table_name", "'n' AS column_name",
        "'R' || id % 5 AS rule_name", "'{col} > 0' AS sql_expression", "'error' AS criticality",
    )
    rows = registry.dispatch_summary(many, known, work).collect()
    assert len(rows) == 5 and {(r["requests"], r["bindings"]) for r in rows} == {(1000, 100_000)}


def test_requests_share_one_scan_per_table(spark):
    read = []

    def resolve(name):
        read.append(name)
        return spark.createDataFrame([(1,), (-1,)], "n INT")

    got = registry.run_requests(requests(spark), clients(spark), bindings(spark), resolve, "2024-01-01")
    rows = sorted((r["run_id"], r["table_name"], r["rows_error"]) for r in got.collect())
    assert len(rows) == 7 and {r[2] for r in rows} == {1}
    assert sorted(read) == ["c.s.t1", "c.t.t2"]
    none = registry.run_requests(requests(spark).where("false"), clients(spark), bindings(spark), resolve)
    assert none is None


def test_audit(spark):
    valid = registry.validate_requests(requests(spark), clients(spark))
    rows = registry.audit_rows(valid, "2024-01-01")
    assert rows.columns == SCAN_AUDIT_LOG.fieldNames()
    assert rows.count() == 6
    logged = {r["request_id"]: (r["schemas_scanned"], r["status"]) for r in rows.collect()}
    assert logged["default"] == logged["two"] == ("c.s,c.t", "SUBMITTED")
    assert logged["outside"] == logged["nothing"] == (None, "REJECTED")
    mixed = spark.createDataFrame([("m", "A", "c.secret, c.t", "me")], SCAN_REQUESTS)
    checked = registry.validate_requests(mixed, clients(spark))
    assert registry.audit_rows(checked).first()["schemas_scanned"] == "c.t"
    assert registry.audit_rows(checked, enforce_allowed=False).first()["schemas_scanned"] == "c.secret,c.t"
    unnamed = spark.createDataFrame([(None, "A", None, "me")], SCAN_REQUESTS)
    entry = registry.audit_rows(registry.validate_requests(unnamed, clients(spark))).first()
    assert len(entry["request_id"]) == 36 and entry["job_run_id"] == f"scan-A-{entry['request_id']}"
    assert entry["request_id"] != ""
    log = spark.createDataFrame([("a", T0), ("b", datetime(2021, 1, 1))], "request_id STRING, request_time TIMESTAMP")
    assert [r["request_id"] for r in registry.audit_log(log).collect()] == ["b", "a"]


def test_audit_rows_are_appended_once_and_get_states(spark, tmp_path):
    path = str(tmp_path / "audit")
    assert registry.read_log(spark, path, SCAN_AUDIT_LOG).isEmpty()
    rows = registry.audit_rows(registry.validate_requests(requests(spark), clients(spark)), "2024-01-01")
    registry.append_audit(rows.where("request_id <> 'two'"), path)
    registry.append_audit(rows.unionByName(rows), path)
    log = registry.read_log(spark, path, SCAN_AUDIT_LOG)
    assert log.count() == 6 and log.select("request_id").distinct().count() == 6
    states = registry.audit_states(log.where("request_id = 'two'"), "RUNNING", "2024-01-02").unionByName(
        registry.audit_states(log.where("request_id IN ('two', 'known')"), "COMPLETED", "2024-01-03")
    )
    got = {r["request_id"]: r["status"] for r in registry.audit_log(log, states).collect()}
    assert got == {
        "two": "COMPLETED", "known": "COMPLETED", "default": "SUBMITTED", "empty": "SUBMITTED",
        "outside": "REJECTED", "nothing": "REJECTED",
    }


def test_audit_log_of_one_time_is_sorted_in_several_tasks(spark):
    rows = spark.range(5000, -1, -1).selectExpr("lpad(id, 6, '0') AS request_id", "TIMESTAMP '2024-01-01' AS request_time")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        log = registry.audit_log(rows)
        held = log.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.request_id for r in held] == sorted(r.request_id for r in held)
    assert len({r.part for r in held}) > 1
