from __future__ import annotations

import json
import time
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tagquality.operators import registry
from tagquality.schemas import CLIENT_REGISTRY, SCAN_REQUESTS, TABLE_RESULTS
from tagquality.streaming import events, requests, table_stream

BINDINGS = (
    "catalog_name STRING, schema_name STRING, table_name STRING, column_name STRING, rule_name STRING, "
    "sql_expression STRING, criticality STRING"
)


def results(spark, *rows):
    """Rows of (table id, status)."""
    full = [
        (datetime(2024, 1, 1), "c", "s", f"t{i}", "1", i, status,
         ("Unhealthy", ("Unhealthy", None, datetime(2023, 1, 1), None)),
         ("Healthy", ("Healthy", None, 7, 3), None), ("HIGH", 1, 2), None)
        for i, status in rows
    ]
    return spark.createDataFrame(full, TABLE_RESULTS)


def test_payloads(spark):
    df = results(spark, ("9", "Unhealthy"))
    sizes = {"full": 14, "brief": 8, "anomaly": 13}
    for kind, size in sizes.items():
        assert len(events.PAYLOADS[kind]) == size
        row = events.to_events(df, kind).first()
        assert row["key"] == "9"
        value = json.loads(row["value"])
        assert list(value) == [n for n in events.PAYLOADS[kind] if n != "freshness_predicted_commit"]
    full = json.loads(events.to_events(df).first()["value"])
    assert full["completeness_actual_rows"] == 7 and full["event_time"] == "2024-01-01T00:00:00.000Z"
    assert events.preview_events(results(spark, *[(str(i), "x") for i in range(20)])).count() == 10


def test_only_anomalies(spark):
    df = results(spark, ("1", "HEALTHY"), ("2", "Healthy"), ("3", "Unhealthy"), ("4", None))
    assert [r["key"] for r in events.anomaly_events(df).collect()] == ["3"]


def test_restart_sends_each_anomaly_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("source", "out", "checkpoint"))

    def add(*ids):
        df = results(spark, *[(str(i), "Unhealthy" if i % 2 else "Healthy") for i in ids])
        df.coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = events.read_results_stream(spark, source, TABLE_RESULTS, max_files=1)
        query = events.write_events(
            events.anomaly_events(stream), "anomalies", options={"path": out},
            checkpoint=checkpoint, available_now=True,
        )
        query.awaitTermination()
        return len(query.recentProgress)

    add(*range(10))
    add(*range(10, 20))
    assert run() >= 2
    add(*range(20, 30))
    run()
    run()
    sent = [r["key"] for r in spark.read.parquet(out).collect()]
    assert sorted(sent) == sorted(str(i) for i in range(30) if i % 2)
    batch = events.anomaly_events(spark.read.schema(TABLE_RESULTS).parquet(source))
    assert sorted(batch.collect()) == sorted(spark.read.parquet(out).collect())


def test_triggers_and_checkpoint(spark, tmp_path):
    source = str(tmp_path / "source")
    results(spark, ("1", "Unhealthy")).write.parquet(source)
    stream = events.to_events(events.read_results_stream(spark, source, TABLE_RESULTS))
    with pytest.raises(ValueError):
        events.write_events(stream, "both", available_now=True, every="1 second")
    query = events.write_events(
        stream, "periodic", options={"path": str(tmp_path / "o")}, checkpoint=str(tmp_path / "c"), every="1 second"
    )
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1

    before = spark.conf.get("spark.checkpoint.dir", None)
    if before is None:
        with pytest.raises(ValueError):
            events.checkpoint_for(spark, "x")
    else:
        assert events.checkpoint_for(spark, "x") == f"{before.rstrip('/')}/streams/x"


def test_requests_are_validated_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "requests")
    asked = spark.createDataFrame([("1", "A", None, "me"), ("2", "Z", None, "me")], SCAN_REQUESTS)
    asked.write.parquet(source)
    known = spark.createDataFrame([("A", "Orchid", None, "c.s", True, None)], CLIENT_REGISTRY)
    stream = spark.readStream.schema(SCAN_REQUESTS).parquet(source)
    checked = registry.validate_requests(stream, known).select(
        "request_id", F.col("is_valid").cast("string").alias("is_valid")
    )
    out = str(tmp_path / "out")
    events.write_events(
        checked, "requests", options={"path": out}, checkpoint=str(tmp_path / "cp"), available_now=True
    ).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("1", "true"), ("2", "false")]


def asked(spark, path, *rows):
    spark.createDataFrame([(i, code, None, "me") for i, code in rows], SCAN_REQUESTS).coalesce(1).write.mode("append").parquet(path)


def test_requests_are_logged_and_scanned_once_however_often_a_batch_runs(spark, tmp_path):
    source, log = str(tmp_path / "requests"), requests.RequestLog(str(tmp_path / "log"))
    known = spark.createDataFrame([("A", "Orchid", None, "c.s", True, None), ("B", "Basalt", None, None, True, None)], CLIENT_REGISTRY)
    work = spark.createDataFrame([("c", "s", "t", "n", "Positive", "{col} > 0", "error")], BINDINGS)
    broken = [True]

    def resolve(name):
        if broken[0]:
            raise OSError("the table is away")
        return spark.createDataFrame([(1,), (-1,)], "n INT")

    def run():
        stream = requests.read_requests_stream(spark, source, max_files=1)
        requests.process_requests(
            stream, "scans", log, lambda: known, lambda: work, resolve, as_of="2024-01-01", available_now=True
        ).awaitTermination()

    asked(spark, source, ("1", "A"), ("2", "Z"), (None, "A"))
    with pytest.raises(StreamingQueryException, match="the table is away"):
        run()
    # The entries are there, the requests have failed, and the batch is not done.
    assert {r["status"] for r in log.audit(spark).collect()} == {"FAILED"}
    broken[0] = False
    asked(spark, source, ("3", "A"), ("4", "B"))
    run()
    run()
    entries = log.audit(spark).collect()
    states = sorted((r["client_name"], r["status"]) for r in entries)
    assert states == [("Basalt", "REJECTED"), ("Orchid", "COMPLETED"), ("Orchid", "COMPLETED"), ("Orchid", "COMPLETED")]
    results = log.results(spark).collect()
    # Each scanned request has one result row, also the one that came without an id.
    assert sorted(r["run_id"] for r in results) == sorted(r["request_id"] for r in entries if r["status"] == "COMPLETED")
    assert {(r["total_rows"], r["rows_error"]) for r in results} == {(2, 1)}


def test_triggers_of_requests(spark):
    with pytest.raises(ValueError):
        requests.process_requests(None, "x", requests.RequestLog("x"), None, available_now=True, every="1 second")


@pytest.mark.parametrize("on_rewrite", ["refuse", "skip"])
def test_a_rewritten_table_is_refused_or_skipped(spark, tmp_path, on_rewrite):
    table, out = f"streamed_{on_rewrite}_t", str(tmp_path / "out")
    spark.range(0, 5).write.mode("overwrite").saveAsTable(table)

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/b={number}")

    def run():
        handler = table_stream.append_only(keep, table, str(tmp_path / "seen"), on_rewrite)
        rows = table_stream.read_table_stream(spark, table)
        query = rows.writeStream.foreachBatch(handler).option("checkpointLocation", str(tmp_path / "cp"))
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(out).collect())

    try:
        assert run() == [0, 1, 2, 3, 4]
        spark.range(10, 12).write.mode("append").saveAsTable(table)
        assert run() == [0, 1, 2, 3, 4, 10, 11]
        spark.range(20, 24).write.mode("overwrite").insertInto(table)
        time.sleep(1.1)
        spark.range(30, 32).write.mode("append").saveAsTable(table)
        if on_rewrite == "refuse":
            with pytest.raises(StreamingQueryException, match="overwritten"):
                run()
        else:
            assert run() == [0, 1, 2, 3, 4, 10, 11, 30, 31]
            spark.range(40, 41).write.mode("append").saveAsTable(table)
            assert run() == [0, 1, 2, 3, 4, 10, 11, 30, 31, 40]
    finally:
        spark.sql(f"DROP TABLE {table}")
    with pytest.raises(ValueError):
        table_stream.append_only(keep, table, "x", "ignore")


def test_flow_feeds_the_sink(spark, tmp_path):
    pytest.importorskip("pyspark.pipelines")
    from pyspark.pipelines.graph_element_registry import (
        GraphElementRegistry,
        graph_element_registration_context,
    )

    from tagquality.streaming import flows

    class Recorder(GraphElementRegistry):
        def __init__(self):
            self.outputs, self.flows = [], []

        def register_output(self, output):
            self.outputs.append(output)

        def register_flow(self, flow):
            self.flows.append(flow)

        def register_sql(self, sql_text, file_path):
            raise AssertionError("no SQL is registered")

    results(spark, ("1", "Unhealthy")).write.mode("overwrite").saveAsTable("flow_source_t")
    recorder = Recorder()
    with graph_element_registration_context(recorder):
        flows.define(spark, "flow_source_t", "sink", "kafka", {"topic": "t"})
    assert [o.name for o in recorder.outputs] == ["sink"]
    assert recorder.flows[0].target == "sink"
    stream = recorder.flows[0].func()
    assert stream.isStreaming and stream.columns == ["key", "value"]
    spark.sql("DROP TABLE flow_source_t")
