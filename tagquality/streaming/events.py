"""Health results as JSON events: the same mapping for batches and streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tagquality.operators.health import is_anomaly

# Payload fields: output name -> path in the health result. Names and order are fixed values.
_PLAIN = ("event_time", "catalog_name", "schema_name", "table_name")
_LAST_COMMIT = "freshness.commit_freshness.last_value"
_PREDICTED_COMMIT = "freshness.commit_freshness.predicted_value"
_ACTUAL_ROWS = "completeness.total_row_count.last_value"
_MIN_ROWS = "completeness.total_row_count.min_predicted_value"

PAYLOADS: dict[str, dict[str, str]] = {
    "full": {
        **{c: c for c in (*_PLAIN, "table_id", "status")},
        "freshness_status": "freshness.status",
        "freshness_last_commit": _LAST_COMMIT,
        "freshness_predicted_commit": _PREDICTED_COMMIT,
        "completeness_status": "completeness.status",
        "completeness_actual_rows": _ACTUAL_ROWS,
        "completeness_min_expected": _MIN_ROWS,
        "impact_level": "downstream_impact.impact_level",
        "downstream_tables": "downstream_impact.num_downstream_tables",
    },
    "brief": {
        **{c: c for c in (*_PLAIN, "status")},
        "freshness_status": "freshness.status",
        "completeness_status": "completeness.status",
        "impact_level": "downstream_impact.impact_level",
    },
    "anomaly": {
        **{c: c for c in (*_PLAIN, "status")},
        "freshness_status": "freshness.status",
        "last_commit": _LAST_COMMIT,
        "completeness_status": "completeness.status",
        "actual_rows": _ACTUAL_ROWS,
        "min_expected_rows": _MIN_ROWS,
        "impact_level": "downstream_impact.impact_level",
        "downstream_tables": "downstream_impact.num_downstream_tables",
        "queries_affected": "downstream_impact.num_queries_on_affected_tables",
    },
}


def payload_fields(kind: str) -> list[Column]:
    return [F.col(path).alias(name) for name, path in PAYLOADS[kind].items()]


def to_events(results: DataFrame, fields: str = "full") -> DataFrame:
    """(key, value): the table id and the JSON of the chosen payload; null fields are left out."""
    return results.select(
        F.col("table_id").cast("string").alias("key"),
        F.to_json(F.struct(*payload_fields(fields))).alias("value"),
    )


def anomaly_events(results: DataFrame) -> DataFrame:
    """Events of results that are not healthy."""
    return to_events(results.where(is_anomaly()), "anomaly")


def preview_events(results: DataFrame, n: int = 10) -> DataFrame:
    """A look at what would be sent: any `n` brief events."""
    return to_events(results, "brief").limit(n)


def read_results_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int = 100
) -> DataFrame:
    """Files appended to a directory, at most `max_files` per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def checkpoint_for(spark: SparkSession, name: str) -> str:
    """Checkpoint of a named stream, in the shared folder the session names."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a shared folder, or pass a checkpoint")
    return f"{root.rstrip('/')}/streams/{name}"


def write_events(
    events: DataFrame,
    name: str,
    sink: str = "parquet",
    options: Mapping[str, str] | None = None,
    checkpoint: str | None = None,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Start the stream of events into a sink.

    `available_now` takes all there is and stops; `every="5 minutes"` keeps looking;
    with neither, batches follow one another. For Kafka the options are
    `kafka.bootstrap.servers` and `topic`; for files, `path`.
    """
    if available_now and every:
        raise ValueError("choose one of available_now and every")
    writer = (
        events.writeStream.queryName(name)
        .format(sink)
        .outputMode("append")
        .options(**dict(options or {}))
        .option("checkpointLocation", checkpoint or checkpoint_for(events.sparkSession, name))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()
