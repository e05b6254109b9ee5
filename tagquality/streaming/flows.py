"""The event stream as a declarative flow, for a pipeline runner.

Importing this module registers nothing; call `define` in a pipeline source file.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import pipelines
from pyspark.sql import DataFrame, SparkSession

from tagquality.streaming.events import to_events


def define(
    spark: SparkSession,
    source_table: str,
    sink: str = "health_events_sink",
    sink_format: str = "kafka",
    options: Mapping[str, str] | None = None,
) -> None:
    """Create the sink and an append flow of brief events from the health table into it."""
    pipelines.create_sink(name=sink, format=sink_format, options=dict(options or {}))

    @pipelines.append_flow(target=sink, name="health_events")
    def health_events() -> DataFrame:
        return to_events(spark.readStream.table(source_table), "brief")
