"""Scan requests as a stream: validated, logged, scanned, and their state kept.

A micro-batch writes its audit rows, results and states under its own number and replaces what is
there. A batch that is run again after a failure, as a whole or from the middle, therefore leaves
nothing twice, and nothing is lost.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tagquality.operators import registry as clients
from tagquality.operators.scan import ResolveTable
from tagquality.plans.calendar import AsOf
from tagquality.plans.session import cut
from tagquality.schemas import SCAN_AUDIT_LOG, SCAN_REQUESTS, SCAN_STATES

BATCH = "batch_id"


def read_requests_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Requests appended to a directory as parquet."""
    return spark.readStream.schema(SCAN_REQUESTS).option("maxFilesPerTrigger", max_files).parquet(path)


@dataclass(frozen=True)
class RequestLog:
    """Where a stream of requests keeps what it has done."""

    root: str

    def _place(self, part: str, batch: int) -> str:
        return f"{self.root}/{part}/{BATCH}={batch}"

    def put(self, rows: DataFrame, part: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(self._place(part, batch))

    def _read(self, spark: SparkSession, part: str, schema: T.StructType) -> DataFrame:
        return clients.read_log(spark, f"{self.root}/{part}", schema).select(*schema.fieldNames())

    def audit(self, spark: SparkSession) -> DataFrame:
        """Audit entries with the newest state of their request."""
        states = self._read(spark, "states", SCAN_STATES)
        return clients.audit_log(self._read(spark, "audit", SCAN_AUDIT_LOG), states)

    def results(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/results").drop(BATCH)


def handle_batch(
    batch: DataFrame,
    number: int,
    log: RequestLog,
    registry: Callable[[], DataFrame],
    bindings: Callable[[], DataFrame] | None = None,
    resolve_table: ResolveTable | None = None,
    as_of: AsOf = None,
) -> None:
    """What is done with one micro-batch; `registry` and `bindings` are read anew for each.

    With `bindings`, accepted requests are scanned, and the state of each goes from SUBMITTED to COMPLETED;
    if the scan fails, to FAILED.
    """
    # Ids are made once, here: what follows reads them.
    asked = cut(batch.select(*SCAN_REQUESTS.fieldNames()).withColumn("request_id", F.coalesce("request_id", F.expr("uuid()"))))
    known = registry()
    entries = cut(clients.audit_rows(clients.validate_requests(asked, known), as_of))
    log.put(entries, "audit", number)
    if bindings is None:
        return
    submitted = entries.where("status = 'SUBMITTED'")
    try:
        results = clients.run_requests(asked, known, bindings(), resolve_table, as_of)
        if results is not None:
            log.put(results, "results", number)
    except Exception:
        log.put(clients.audit_states(submitted, "FAILED", as_of), "states", number)
        raise
    log.put(clients.audit_states(submitted, "COMPLETED", as_of), "states", number)


def process_requests(
    requests: DataFrame,
    name: str,
    log: RequestLog,
    registry: Callable[[], DataFrame],
    bindings: Callable[[], DataFrame] | None = None,
    resolve_table: ResolveTable | None = None,
    checkpoint: str | None = None,
    as_of: AsOf = None,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Start the stream of requests; see `handle_batch`. Triggers are those of `events.write_events`."""
    if available_now and every:
        raise ValueError("choose one of available_now and every")

    def run(batch: DataFrame, number: int) -> None:
        handle_batch(batch, number, log, registry, bindings, resolve_table, as_of)

    writer = requests.writeStream.queryName(name).foreachBatch(run)
    writer = writer.option("checkpointLocation", checkpoint or f"{log.root}/checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()
