"""A catalog table as a stream of what is appended to it.

The file source takes every new file for new rows. A commit that overwrites the table also makes new files,
with rows that have been seen before. Such a commit is known by the files that it removed;
it is refused, or left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BatchHandler = Callable[[DataFrame, int], None]

FILE, FILE_TIME = "_file", "_file_time"
# A writer's files carry the id of its job; one job is one commit.
COMMIT = r"part-\d+-([0-9a-f-]{36})"


class TableRewritten(RuntimeError):
    """Files that were read before are gone: the table has been overwritten."""


def read_table_stream(spark: SparkSession, table: str, max_files: int = 100) -> DataFrame:
    """Rows of the files appended to a table, at most `max_files` per micro-batch, with the file of each row."""
    rows = spark.readStream.option("maxFilesPerTrigger", max_files).table(table)
    return rows.select(
        "*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_modification_time").alias(FILE_TIME)
    )


def append_only(handle: BatchHandler, table: str, log: str, on_rewrite: str = "refuse") -> BatchHandler:
    """A handler of micro-batches of `read_table_stream` that passes on appended rows only.

    `log` is a folder for the files seen so far; a batch that is run again replaces its own entry. With
    `on_rewrite="refuse"` a rewritten table ends the stream; with `"skip"` the oldest commit among the new
    files is taken for the one that rewrote it and left out, and later appends are passed on.
    """
    if on_rewrite not in ("refuse", "skip"):
        raise ValueError(f"on_rewrite must be 'refuse' or 'skip', got {on_rewrite!r}")

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.select(FILE, FILE_TIME).distinct()
        there = spark.createDataFrame([(f,) for f in spark.table(table).inputFiles()], f"{FILE} STRING")
        name = F.regexp_extract(FILE, r"[^/]+$", 0)
        seen = _seen(spark, log, number)
        gone = seen.join(there.select(name.alias("name")), "name", "left_anti").where("NOT skipped")
        skipped = None
        if not gone.isEmpty():
            if on_rewrite == "refuse":
                raise TableRewritten(f"{table} has been overwritten since batch {number}")
            commits = new.groupBy(F.regexp_extract(FILE, COMMIT, 1).alias("commit")).agg(F.min(FILE_TIME).alias("at"))
            skipped = commits.orderBy("at", "commit").first()["commit"]
        out = F.lit(False) if skipped is None else F.regexp_extract(FILE, COMMIT, 1) == skipped
        entry = new.select(name.alias("name"), out.alias("skipped"))
        if skipped is not None:  # what is gone has been accounted for
            entry = entry.unionByName(gone.select("name", F.lit(True).alias("skipped")))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{log}/batch={number}")
        handle(batch.where(~out).drop(FILE, FILE_TIME), number)

    return run


def _seen(spark: SparkSession, log: str, number: int) -> DataFrame:
    """Files of the batches before `number`; one that was left out, or is known to be gone, is marked."""
    try:
        entries = spark.read.schema("name STRING, skipped BOOLEAN, batch LONG").parquet(log).where(F.col("batch") < number)
        return entries.groupBy("name").agg(F.bool_or("skipped").alias("skipped"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "name STRING, skipped BOOLEAN")
