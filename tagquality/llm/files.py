"""Flat files in the shared folder: written by Spark's text sink byte by byte, read in ranges."""

from __future__ import annotations

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tasks at most that read files, each some of them.
MOST_TASKS = 20_000


def write_flat(rows: DataFrame, column: str, path: str, end: bytes, kind: str | None = None) -> None:
    """A file for each partition: the bytes of `column` by row, each followed by `end`.

    With the column `kind` a partition gets a file for each of its few values, below
    `kind`=value, with its rows in their order. The sink commits a task's files once,
    whichever of its attempts ends first.
    """
    text = rows.select(F.col(column).cast("string"), *([kind] if kind else []))
    writer = text.write.option("lineSep", end.decode("latin1")).option("encoding", "ISO-8859-1")
    if not kind:
        return writer.text(path)
    # Writers side by side: else the sink sorts the rows by kind, which need not keep their order.
    conf, name = rows.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, 16)
    try:
        writer.partitionBy(kind).text(path)
    finally:
        conf.set(name, before)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files below `path`, without reading them."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def opened(path: str) -> pyarrow.fs.FileSystem:
    """A random-access file for a path as Spark lists it."""
    if path.startswith("file:/"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    system, place = pyarrow.fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def dealt(rows: DataFrame, each: int = 1) -> DataFrame:
    """`rows`, few and small, over as many tasks as there are rows, or `each` rows to a task."""
    return rows.repartition(max(1, min(MOST_TASKS, -(-rows.count() // each))))
