"""Tables: resolving names, creating, inserting, appending."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagquality.operators.chargeback import tag_value


def catalog_resolver(spark: SparkSession) -> Callable[[str], DataFrame]:
    """Full names are looked up in the session catalog."""
    return spark.table


def parquet_resolver(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    """The last part of a full name is a parquet file or directory under `root`."""

    def resolve(full_name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{full_name.rsplit('.', 1)[-1]}.parquet")

    return resolve


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    replace: bool = False,
) -> None:
    """An empty parquet table; an existing one is kept, or replaced on request."""
    if spark.catalog.tableExists(name):
        if not replace:
            return
        spark.sql(f"DROP TABLE {name}")
    writer = spark.createDataFrame([], schema).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def rows_of(
    spark: SparkSession, schema: T.StructType, columns: Sequence[str], rows: Iterable[tuple]
) -> DataFrame:
    """Inline rows that name some columns of a table; the other columns are null."""
    given = T.StructType([schema[c] for c in columns])
    df = spark.createDataFrame(list(rows), given)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in columns}
    return df.withColumns(missing).select(*schema.fieldNames()) if missing else df


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(name)


def append_results(results: DataFrame, path: str) -> None:
    """Append scan results under a directory, partitioned by scan day for pruning."""
    day = F.to_date("scan_date")
    results.withColumn("scan_day", day).write.mode("append").partitionBy("scan_day").parquet(path)


def write_promoted(
    usage: DataFrame, path: str, keys: Sequence[str], distinct: int = 100_000, partitions: int | None = None
) -> None:
    """Usage with promoted tags as parquet, in which a report on a tag reads few row groups.

    Rows are ranged by month and tags and sorted by them inside each file, so that the smallest and largest value of a row
    group are close together; each tag column has a bloom filter for up to `distinct` values, for
    tags that the order leaves scattered.
    """
    rows = promote_tags(usage, keys)
    order = ["usage_month", *keys]
    placed = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    writer = placed.sortWithinPartitions(*order).write.mode("append")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct))
    writer.parquet(path)


def promote_tags(usage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Usage with chosen map entries as columns of their own.

    A predicate on a map entry never reaches the parquet scan; one on a column does.
    `write_promoted` stores usage this way.
    """
    month = F.trunc("usage_date", "month").alias("usage_month")
    return usage.select("*", *[tag_value(usage, k).alias(k) for k in keys], month)
