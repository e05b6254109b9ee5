"""Profiles: row counts, null shares, value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named table. No column is read."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls and their percentage for each column, in one pass; no rows for an empty table."""
    columns = list(columns or df.columns)
    filled = [F.count(F.col(f"`{c}`")).alias(f"_filled_{i}") for i, c in enumerate(columns)]
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_total").alias("total_rows"),
            (F.col("_total") - F.col(f"_filled_{i}")).alias("null_rows"),
        )
        for i, c in enumerate(columns)
    ]
    return (
        df.agg(F.count(F.lit(1)).alias("_total"), *filled)
        .where("_total > 0")
        .select(F.inline(F.array(*lines)))
        .withColumn("null_pct", F.round(F.expr("null_rows * 100.0 / total_rows"), 2).cast("double"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column; null is a value of its own."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
