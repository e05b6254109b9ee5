"""Dates and instants. Every report takes `as_of`, so that it can be repeated."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = datetime | date | str | None


def month_of(col: str | Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(col, "month")


def as_of_ts(as_of: AsOf) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def as_of_date(as_of: AsOf) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def instant(df: DataFrame, column: str, as_of: AsOf) -> Column:
    """`as_of` in the type of `column`: a bare column compares with it, so scans can prune."""
    return as_of_ts(as_of).cast(df.schema[column].dataType)


def days_before(moment: Column, days: int) -> Column:
    return F.timestamp_add("DAY", F.lit(-days), moment)
