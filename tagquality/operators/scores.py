"""Scores and trends over scan results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagquality.constants import RATE_PASS, RATE_WARN, SCORE_PASS, SCORE_WARN
from tagquality.plans.calendar import AsOf, days_before, instant
from tagquality.plans.joins import lookup_join

# Decimal arithmetic: a rate does not depend on the order in which rows arrive.
_RATE = "rows_error * 100.0 / nullif(total_rows, 0)"
_SUM_RATE = "sum(rows_error) * 100.0 / nullif(sum(total_rows), 0)"


def _rounded(rate: str | Column, digits: int = 2) -> Column:
    return F.round(F.expr(rate) if isinstance(rate, str) else rate, digits).cast("double")


def latest_run(results: DataFrame, latest_by: str = "scan_date") -> DataFrame:
    """Rows of the newest run.

    Run ids are random, so the largest id is not the newest run. `latest_by="scan_date"`
    takes the run with the newest scan; `"run_id"` takes the largest id; `"table"` takes for each
    table the run that scanned it last, so that tables that are scanned apart are all seen.
    """
    if latest_by == "table":
        newest = results.groupBy("table_name").agg(F.max(F.struct("scan_date", "run_id"))["run_id"].alias("run_id"))
        return lookup_join(results, newest.where(F.col("run_id").isNotNull()), ["table_name", "run_id"], "left_semi")
    if latest_by == "scan_date":
        newest = results.agg(F.max(F.struct("scan_date", "run_id"))["run_id"])
    elif latest_by == "run_id":
        newest = results.agg(F.max("run_id"))
    else:
        raise ValueError(f"latest_by must be 'scan_date', 'run_id' or 'table', got {latest_by!r}")
    return results.where(F.col("run_id") == newest.scalar())


def error_rates(results: DataFrame) -> DataFrame:
    """Error rate per (table, rule) over all runs: a ratio of sums."""
    return (
        results.groupBy("table_name", "rule_name")
        .agg(
            F.sum("total_rows").alias("total_scanned"),
            F.sum("rows_error").alias("total_errors"),
            _rounded(_SUM_RATE).alias("error_rate_pct"),
        )
        .orderBy(F.desc("error_rate_pct"))
    )


def latest_run_rates(results: DataFrame, latest_by: str = "scan_date") -> DataFrame:
    """Error rate of each result row of the latest run."""
    return (
        latest_run(results, latest_by)
        .select(
            "table_name",
            "rule_name",
            "total_rows",
            "rows_error",
            _rounded(_RATE).alias("error_rate_pct"),
        )
        .orderBy(F.desc("error_rate_pct"))
    )


def daily_trend(results: DataFrame) -> DataFrame:
    """Average of the row rates per (day, table, rule): not a ratio of sums."""
    return (
        results.groupBy(F.to_date("scan_date").alias("scan_day"), "table_name", "rule_name")
        .agg(_rounded(F.avg(F.expr(_RATE))).alias("avg_error_rate"))
        .orderBy(F.desc("scan_day"), F.desc("avg_error_rate"))
    )


def fn_score(results: DataFrame, target: str, latest_by: str = "scan_date") -> DataFrame:
    """Latest results of tables whose name contains `target`; status from the unrounded rate."""
    rate = F.expr(_RATE)
    status = (
        F.when(rate <= RATE_PASS, "PASS").when(rate <= RATE_WARN, "WARN").otherwise("FAIL")
    )
    return (
        latest_run(results, latest_by)
        .where(F.col("table_name").like(f"%{target}%"))
        .select(
            "table_name",
            "rule_name",
            "total_rows",
            "rows_error",
            _rounded(rate).alias("error_rate_pct"),
            F.when(rate.isNull(), F.lit("NO DATA")).otherwise(status).alias("status"),
            "scan_date",
        )
        .orderBy(F.desc("error_rate_pct"))
    )


def fn_trend(
    results: DataFrame, target: str, days_back: int = 30, as_of: AsOf = None
) -> DataFrame:
    """Daily average rate and number of result rows in the last `days_back` days."""
    since = days_before(instant(results, "scan_date", as_of), days_back)
    return (
        results.where(F.col("table_name").like(f"%{target}%") & (F.col("scan_date") >= since))
        .groupBy(F.to_date("scan_date").alias("scan_day"), "table_name")
        .agg(
            _rounded(F.avg(F.expr(_RATE))).alias("avg_error_rate"),
            F.count(F.lit(1)).alias("total_scans"),
        )
        .orderBy(F.desc("scan_day"))
    )


def _scored(sums: DataFrame, total: str, errors: str) -> DataFrame:
    """Score and status from a table's sums; the status follows the rounded score."""
    good = F.expr(f"({total} - {errors}) * 100.0 / nullif({total}, 0)")
    score = F.col("score")
    return sums.withColumn("score", _rounded(good)).withColumn(
        "status",
        F.when(score.isNull(), "NO DATA")
        .when(score >= SCORE_PASS, "PASS")
        .when(score >= SCORE_WARN, "WARN")
        .otherwise("FAIL"),
    )


def table_scores(results: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Score and status per table; `tables` adds wanted tables that may have no results.

    Rounding is half up.
    """
    sums = results.groupBy("table_name").agg(
        F.sum("total_rows").alias("_total"), F.sum("rows_error").alias("_errors")
    )
    if tables is not None:
        sums = tables.select("table_name").distinct().join(sums, "table_name", "left")
    return _scored(sums, "_total", "_errors").drop("_total", "_errors")


def scorecard(results: DataFrame, only: str | None = None) -> DataFrame:
    """Pass/warn/fail summary per table, worst first; `only="FAIL"` keeps failing tables."""
    sums = results.groupBy("table_name").agg(
        F.sum("total_rows").alias("total_scanned"),
        F.sum("rows_error").alias("total_errors"),
        F.sum("rows_warn").alias("total_warnings"),
        F.countDistinct("rule_name").alias("rules"),
        F.countDistinct("run_id").alias("runs"),
    )
    card = _scored(sums, "total_scanned", "total_errors")
    if only is not None:
        card = card.where(F.col("status") == only)
    return card.orderBy("score", "table_name")


def top_tables(results: DataFrame, n: int | None = None, latest_by: str = "scan_date") -> DataFrame:
    """Tables of the latest run by error rate, highest first; `n` of them, or all."""
    ranked = (
        latest_run(results, latest_by)
        .groupBy("table_name")
        .agg(
            F.sum("total_rows").alias("total_rows"),
            F.sum("rows_error").alias("rows_error"),
            _rounded(_SUM_RATE).alias("error_rate_pct"),
        )
        .orderBy(F.desc("error_rate_pct"), "table_name")
    )
    return ranked if n is None else ranked.limit(n)
