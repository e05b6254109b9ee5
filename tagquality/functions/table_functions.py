"""The three table functions for SQL users, as temporary functions over named tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tagquality.constants import RATE_PASS, RATE_WARN, SCANNING_COST_CENTER

_RATE = "rows_error * 100.0 / nullif(total_rows, 0)"


def register_score_function(
    spark: SparkSession,
    results_table: str,
    name: str = "fn_dq_score_by_table",
    latest_by: str = "scan_date",
) -> None:
    """`name(target_table)`: rates and status per rule from the latest run."""
    newest = {"scan_date": "max(struct(scan_date, run_id)).run_id", "run_id": "max(run_id)"}
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            target_table STRING COMMENT 'Part of the table name'
        )
        RETURNS TABLE (
            table_name STRING, rule_name STRING, total_rows BIGINT, rows_error BIGINT,
            error_rate_pct DOUBLE, status STRING, scan_date TIMESTAMP
        )
        COMMENT 'Error rate and status per rule of the matching tables in the latest scan'
        RETURN
            SELECT table_name, rule_name, total_rows, rows_error,
                   CAST(round(rate, 2) AS DOUBLE),
                   CASE WHEN rate IS NULL THEN 'NO DATA'
                        WHEN rate <= {RATE_PASS} THEN 'PASS'
                        WHEN rate <= {RATE_WARN} THEN 'WARN'
                        ELSE 'FAIL' END,
                   CAST(scan_date AS TIMESTAMP)
            FROM (SELECT *, {_RATE} AS rate FROM {results_table})
            WHERE table_name LIKE concat('%', target_table, '%')
              AND run_id = (SELECT {newest[latest_by]} FROM {results_table})
    """)


def register_trend_function(
    spark: SparkSession, results_table: str, name: str = "fn_dq_trend"
) -> None:
    """`name(target_table, days_back, as_of)`: daily average rate and result rows."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            target_table STRING COMMENT 'Part of the table name',
            days_back INT DEFAULT 30 COMMENT 'Days to look back',
            as_of TIMESTAMP DEFAULT current_timestamp() COMMENT 'End of the period'
        )
        RETURNS TABLE (
            scan_day DATE, table_name STRING, avg_error_rate DOUBLE, total_scans BIGINT
        )
        COMMENT 'Daily average error rate of the matching tables'
        RETURN
            SELECT CAST(scan_date AS DATE), table_name,
                   CAST(round(avg({_RATE}), 2) AS DOUBLE), count(*)
            FROM {results_table}
            WHERE table_name LIKE concat('%', target_table, '%')
              AND scan_date >= timestampadd(DAY, -days_back, as_of)
            GROUP BY ALL
    """)


def register_chargeback_function(
    spark: SparkSession,
    usage_table: str,
    name: str = "fn_dq_chargeback",
    cost_center: str = SCANNING_COST_CENTER,
) -> None:
    """`name(code, months_back, as_of)`: units and runs per code and month; promoted tags are read as columns."""
    columns = spark.table(usage_table).columns

    def tag(key: str) -> str:
        return key if key in columns else f"element_at(custom_tags, '{key}')"

    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            target_billing_code STRING DEFAULT NULL COMMENT 'One billing code, or NULL for all',
            months_back INT DEFAULT 3 COMMENT 'Months to look back',
            as_of DATE DEFAULT current_date() COMMENT 'End of the period'
        )
        RETURNS TABLE (
            billing_code STRING, requesting_team STRING, usage_month DATE,
            total_dbus DOUBLE, scan_runs BIGINT
        )
        COMMENT 'Units and scan runs per client and month'
        RETURN
            SELECT code, team, month, CAST(round(sum(usage_quantity), 4) AS DOUBLE),
                   count(DISTINCT run)
            FROM (
                SELECT {tag('billing_code')} AS code,
                       {tag('requesting_team')} AS team,
                       {tag('cost_center')} AS center,
                       trunc(usage_date, 'month') AS month,
                       usage_metadata.job_run_id AS run,
                       usage_quantity, usage_date
                FROM {usage_table}
            )
            WHERE center = '{cost_center}' AND code IS NOT NULL
              AND usage_date >= add_months(as_of, -months_back)
              AND (target_billing_code IS NULL OR code = target_billing_code)
            GROUP BY code, team, month
    """)
