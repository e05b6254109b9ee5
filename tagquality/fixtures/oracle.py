"""The registered queries once more, as SQL for an independent engine.

`VIEWS` derives the inputs of `views.py`; `ORACLE` holds one statement per query.
`statement` puts the views a query needs in front of it.
"""

from __future__ import annotations

import re

from tagquality.fixtures.views import (
    CATALOG,
    EVENTS_AS_OF,
    FAILING_RULES,
    ORDERS_AS_OF,
    PRICES,
    SCAN_EXCLUSIONS,
    SCAN_RULES,
    SCANNED_COLUMNS,
    USAGE_AS_OF,
    VOLUME_AS_OF,
)


def rounded(expr: str, digits: int) -> str:
    """Half-up rounding of the decimal value, as Spark rounds a double."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(30, 12)), {digits}) AS DOUBLE)"


def _prices() -> str:
    def ts(value: str | None) -> str:
        return "CAST(NULL AS TIMESTAMP)" if value is None else f"TIMESTAMP '{value}'"

    rows = ", ".join(f"('{s}', {ts(a)}, {ts(b)}, CAST({p} AS DOUBLE))" for s, a, b, p in PRICES)
    return f"SELECT * FROM (VALUES {rows}) AS p(sku_name, starts, ends, price)"


VIEWS = {
    "fx_places": f"""
        SELECT s_suppkey, s_acctbal, n_nationkey, {CATALOG} AS catalog_name,
               CASE WHEN s_acctbal < 0 THEN 'SCHEMAX' ELSE 'SCHEMA_' END || s_suppkey AS schema_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "fx_schemata": """
        SELECT catalog_name, schema_name, CAST(s_suppkey AS VARCHAR) AS schema_id FROM fx_places""",
    "fx_schema_tags": f"""
        SELECT catalog_name, schema_name, 'tenant' AS tag_name,
               'TENANT_' || (n_nationkey % 7) AS tag_value
        FROM fx_places WHERE catalog_name <> 'AMERICA'
        UNION ALL SELECT catalog_name, schema_name, 'askid', 'ASK-' || n_nationkey
        FROM fx_places WHERE catalog_name <> 'DEV_U1'
        UNION ALL SELECT catalog_name, schema_name, 'askid', 'ASK-SHARED'
        FROM fx_places WHERE s_acctbal > 9000
        UNION ALL SELECT catalog_name, schema_name, 'dqm_monitor', 'enabled'
        FROM fx_places WHERE s_acctbal >= 5000
        UNION ALL SELECT catalog_name, schema_name, 'dqm_monitor', 'paused'
        FROM fx_places WHERE s_acctbal < 0
        UNION ALL SELECT {CATALOG}, 'RETIRED_' || n_name, 'dqm_monitor', 'enabled'
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fx_new_tags": """
        SELECT catalog_name, schema_name, 'tenant' AS tag_name, 'TENANT_NEW' AS tag_value
        FROM fx_places WHERE catalog_name IN ('AFRICA', 'AMERICA')
        UNION ALL SELECT catalog_name, schema_name, 'cost', 'C' || n_nationkey FROM fx_places""",
    "fx_monitors": """
        SELECT catalog_name, schema_name, DATE '2024-01-01' AS enabled_at
        FROM fx_places WHERE s_acctbal >= 8000""",
    "fx_tables": """
        SELECT CAST(p_partkey AS VARCHAR) AS table_id, catalog_name, schema_name,
               'tbl_' || p_partkey AS table_name, p_type, p_brand, p_size
        FROM part JOIN fx_places ON p_partkey % (SELECT count(*) FROM supplier) = s_suppkey""",
    "fx_column_tags": """
        SELECT catalog_name, schema_name, table_name, 'name' AS column_name,
               'dq_type' AS tag_name, p_type AS tag_value FROM fx_tables
        UNION ALL SELECT catalog_name, schema_name, table_name, 'brand', 'dq_brand', p_brand
        FROM fx_tables""",
    "fx_rules": """
        SELECT DISTINCT 'dq_type' AS tag_name, p_type AS tag_value, 'Present ' || p_type AS rule_name,
               '{col} IS NOT NULL' AS sql_expression, 'error' AS criticality FROM part
        UNION ALL SELECT DISTINCT 'dq_type', p_type, 'Short ' || p_type,
               'LENGTH({col}) <= 40', 'warn' FROM part
        UNION ALL SELECT DISTINCT 'dq_brand', p_brand, 'Brand ' || p_brand,
               '{col} IS NOT NULL', 'error' FROM part""",
    "fx_bindings": """
        SELECT t.catalog_name, t.schema_name, t.table_name, t.column_name,
               r.rule_name, r.sql_expression, r.criticality
        FROM fx_column_tags t JOIN fx_rules r
          ON t.tag_name = r.tag_name AND t.tag_value = r.tag_value""",
    "fx_table_tags": """
        SELECT catalog_name, schema_name, table_name,
               CASE WHEN p_size > 40 THEN 'true' ELSE 'false' END AS excluded FROM fx_tables""",
    "fx_contacts": """
        SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment,
               CASE WHEN c_acctbal < 0 THEN 'no-at-sign'
                    WHEN c_acctbal > 9500 THEN '@example.com'
                    WHEN c_acctbal > 9000 THEN 'x' || c_custkey || '@domain'
                    WHEN c_mktsegment = 'MACHINERY' THEN NULL
                    WHEN c_mktsegment = 'FURNITURE' AND c_acctbal > 8000 THEN ''
                    ELSE 'user.' || c_custkey || '@example.com' END AS email
        FROM customer""",
    "fx_usage": """
        SELECT CAST(l_shipdate AS DATE) AS usage_date, l_shipdate AS usage_start_time,
               'ws-' || l_linenumber AS workspace_id,
               l_returnflag || '_' || l_linestatus AS sku_name, l_quantity AS usage_quantity,
               CASE WHEN l_linenumber IN (1, 3, 5, 7) THEN 'DATA_QUALITY_MONITORING'
                    ELSE 'JOBS' END AS billing_origin_product,
               CASE WHEN l_discount >= 0.095 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS schema_id,
               CASE WHEN l_tax > 0.065 THEN 'ext-' || l_partkey
                    ELSE CAST(l_partkey AS VARCHAR) END AS table_id,
               CAST(l_suppkey AS VARCHAR) AS job_id, CAST(l_orderkey AS VARCHAR) AS job_run_id,
               CASE l_suppkey % 4 WHEN 0 THEN 'ORCHID-11' WHEN 1 THEN 'BASALT-22'
                    WHEN 2 THEN 'HARBOR-33' END AS billing_code,
               CASE l_suppkey % 4 WHEN 0 THEN 'Orchid Mills' WHEN 1 THEN 'Basalt Works'
                    WHEN 2 THEN 'Harbor Lane' END AS requesting_team,
               CASE WHEN l_partkey % 3 = 0 THEN 'DQ-Scanning' ELSE 'Other' END AS cost_center,
               CASE WHEN l_linenumber < 4 THEN 'ad-hoc' ELSE 'scheduled' END AS scan_type,
               l_linenumber > 4 AS is_serverless, 'pol-' || (l_partkey % 6) AS policy_id
        FROM lineitem""",
    "fx_monitoring": "SELECT * FROM fx_usage WHERE billing_origin_product = 'DATA_QUALITY_MONITORING'",
    "fx_scanning": "SELECT * FROM fx_usage WHERE cost_center = 'DQ-Scanning'",
    "fx_prices": _prices(),
    "fx_daily_prices": """
        SELECT DISTINCT l_returnflag || '_' || l_linestatus AS sku_name, CAST(l_shipdate AS DATE) AS day,
               (dayofyear(CAST(l_shipdate AS DATE)) % 50 + 1) / 100 AS price
        FROM lineitem""",
    "fx_tag_dim": """
        SELECT s.catalog_name, s.schema_name, s.schema_id, t.tag_name, t.tag_value
        FROM fx_schemata s JOIN fx_schema_tags t
          ON s.catalog_name = t.catalog_name AND s.schema_name = t.schema_name""",
    "fx_history": """
        SELECT CAST(o_orderkey AS VARCHAR) AS statement_id, o_orderdate AS start_time,
               'select * from ' || lower(catalog_name) || '.' || lower(schema_name) || '.tbl_'
                 || o_custkey || ' where k=' || o_orderkey AS statement_text,
               CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'FAILED'
                    ELSE 'RUNNING' END AS execution_status,
               CAST(floor(o_totalprice) AS BIGINT) AS total_duration_ms,
               o_custkey AS read_rows, o_custkey * 1048576 AS read_bytes
        FROM orders JOIN fx_places ON o_custkey % (SELECT count(*) FROM supplier) = s_suppkey""",
    "fx_results": """
        SELECT event_id, ts AS event_time, catalog_name, schema_name,
               'tbl_' || (user_id % 30) AS table_name, CAST(s_suppkey AS VARCHAR) AS schema_id,
               CAST(user_id AS VARCHAR) AS table_id,
               CASE event_type WHEN 'error' THEN 'Unhealthy' WHEN 'signup' THEN NULL
                    WHEN 'view' THEN 'HEALTHY' ELSE 'Healthy' END AS status,
               CASE WHEN value < 50 THEN 'Unhealthy' ELSE 'Healthy' END AS freshness_status,
               ts - INTERVAL 1 HOUR AS last_commit, ts + INTERVAL 1 HOUR AS predicted_commit,
               CASE WHEN value > 400 THEN 'Unhealthy' ELSE 'Healthy' END AS completeness_status,
               CAST(floor(value) AS BIGINT) AS actual_rows, CAST(100 AS BIGINT) AS min_expected_rows,
               CASE WHEN value > 300 THEN 'HIGH' ELSE 'LOW' END AS impact_level,
               user_id % 9 AS downstream_tables, event_id % 50 AS queries_affected
        FROM events
        JOIN fx_places ON user_id % CAST(ceil((SELECT count(*) FROM supplier) * 7 / 10) AS BIGINT)
                          = s_suppkey""",
    "fx_scans": """
        SELECT catalog_name, schema_name, max(event_time) AS last_scan_time,
               count(DISTINCT table_name) AS tables_monitored
        FROM fx_results GROUP BY ALL""",
    "fx_timeline": """
        SELECT o_orderkey AS run_id, 'run-' || o_orderkey AS run_name,
               CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED'
                    ELSE 'RUNNING' END AS result_state,
               o_orderdate AS start_time, o_orderdate + to_seconds(o_custkey % 600) AS end_time
        FROM orders""",
    "fx_dq": """
        SELECT 'cat.sch.' || lower(substr(o_orderpriority, 3)) AS table_name,
               o_orderstatus AS column_name, 'rule_' || o_orderstatus AS rule_name,
               CASE WHEN o_custkey % 50 = 49 THEN 0 ELSE 100 + o_custkey END AS total_rows,
               CASE WHEN o_custkey % 50 = 49 THEN 0 ELSE o_custkey % 100 END AS rows_error,
               o_custkey % 7 AS rows_warn, o_orderdate AS scan_date,
               md5('run' || year(o_orderdate)) AS run_id
        FROM orders""",
    "fx_latest": """
        SELECT *, rows_error * 100.0 / nullif(total_rows, 0) AS rate FROM fx_dq
        WHERE run_id = (SELECT run_id FROM fx_dq ORDER BY scan_date DESC, run_id DESC LIMIT 1)""",
    "fx_latest_of_table": """
        SELECT *, rows_error * 100.0 / nullif(total_rows, 0) AS rate FROM fx_dq d
        WHERE run_id = (SELECT run_id FROM fx_dq x WHERE x.table_name = d.table_name
                        ORDER BY scan_date DESC, run_id DESC LIMIT 1)""",
    "fx_registry": """
        SELECT 'BC-' || c_custkey AS billing_code, c_name AS client_name,
               'dq@' || c_custkey || '.example.com' AS contact_email,
               a.catalog_name || '.' || a.schema_name || ', ' || b.catalog_name || '.'
                 || b.schema_name AS schemas_allowed,
               a.catalog_name || '.' || a.schema_name AS allowed_1,
               b.catalog_name || '.' || b.schema_name AS allowed_2,
               c_acctbal >= 0 AS is_active, DATE '2024-01-01' AS created_at
        FROM customer
        JOIN fx_places a ON c_custkey % (SELECT count(*) FROM supplier) = a.s_suppkey
        JOIN fx_places b ON (c_custkey + 1) % (SELECT count(*) FROM supplier) = b.s_suppkey""",
    "fx_requests": """
        SELECT CAST(o_orderkey AS VARCHAR) AS request_id,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'NOBODY'
                    ELSE 'BC-' || o_custkey END AS billing_code,
               CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '3-MEDIUM' THEN ''
                    ELSE catalog_name || '.' || schema_name || ' , ' || catalog_name || '.'
                         || schema_name END AS schemas,
               'clerk-' || o_orderstatus AS requested_by
        FROM orders
        JOIN fx_places ON s_suppkey =
             (CASE WHEN o_orderpriority = '2-HIGH' THEN o_custkey + 2 ELSE o_custkey END)
             % (SELECT count(*) FROM supplier)""",
    "fx_validated": """
        SELECT q.request_id, q.billing_code, c.client_name, q.requested_by,
               CASE WHEN c.billing_code IS NOT NULL
                    THEN coalesce(nullif(q.schemas, ''), c.schemas_allowed) END AS target_schemas,
               c.schemas_allowed, c.allowed_1, c.allowed_2, c.billing_code IS NOT NULL AS is_valid
        FROM fx_requests q
        LEFT JOIN (SELECT * FROM fx_registry WHERE is_active) c ON q.billing_code = c.billing_code""",
    "fx_wanted": """
        SELECT DISTINCT request_id, billing_code, client_name, schema_full_name,
               schema_full_name IN (allowed_1, allowed_2) AS is_allowed
        FROM (SELECT *, trim(unnest(string_split(target_schemas, ','))) AS schema_full_name
              FROM fx_validated WHERE is_valid)""",
}

# --- pieces used by several statements ---------------------------------------------------

# What makes a row break each scan rule, in the oracle's dialect. `x` is the column.
_BROKEN = {
    "Name Conformance": "NOT coalesce(x IS NOT NULL AND length(trim(x)) >= 1"
    " AND regexp_matches(x, '^[A-Za-z][A-Za-z'' -]*$'), false)",
    "Email Conformance": "NOT coalesce(regexp_matches(x, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'), false)",
    "Known Segment": "x NOT IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')",
    "Balance In Range": "x NOT BETWEEN -900 AND 9000",
    "Balance Not Negative": "x < 0",
    "Priority Format": "NOT regexp_matches(x, '^[1-5]-[A-Z ]+$')",
    "Priority Specified": "x = '4-NOT SPECIFIED'",
    "Text Present": "x IS NULL OR length(trim(x)) = 0",
    "Text Long Enough": "length(x) < 200",
}


def _scan_sql(*rule_names: str, table: str | None = None) -> str:
    lines = []
    for tab, column, tag in SCANNED_COLUMNS:
        for tag_value, rule, _, level in SCAN_RULES:
            if tag_value != tag or (rule_names and rule not in rule_names):
                continue
            if table is not None and tab != table:
                continue
            source = "fx_contacts" if tab == "contacts" else tab
            broken = f"count(*) FILTER (WHERE {_BROKEN[rule]})"
            error, warn = (broken, "0") if level == "error" else ("0", broken)
            lines.append(
                f"SELECT 'main.sales.{tab}' AS table_name, '{column}' AS column_name, "
                f"'{rule}' AS rule_name, count(*) AS total_rows, CAST({error} AS BIGINT) AS rows_error, "
                f"CAST({warn} AS BIGINT) AS rows_warn, DATE '{EVENTS_AS_OF[:10]}' AS scan_date, "
                f"'run-0001' AS run_id FROM (SELECT {column} AS x FROM {source}) HAVING count(*) > 0"
            )
    return "\nUNION ALL ".join(lines)


_EXCLUDED = ", ".join(f"'main.sales.{t}'" for t, value in SCAN_EXCLUSIONS if value == "true")
_FAILED = " UNION ALL ".join(
    f"SELECT 'main.sales.{table}', '{column}', '{rule}', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), "
    "CAST(NULL AS BIGINT), true"
    for table, column, tag in SCANNED_COLUMNS
    for tag_value, rule, _, _ in FAILING_RULES
    if tag == tag_value
)


def _units_and_cost(owner: str, tag: str) -> str:
    return f"""
        SELECT d.tag_value AS {owner}, CAST(date_trunc('month', u.usage_date) AS DATE) AS usage_month,
               {rounded("sum(u.usage_quantity)", 4)} AS total_dbus,
               {rounded("sum(u.usage_quantity * p.price)", 2)} AS estimated_cost_usd
        FROM fx_monitoring u
        JOIN fx_tag_dim d ON u.schema_id = d.schema_id AND d.tag_name = '{tag}'
        JOIN fx_prices p ON {_PRICED}
        GROUP BY ALL"""


_PRICED = """u.sku_name = p.sku_name AND u.usage_start_time >= p.starts
             AND u.usage_start_time < coalesce(p.ends, TIMESTAMP '2099-12-31')"""

_MENTIONS = """upper(q.statement_text) LIKE
               '%' || upper(d.catalog_name) || '.' || upper(d.schema_name) || '%'"""

_QUERY_NUMBERS = f"""
    CAST(date_trunc('month', q.start_time) AS DATE) AS query_month,
    count(*) AS total_queries,
    count(*) FILTER (WHERE q.execution_status = 'FINISHED') AS successful_queries,
    count(*) FILTER (WHERE q.execution_status = 'FAILED') AS failed_queries,
    {rounded("CAST(sum(q.total_duration_ms) AS DOUBLE) / 3600000", 2)} AS total_compute_hours,
    {rounded("avg(q.total_duration_ms) / 1000", 1)} AS avg_query_duration_sec,
    CAST(sum(q.read_rows) AS BIGINT) AS total_rows_read,
    {rounded("CAST(sum(q.read_bytes) AS DOUBLE) / 1073741824", 2)} AS total_gb_read"""

_ORDERS_SINCE = f"q.start_time >= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 3000 DAY"

_STATUS_OF_RATE = """CASE WHEN rate IS NULL THEN 'NO DATA' WHEN rate <= 5 THEN 'PASS'
                          WHEN rate <= 20 THEN 'WARN' ELSE 'FAIL' END"""



def _table_scores(table: str = "table_name") -> str:
    score = "(sum(total_rows) - sum(rows_error)) * 100.0 / nullif(sum(total_rows), 0)"
    return f"""
    SELECT *, CASE WHEN score IS NULL THEN 'NO DATA' WHEN score >= 95 THEN 'PASS'
                   WHEN score >= 80 THEN 'WARN' ELSE 'FAIL' END AS status
    FROM (SELECT {table} AS table_name, {rounded(score, 2)} AS score FROM fx_dq GROUP BY {table})"""



def _latest_rates(where: str) -> str:
    return f"""
        SELECT table_name, rule_name, total_rows, rows_error,
               {rounded("rows_error * 100.0 / nullif(total_rows, 0)", 2)} AS error_rate_pct
        FROM fx_dq WHERE run_id = ({where})"""


def _score_rows(scan_date: str) -> str:
    return f"""
        SELECT table_name, rule_name, total_rows, rows_error, {rounded("rate", 2)} AS error_rate_pct,
               {_STATUS_OF_RATE} AS status, {scan_date} AS scan_date
        FROM fx_latest WHERE table_name LIKE '%i%'"""


_TREND_ROWS = f"""
    SELECT CAST(scan_date AS DATE) AS scan_day, table_name,
           {rounded("avg(rows_error * 100.0 / nullif(total_rows, 0))", 2)} AS avg_error_rate,
           count(*) AS total_scans
    FROM fx_dq
    WHERE table_name LIKE '%i%' AND scan_date >= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 60 DAY
    GROUP BY ALL"""


def _buckets(rows: str, keys: str, ts: str, as_of: str) -> str:
    """Rows per key and 24-hour bucket, with the empty buckets up to the oldest filled in."""
    return f"""
        found AS (
            SELECT {keys}, CAST(floor((epoch_us(TIMESTAMP '{as_of}') - epoch_us({ts}))
                                / 86400000000.0) AS BIGINT) AS bucket, count(*) AS n
            FROM {rows}
            WHERE {ts} <= TIMESTAMP '{as_of}' AND {ts} > TIMESTAMP '{as_of}' - INTERVAL 29 DAY
            GROUP BY ALL),
        days AS (
            SELECT s.{keys}, s.bucket, coalesce(f.n, 0) AS n
            FROM (SELECT {keys}, unnest(range(0, max(bucket) + 1)) AS bucket FROM found GROUP BY {keys}) s
            LEFT JOIN found f ON s.{keys} = f.{keys} AND s.bucket = f.bucket),
        likened AS (
            SELECT *, CASE WHEN count(*) FILTER (WHERE bucket > 0 AND bucket % 7 = 0) OVER (PARTITION BY {keys}) >= 3
                           THEN bucket % 7 ELSE 0 END AS alike FROM days),
        medians AS (
            SELECT {keys}, alike, median(n) AS med FROM likened WHERE bucket > 0 GROUP BY {keys}, alike),
        volume AS (
            SELECT l.{keys}, max(n) FILTER (WHERE bucket = 0) AS actual_rows,
                   count(*) FILTER (WHERE bucket > 0) AS baseline_days,
                   max(med) FILTER (WHERE l.alike = 0) AS expected_rows,
                   median(abs(n - med)) FILTER (WHERE bucket > 0) AS mad_rows
            FROM likened l LEFT JOIN medians m ON l.{keys} = m.{keys} AND l.alike = m.alike GROUP BY l.{keys}),
        known AS (SELECT DISTINCT {keys} FROM {rows} WHERE {ts} <= TIMESTAMP '{as_of}'),
        judged AS (
            SELECT k.{keys}, coalesce(v.actual_rows, 0) AS actual_rows,
                   coalesce(v.baseline_days, 0) AS baseline_days, v.expected_rows, v.mad_rows,
                   v.{keys} IS NULL AS silent,
                   CASE WHEN v.baseline_days >= 7 THEN greatest(0.0, v.expected_rows
                        - greatest(3 * 1.4826::DOUBLE * v.mad_rows, 0.1::DOUBLE * v.expected_rows)) END AS floor_rows
            FROM known k LEFT JOIN volume v ON k.{keys} = v.{keys})"""


# The names asked for that the client may scan, each once.
_AUDIT = """
    entries AS (
        SELECT *, list_filter(
            CASE WHEN allowed_1 = allowed_2 THEN [allowed_1] ELSE [allowed_1, allowed_2] END,
            lambda x: list_contains(list_transform(string_split(target_schemas, ','), lambda y: trim(y)), x)) AS scanned
        FROM fx_validated WHERE is_valid)"""
_AUDIT_STATUS = "CASE WHEN len(scanned) > 0 THEN 'SUBMITTED' ELSE 'REJECTED' END"

_FRESHNESS = f"""
    ordered AS (
        SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn,
               lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev
        FROM events WHERE ts <= TIMESTAMP '{EVENTS_AS_OF}'),
    newest AS (
        SELECT user_id, (epoch_us(ts) - epoch_us(prev)) / 1e6 AS gap, isodow(prev) AS dow
        FROM ordered WHERE rn <= 30 AND prev IS NOT NULL),
    last AS (SELECT user_id, max(ts) AS last_commit FROM ordered GROUP BY user_id),
    same AS (
        SELECT n.*, dow = isodow(last_commit) AS is_same,
               count(*) FILTER (WHERE dow = isodow(last_commit)) OVER (PARTITION BY n.user_id) AS n_same
        FROM newest n JOIN last l ON n.user_id = l.user_id),
    chosen AS (SELECT *, median(gap) OVER (PARTITION BY user_id) AS med FROM same WHERE is_same OR n_same < 3),
    spread AS (SELECT user_id, max(med) AS med, median(abs(gap - med)) AS mad FROM chosen GROUP BY user_id),
    gaps AS (
        SELECT l.user_id, last_commit, (SELECT count(*) FROM newest n WHERE n.user_id = l.user_id) AS num_gaps, med, mad,
               last_commit + to_microseconds(CAST(round((med + greatest(3 * 1.4826::DOUBLE * mad, 0.1::DOUBLE * med)) * 1e6) AS BIGINT)) AS due
        FROM last l LEFT JOIN spread s ON l.user_id = s.user_id),
    fresh AS (
        SELECT *, CASE WHEN num_gaps >= 5 THEN due END AS predicted,
               CASE WHEN num_gaps < 5 THEN 'Unknown' WHEN TIMESTAMP '{EVENTS_AS_OF}' > due THEN 'Unhealthy'
                    ELSE 'Healthy' END AS freshness_status
        FROM gaps)"""

_COMPLETENESS_STATUS = """CASE WHEN silent THEN 'Unhealthy' WHEN floor_rows IS NULL THEN 'Unknown'
    WHEN actual_rows < floor_rows THEN 'Unhealthy' ELSE 'Healthy' END"""


def _millis(column: str, name: str | None = None) -> str:
    """JSON carries milliseconds."""
    return f"date_trunc('millisecond', {column}) AS {name or column}"


def _payload(columns: str, where: str = "true") -> str:
    return f"""SELECT table_id AS event_key, {_millis("event_time")}, {columns}
               FROM fx_results WHERE {where}"""


_ANOMALY = "upper(status) <> 'HEALTHY'"
_RESULT = """catalog_name, schema_name, table_name, status,
             freshness_status, completeness_status, impact_level"""
_ANOMALY_PAYLOAD = _payload(
    f"{_RESULT}, {_millis('last_commit')}, actual_rows, min_expected_rows, downstream_tables, "
    "queries_affected",
    _ANOMALY,
)

_DETAIL_ORDER = """usage_date DESC NULLS LAST, workspace_id, sku_name, usage_quantity,
                   schema_id NULLS FIRST, table_id"""
_CHARGED = """
    SELECT billing_code, requesting_team, CAST(date_trunc('month', usage_date) AS DATE) AS usage_month,"""

_BILLING_UNITS = f"""{_CHARGED}
               {rounded("sum(usage_quantity)", 4)} AS total_dbus,
               count(DISTINCT job_run_id) AS scan_runs, count(*) AS billing_events
        FROM fx_scanning WHERE billing_code IS NOT NULL GROUP BY ALL"""
_AUDIT_ROWS = f"""
    WITH {_AUDIT}
    SELECT request_id, billing_code, client_name, nullif(array_to_string(scanned, ','), '') AS schemas_scanned,
           'scan-' || billing_code || '-' || request_id AS job_run_id, requested_by,
           DATE '{EVENTS_AS_OF[:10]}' AS request_time, {_AUDIT_STATUS} AS status
    FROM entries"""


ORACLE: dict[str, str] = {
    # --- rule scan
    "rule_bindings": "SELECT * FROM fx_bindings",
    "rule_template": """
        SELECT catalog_name, schema_name, table_name,
               'dq_check_' || replace(rule_name, ' ', '_') AS check_name,
               replace(sql_expression, '{col}', '`' || column_name || '`') AS predicate
        FROM fx_bindings""",
    "rule_row_flags": f"""
        SELECT c_custkey, array_to_string(list_filter([
                   CASE WHEN {_BROKEN["Balance In Range"].replace("x ", "c_acctbal ")}
                        THEN 'dq_check_Balance_In_Range' END,
                   CASE WHEN {_BROKEN["Known Segment"].replace("x ", "c_mktsegment ")}
                        THEN 'dq_check_Known_Segment' END,
                   CASE WHEN NOT regexp_matches(c_name, '^[A-Za-z][A-Za-z'' -]*$')
                        THEN 'dq_check_Name_Conformance' END], lambda e: e IS NOT NULL), ',') AS errors,
               CASE WHEN c_acctbal < 0 THEN 'dq_check_Balance_Not_Negative' END AS warnings
        FROM customer""",
    "rule_scan_summary": _scan_sql(table="customer"),
    "universal_scan": _scan_sql(),
    "scan_with_exclusions": f"""
        SELECT * FROM ({_scan_sql()})
        WHERE table_name NOT IN ({_EXCLUDED})""",
    "scan_with_bad_rules": f"""
        SELECT * EXCLUDE (scan_date, run_id), false AS failed FROM ({_scan_sql()})
        UNION ALL {_FAILED}""",
    "name_conformance": _scan_sql("Name Conformance"),
    "email_conformance": _scan_sql("Email Conformance"),
    "warn_rules": _scan_sql("Balance Not Negative", "Priority Specified", "Text Long Enough"),
    # --- scores
    "error_rate_all_time": f"""
        SELECT table_name, rule_name, CAST(sum(total_rows) AS BIGINT) AS total_scanned,
               CAST(sum(rows_error) AS BIGINT) AS total_errors,
               {rounded("sum(rows_error) * 100.0 / nullif(sum(total_rows), 0)", 2)} AS error_rate_pct
        FROM fx_dq GROUP BY ALL""",
    "error_rate_latest_run": _latest_rates(
        "SELECT run_id FROM fx_dq ORDER BY scan_date DESC, run_id DESC LIMIT 1"
    ),
    "error_rate_largest_run_id": _latest_rates("SELECT max(run_id) FROM fx_dq"),
    "error_rate_latest_per_table": f"""
        SELECT table_name, rule_name, total_rows, rows_error, {rounded("rate", 2)} AS error_rate_pct
        FROM fx_latest_of_table""",
    "dq_score_latest_per_table": _score_rows("scan_date").replace("fx_latest", "fx_latest_of_table"),
    "top_error_tables_per_table": f"""
        SELECT table_name, CAST(sum(total_rows) AS BIGINT) AS total_rows,
               CAST(sum(rows_error) AS BIGINT) AS rows_error,
               {rounded("sum(rows_error) * 100.0 / nullif(sum(total_rows), 0)", 2)} AS error_rate_pct
        FROM fx_latest_of_table GROUP BY table_name ORDER BY error_rate_pct DESC NULLS LAST, table_name LIMIT 5""",
    "dq_daily_trend": f"""
        SELECT CAST(scan_date AS DATE) AS scan_day, table_name, rule_name,
               {rounded("avg(rows_error * 100.0 / nullif(total_rows, 0))", 2)} AS avg_error_rate
        FROM fx_dq GROUP BY ALL""",
    "dq_score_by_table": _score_rows("scan_date"),
    "fn_dq_score_by_table": _score_rows("CAST(scan_date AS DATE)"),
    "dq_trend_window": _TREND_ROWS,
    "fn_dq_trend": _TREND_ROWS,
    "dq_table_score": f"""
        SELECT w.table_name, s.score, coalesce(s.status, 'NO DATA') AS status
        FROM (SELECT table_name FROM fx_dq UNION SELECT 'cat.sch.' || lang FROM documents) w
        LEFT JOIN ({_table_scores()}) s ON w.table_name = s.table_name""",
    "dq_scorecard": f"""
        SELECT d.table_name, CAST(sum(total_rows) AS BIGINT) AS total_scanned,
               CAST(sum(rows_error) AS BIGINT) AS total_errors,
               CAST(sum(rows_warn) AS BIGINT) AS total_warnings,
               count(DISTINCT rule_name) AS rules, count(DISTINCT run_id) AS runs, score, status
        FROM fx_dq d JOIN ({_table_scores()}) s ON d.table_name = s.table_name
        GROUP BY d.table_name, score, status""",
    "dq_scorecard_warnings": f"""
        SELECT * FROM ({_table_scores("table_name || '.' || run_id")}) WHERE status = 'WARN'""",
    "top_error_tables": f"""
        SELECT table_name, CAST(sum(total_rows) AS BIGINT) AS total_rows,
               CAST(sum(rows_error) AS BIGINT) AS rows_error,
               {rounded("sum(rows_error) * 100.0 / nullif(sum(total_rows), 0)", 2)} AS error_rate_pct
        FROM fx_latest GROUP BY table_name ORDER BY error_rate_pct DESC NULLS LAST, table_name LIMIT 5""",
    # --- tags and enrolment
    "set_tags": """
        SELECT * FROM fx_new_tags
        UNION ALL SELECT * FROM fx_schema_tags o WHERE NOT EXISTS (
            SELECT 1 FROM fx_new_tags n WHERE n.catalog_name = o.catalog_name
              AND n.schema_name = o.schema_name AND n.tag_name = o.tag_name)""",
    "tagged_schemas": """
        SELECT DISTINCT catalog_name, schema_name FROM fx_schema_tags
        WHERE tag_name = 'dqm_monitor' AND tag_value = 'enabled'""",
    "tagged_schemas_audit": """
        SELECT DISTINCT * FROM fx_schema_tags
        WHERE tag_name = 'dqm_monitor' AND tag_value = 'enabled'""",
    "tag_listing": "SELECT * FROM fx_schema_tags WHERE catalog_name = 'SALES_EU'",
    "tag_value_listing": """
        SELECT catalog_name, schema_name, tag_value AS dqm_tag_value
        FROM fx_schema_tags WHERE tag_name = 'dqm_monitor'""",
    "owner_inventory": """
        SELECT tag_value AS askid, catalog_name, schema_name, tag_name
        FROM fx_schema_tags WHERE tag_name = 'askid'""",
    "bulk_enrol": """
        SELECT DISTINCT t.catalog_name || '.' || t.schema_name AS schema_full_name,
               CASE WHEN s.schema_id IS NULL
                    THEN 'ERROR: ' || substr('Schema ''' || t.catalog_name || '.' || t.schema_name
                                             || ''' does not exist.', 1, 100)
                    WHEN m.schema_name IS NOT NULL THEN 'ALREADY ENABLED'
                    ELSE 'ENABLED' END AS status
        FROM fx_schema_tags t
        LEFT JOIN fx_schemata s ON t.catalog_name = s.catalog_name AND t.schema_name = s.schema_name
        LEFT JOIN fx_monitors m ON t.catalog_name = m.catalog_name AND t.schema_name = m.schema_name
        WHERE t.tag_name = 'dqm_monitor' AND t.tag_value = 'enabled'""",
    "monitors_after_enrol": f"""
        SELECT * FROM fx_monitors
        UNION ALL
        SELECT s.catalog_name, s.schema_name, DATE '{EVENTS_AS_OF[:10]}'
        FROM fx_tag_dim s
        WHERE s.tag_name = 'dqm_monitor' AND s.tag_value = 'enabled' AND NOT EXISTS (
            SELECT 1 FROM fx_monitors m
            WHERE m.catalog_name = s.catalog_name AND m.schema_name = s.schema_name)""",
    "monitors_after_reset": f"""
        SELECT * FROM fx_monitors WHERE schema_name <> 'SCHEMA_1'
        UNION ALL SELECT catalog_name, schema_name, DATE '{EVENTS_AS_OF[:10]}'
        FROM fx_schemata WHERE schema_name = 'SCHEMA_1'""",
    "exclude_tagged_tables": """
        SELECT b.*, t.excluded = 'false' AS scanned
        FROM fx_bindings b JOIN fx_table_tags t ON b.catalog_name = t.catalog_name
          AND b.schema_name = t.schema_name AND b.table_name = t.table_name""",
    "schema_tag_dim": """
        SELECT tag_value AS askid, schema_id, catalog_name, schema_name
        FROM fx_tag_dim WHERE tag_name = 'askid'""",
    "tagged_columns": """
        SELECT catalog_name, schema_name, table_name, column_name, tag_value
        FROM fx_column_tags WHERE tag_name = 'dq_type' AND schema_name = 'SCHEMA_1'""",
    # --- table health
    "freshness_check": f"""
        WITH {_FRESHNESS}
        SELECT CAST(user_id AS VARCHAR) AS table_id, last_commit, num_gaps,
               {rounded("med", 3)} AS median_gap_sec, {rounded("mad", 3)} AS mad_gap_sec,
               {_millis("predicted", "predicted_commit")}, freshness_status
        FROM fresh""",
    "completeness_check": f"""
        WITH {_buckets("events", "event_type", "ts", VOLUME_AS_OF)}
        SELECT event_type, actual_rows, baseline_days, {rounded("expected_rows", 4)} AS expected_rows,
               {rounded("mad_rows", 4)} AS mad_rows,
               {rounded("floor_rows", 4)} AS min_predicted_rows,
               {_COMPLETENESS_STATUS} AS completeness_status
        FROM judged""",
    "percent_null_check": f"""
        WITH cells AS (
            SELECT ts, unnest(['event_type', 'value', 'props']) AS column_name,
                   unnest([event_type = 'signup', ts >= TIMESTAMP '2024-01-30' AND value > 20,
                           false]) AS is_null
            FROM events
            WHERE ts <= TIMESTAMP '{EVENTS_AS_OF}'
              AND ts > TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 15 DAY),
        days AS (
            SELECT column_name, CAST(floor((epoch_us(TIMESTAMP '{EVENTS_AS_OF}') - epoch_us(ts))
                                     / 86400000000.0) AS BIGINT) AS bucket,
                   count(*) FILTER (WHERE is_null) * 100.0 / count(*) AS pct
            FROM cells GROUP BY ALL),
        stats AS (
            SELECT column_name, max(pct) FILTER (WHERE bucket = 0) AS null_pct,
                   count(*) FILTER (WHERE bucket > 0) AS baseline_days,
                   avg(pct) FILTER (WHERE bucket > 0) AS mean,
                   stddev_samp(pct) FILTER (WHERE bucket > 0) AS sd
            FROM days GROUP BY column_name)
        SELECT column_name, baseline_days, {rounded("null_pct", 4)} AS null_pct,
               {rounded("mean", 4)} AS avg_null_pct,
               {rounded("greatest(1.0, mean + 3 * sd)", 4)} AS max_predicted_pct,
               CASE WHEN null_pct > greatest(1.0, mean + 3 * sd) THEN 'Unhealthy'
                    ELSE 'Healthy' END AS null_status
        FROM stats""",
    "table_results": f"""
        WITH RECURSIVE {_FRESHNESS},
        {_buckets("events", "user_id", "ts", VOLUME_AS_OF)},
        edges AS (
            SELECT DISTINCT * FROM (
                SELECT CAST(l_partkey AS VARCHAR) AS root,
                       CAST(CASE WHEN l_linenumber < 4 THEN (l_partkey + 2) // 3
                                 ELSE (l_partkey + 4) // 5 END AS VARCHAR) AS table_id
                FROM lineitem) WHERE root <> table_id),
        reach AS (
            SELECT root, table_id FROM edges
            UNION SELECT r.root, e.table_id FROM reach r JOIN edges e ON r.table_id = e.root WHERE e.table_id <> r.root),
        fan_out AS (SELECT root, count(*) AS n FROM reach GROUP BY root),
        affected AS (SELECT * FROM reach UNION SELECT table_id, table_id FROM fx_tables),
        said AS (
            SELECT statement_id, regexp_extract(upper(statement_text),
                   'FROM ([A-Z0-9_]+\\.[A-Z0-9_]+\\.[A-Z0-9_]+) ', 1) AS name FROM fx_history),
        asked AS (
            SELECT a.root, count(DISTINCT s.statement_id) AS n
            FROM said s JOIN fx_tables t
              ON s.name = upper(t.catalog_name || '.' || t.schema_name || '.' || t.table_name)
            JOIN affected a ON a.table_id = t.table_id GROUP BY a.root),
        both_checks AS (
            SELECT coalesce(f.user_id, j.user_id) AS user_id, f.last_commit,
                   coalesce(f.freshness_status, 'Unknown') AS freshness_status,
                   CASE WHEN j.user_id IS NULL THEN 'Unknown'
                        ELSE {_COMPLETENESS_STATUS} END AS daily_status,
                   actual_rows, CAST(ceil(floor_rows) AS BIGINT) AS min_expected_rows
            FROM fresh f FULL JOIN judged j ON f.user_id = j.user_id),
        totals AS (
            SELECT user_id, CAST(sum(floor(value)) AS BIGINT) AS total_rows,
                   CAST(ceil(sum(floor(value)) FILTER (WHERE ts <= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 1 DAY)
                             * 0.9::DOUBLE) AS BIGINT) AS min_total_rows
            FROM events WHERE ts <= TIMESTAMP '{EVENTS_AS_OF}' GROUP BY user_id),
        checked AS (
            SELECT c.*, total_rows, min_total_rows,
                   CASE WHEN min_total_rows IS NULL THEN 'Unknown' WHEN total_rows < min_total_rows THEN 'Unhealthy'
                        ELSE 'Healthy' END AS total_status
            FROM both_checks c LEFT JOIN totals t ON c.user_id = t.user_id),
        last_write AS (
            SELECT CAST(l_partkey AS VARCHAR) AS table_id, run_name, result_state
            FROM lineitem JOIN fx_timeline ON l_orderkey = run_id WHERE end_time <= TIMESTAMP '{EVENTS_AS_OF}'
            QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY end_time DESC, run_id DESC) = 1),
        failed AS (SELECT * FROM last_write WHERE result_state = 'FAILED'),
        walk AS (
            SELECT CAST(user_id AS VARCHAR) AS root, CAST(user_id AS VARCHAR) AS table_id, 0 AS depth
            FROM both_checks WHERE 'Unhealthy' IN (freshness_status, daily_status)
            UNION SELECT w.root, e.root, depth + 1 FROM walk w JOIN edges e ON e.table_id = w.table_id),
        blamed AS (
            SELECT w.root, run_name, rank() OVER (PARTITION BY w.root ORDER BY depth) AS near
            FROM walk w JOIN failed f ON w.table_id = f.table_id),
        causes AS (
            SELECT root, string_agg(DISTINCT run_name, ',' ORDER BY run_name) AS upstream_jobs
            FROM blamed WHERE near = 1 GROUP BY root)
        SELECT DATE '{EVENTS_AS_OF[:10]}' AS event_day, t.catalog_name, t.schema_name, t.table_name,
               s.schema_id, t.table_id,
               CASE WHEN 'Unhealthy' IN (freshness_status, daily_status, total_status) THEN 'Unhealthy'
                    WHEN freshness_status = 'Unknown' AND daily_status = 'Unknown' AND total_status = 'Unknown'
                    THEN 'Unknown' ELSE 'Healthy' END AS status,
               freshness_status, last_commit,
               CASE WHEN 'Unhealthy' IN (daily_status, total_status) THEN 'Unhealthy'
                    WHEN daily_status = 'Unknown' AND total_status = 'Unknown' THEN 'Unknown'
                    ELSE 'Healthy' END AS completeness_status,
               actual_rows, min_expected_rows, total_status, total_rows, min_total_rows,
               CASE WHEN total_status = 'Unhealthy' THEN 'ROWS_LOST' END AS total_error,
               CASE WHEN coalesce(o.n, 0) >= 10 OR coalesce(a.n, 0) >= 100 THEN 'HIGH'
                    WHEN coalesce(o.n, 0) > 0 OR coalesce(a.n, 0) > 0 THEN 'MEDIUM'
                    ELSE 'LOW' END AS impact_level,
               coalesce(o.n, 0) AS num_downstream_tables,
               coalesce(a.n, 0) AS num_queries_on_affected_tables, upstream_jobs
        FROM checked c
        JOIN fx_tables t ON t.table_id = CAST(c.user_id AS VARCHAR)
        LEFT JOIN fx_schemata s ON s.catalog_name = t.catalog_name AND s.schema_name = t.schema_name
        LEFT JOIN fan_out o ON o.root = t.table_id
        LEFT JOIN asked a ON a.root = t.table_id
        LEFT JOIN causes ON causes.root = t.table_id""",
    "health_recent": f"""
        SELECT event_time, {_RESULT} FROM fx_results
        ORDER BY event_time DESC, catalog_name, schema_name, table_name, status NULLS FIRST,
                 freshness_status, completeness_status, impact_level LIMIT 50""",
    "health_anomalies": f"""
        SELECT event_time, catalog_name || '.' || schema_name || '.' || table_name AS full_table_name,
               status, freshness_status, last_commit, predicted_commit, actual_rows,
               min_expected_rows, impact_level, downstream_tables, queries_affected
        FROM fx_results WHERE {_ANOMALY}""",
    "anomaly_preview": f"""
        SELECT event_time, catalog_name, schema_name, table_name, status,
               freshness_status AS freshness, completeness_status AS completeness,
               impact_level AS impact
        FROM fx_results WHERE {_ANOMALY}""",
    "last_scan_per_schema": "SELECT * FROM fx_scans",
    "scan_coverage": """
        SELECT s.catalog_name, s.schema_name,
               CASE WHEN l.last_scan_time IS NOT NULL THEN 'DQM ENABLED' ELSE 'NOT ENABLED' END AS dqm_status,
               l.last_scan_time, l.tables_monitored
        FROM fx_schemata s LEFT JOIN fx_scans l
          ON s.catalog_name = l.catalog_name AND s.schema_name = l.schema_name""",
    "tag_vs_scan": """
        SELECT coalesce(t.catalog_name, s.catalog_name) AS catalog_name,
               coalesce(t.schema_name, s.schema_name) AS schema_name,
               CASE WHEN t.tag_value IS NOT NULL THEN 'YES' ELSE 'NO' END AS tagged_for_dqm,
               CASE WHEN s.last_scan_time IS NOT NULL THEN 'YES' ELSE 'NO' END AS has_scan_results,
               s.last_scan_time, s.tables_monitored
        FROM (SELECT * FROM fx_schema_tags WHERE tag_name = 'dqm_monitor') t
        FULL JOIN fx_scans s ON t.catalog_name = s.catalog_name AND t.schema_name = s.schema_name""",
    "health_by_project": """
        SELECT d.tag_value AS askid, r.catalog_name, r.schema_name, r.table_name, r.event_time,
               r.status, r.freshness_status, r.completeness_status, r.impact_level
        FROM fx_results r JOIN fx_tag_dim d ON r.schema_id = d.schema_id
        WHERE d.tag_name = 'askid'""",
    "health_summary": f"""
        WITH newest AS (
            SELECT *, row_number() OVER (PARTITION BY catalog_name, schema_name, table_name
                                         ORDER BY event_time DESC, event_id DESC) AS rn
            FROM fx_results)
        SELECT d.tag_value AS askid, count(DISTINCT table_name) AS tables_monitored,
               count(*) FILTER (WHERE upper(status) = 'HEALTHY') AS healthy_tables,
               count(*) FILTER (WHERE {_ANOMALY}) AS unhealthy_tables,
               {rounded("count(*) FILTER (WHERE upper(status) = 'HEALTHY') * 100.0 / count(*)", 1)} AS health_pct
        FROM newest r JOIN fx_tag_dim d ON r.schema_id = d.schema_id
        WHERE d.tag_name = 'askid' AND rn = 1 GROUP BY ALL""",
    "health_trend": f"""
        SELECT CAST(event_time AS DATE) AS event_day, count(*) AS results,
               count(*) FILTER (WHERE freshness_status = 'Unhealthy') AS stale_results,
               count(*) FILTER (WHERE completeness_status = 'Unhealthy') AS incomplete_results,
               {rounded("count(*) FILTER (WHERE freshness_status = 'Unhealthy') * 100.0 / count(*)", 2)} AS stale_pct,
               {rounded("count(*) FILTER (WHERE completeness_status = 'Unhealthy') * 100.0 / count(*)", 2)} AS incomplete_pct
        FROM fx_results GROUP BY ALL""",
    # --- events
    "event_payload": _payload(
        f"""{_RESULT}, table_id, {_millis("last_commit", "freshness_last_commit")},
            {_millis("predicted_commit", "freshness_predicted_commit")},
            actual_rows AS completeness_actual_rows,
            min_expected_rows AS completeness_min_expected, downstream_tables"""
    ),
    "event_payload_brief": _payload(_RESULT),
    "event_anomalies_only": _ANOMALY_PAYLOAD,
    "event_stream": _ANOMALY_PAYLOAD,
    # --- chargeback through schema tags
    "usage_detail": f"""
        SELECT usage_date, workspace_id, sku_name, usage_quantity, schema_id, table_id,
               billing_origin_product
        FROM fx_monitoring ORDER BY {_DETAIL_ORDER} LIMIT 50""",
    "chargeback_units": f"""
        SELECT d.tag_value AS tenant, d.catalog_name, d.schema_name,
               CAST(date_trunc('month', u.usage_date) AS DATE) AS usage_month,
               {rounded("sum(u.usage_quantity)", 4)} AS total_dbus, count(*) AS billing_events
        FROM fx_monitoring u JOIN fx_tag_dim d ON u.schema_id = d.schema_id
        WHERE d.tag_name = 'tenant' GROUP BY ALL""",
    "price_usage": f"""
        SELECT u.sku_name, p.price AS unit_price, count(*) AS usage_rows,
               sum(u.usage_quantity) AS total_units,
               {rounded("sum(u.usage_quantity * p.price)", 2)} AS total_cost,
               min(u.usage_start_time) AS first_start, max(u.usage_start_time) AS last_start
        FROM fx_usage u JOIN fx_prices p ON {_PRICED} GROUP BY ALL""",
    "price_usage_daily": f"""
        SELECT u.sku_name, count(*) AS usage_rows, {rounded("sum(u.usage_quantity * p.price)", 2)} AS total_cost
        FROM fx_usage u JOIN fx_daily_prices p ON u.sku_name = p.sku_name
          AND u.usage_start_time >= p.day AND u.usage_start_time < p.day + INTERVAL 1 DAY GROUP BY ALL""",
    "chargeback_cost": _units_and_cost("tenant", "tenant"),
    "chargeback_project": _units_and_cost("askid", "askid"),
    "chargeback_by_table": f"""
        SELECT d.tag_value AS tenant,
               coalesce(t.catalog_name || '.' || t.schema_name || '.' || t.table_name, u.table_id) AS table_path,
               CAST(date_trunc('month', u.usage_date) AS DATE) AS usage_month,
               {rounded("sum(u.usage_quantity)", 4)} AS total_dbus, count(*) AS scan_count
        FROM fx_monitoring u
        LEFT JOIN fx_tag_dim d ON u.schema_id = d.schema_id AND d.tag_name = 'tenant'
        LEFT JOIN fx_tables t ON u.table_id = t.table_id GROUP BY ALL""",
    # --- query history
    "query_usage_by_project": f"""
        SELECT d.tag_value AS askid, {_QUERY_NUMBERS}
        FROM fx_history q JOIN fx_tag_dim d ON d.tag_name = 'askid' AND {_MENTIONS}
        WHERE {_ORDERS_SINCE} AND q.execution_status IN ('FINISHED', 'FAILED') GROUP BY ALL""",
    "query_usage_exact": f"""
        WITH named AS (
            SELECT *, unnest(list_distinct(regexp_extract_all(upper(statement_text),
                             '([A-Z0-9_]+\\.[A-Z0-9_]+)\\.', 1))) AS name
            FROM fx_history)
        SELECT d.tag_value AS askid, {_QUERY_NUMBERS}
        FROM named q JOIN fx_tag_dim d
          ON d.tag_name = 'askid' AND q.name = upper(d.catalog_name) || '.' || upper(d.schema_name)
        WHERE {_ORDERS_SINCE} AND q.execution_status IN ('FINISHED', 'FAILED') GROUP BY ALL""",
    "full_chargeback": f"""
        WITH owned AS (SELECT *, tag_value AS askid FROM fx_tag_dim WHERE tag_name = 'askid'),
        cost AS (
            SELECT askid, {rounded("sum(usage_quantity)", 4)} AS units
            FROM fx_monitoring u JOIN owned o ON u.schema_id = o.schema_id
            WHERE usage_date >= DATE '{EVENTS_AS_OF[:10]}' - 12000 GROUP BY askid),
        health AS (
            SELECT askid, count(DISTINCT table_name) AS tables,
                   count(*) FILTER (WHERE {_ANOMALY}) AS anomalies
            FROM fx_results r JOIN owned o ON r.schema_id = o.schema_id
            WHERE event_time >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 12000 DAY GROUP BY askid),
        volume AS (
            SELECT askid, count(*) AS queries,
                   {rounded("CAST(sum(total_duration_ms) AS DOUBLE) / 3600000", 2)} AS hours
            FROM fx_history q JOIN owned d ON {_MENTIONS}
            WHERE start_time >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 12000 DAY GROUP BY askid)
        SELECT a.askid, a.schemas, coalesce(c.units, 0) AS dqm_dbus_30d,
               coalesce(h.tables, 0) AS tables_monitored, coalesce(h.anomalies, 0) AS anomalies_30d,
               coalesce(v.queries, 0) AS queries_30d, coalesce(v.hours, 0) AS compute_hours_30d
        FROM (SELECT askid, string_agg(DISTINCT catalog_name || '.' || schema_name, ','
                     ORDER BY catalog_name || '.' || schema_name) AS schemas
              FROM owned GROUP BY askid) a
        LEFT JOIN cost c ON a.askid = c.askid LEFT JOIN health h ON a.askid = h.askid
        LEFT JOIN volume v ON a.askid = v.askid""",
    # --- chargeback through usage tags
    "tagged_usage_detail": """
        SELECT usage_date, billing_code, requesting_team, cost_center, sku_name,
               billing_origin_product, usage_quantity AS dbus, job_id, job_run_id
        FROM fx_scanning WHERE billing_code IS NOT NULL
        ORDER BY usage_date DESC, billing_code, requesting_team, cost_center, sku_name,
                 billing_origin_product, usage_quantity, job_id, job_run_id LIMIT 50""",
    "billing_units": _BILLING_UNITS,
    "billing_units_promoted": _BILLING_UNITS,
    "billing_cost": f"""{_CHARGED}
               {rounded("sum(usage_quantity)", 4)} AS total_dbus,
               {rounded("sum(usage_quantity * p.price)", 2)} AS estimated_cost_usd
        FROM fx_scanning u JOIN fx_prices p ON {_PRICED}
        WHERE billing_code IS NOT NULL GROUP BY ALL""",
    "billing_run_detail": """
        SELECT billing_code, requesting_team, usage_date, job_id, job_run_id AS run_id, sku_name,
               usage_quantity AS dbus, scan_type
        FROM fx_scanning WHERE billing_code IS NOT NULL
        ORDER BY usage_date DESC, billing_code, requesting_team, job_id, job_run_id, sku_name,
                 usage_quantity, scan_type LIMIT 100""",
    "run_timeline_cost": f"""
        SELECT run_name, result_state, start_time, end_time,
               date_sub('minute', start_time, end_time) AS duration_minutes,
               billing_code, requesting_team, {rounded("sum(usage_quantity)", 4)} AS total_dbus
        FROM fx_timeline j JOIN fx_scanning u ON u.job_run_id = CAST(j.run_id AS VARCHAR)
        GROUP BY ALL
        ORDER BY start_time DESC, run_name, result_state, end_time, duration_minutes,
                 billing_code NULLS FIRST, requesting_team NULLS FIRST LIMIT 50""",
    "billing_summary_all": f"""
        SELECT billing_code, requesting_team AS team,
               CAST(date_trunc('month', usage_date) AS DATE) AS month,
               {rounded("sum(usage_quantity)", 4)} AS dbus
        FROM fx_scanning GROUP BY ALL""",
    "fn_chargeback": f"""{_CHARGED}
               {rounded("sum(usage_quantity)", 4)} AS total_dbus,
               count(DISTINCT job_run_id) AS scan_runs
        FROM fx_scanning
        WHERE billing_code = 'ORCHID-11' AND usage_date >= DATE '{USAGE_AS_OF[:10]}' - INTERVAL 24 MONTH
        GROUP BY ALL""",
    "fn_dq_chargeback": f"""{_CHARGED}
               {rounded("sum(usage_quantity)", 4)} AS total_dbus,
               count(DISTINCT job_run_id) AS scan_runs
        FROM fx_scanning
        WHERE billing_code IS NOT NULL AND usage_date >= DATE '{USAGE_AS_OF[:10]}' - INTERVAL 24 MONTH
        GROUP BY ALL""",
    "resolve_custom_tags": """
        WITH policies AS (
            SELECT p_partkey % 5 AS n, min(p_brand) AS brand FROM part GROUP BY ALL),
        resolved AS (
            SELECT is_serverless, usage_quantity, 'billing_code' AS k, 'POL-' || n AS v
            FROM fx_usage JOIN policies ON policy_id = 'pol-' || n WHERE is_serverless
            UNION ALL SELECT is_serverless, usage_quantity, 'cost_center', brand
            FROM fx_usage JOIN policies ON policy_id = 'pol-' || n WHERE is_serverless
            UNION ALL SELECT is_serverless, usage_quantity, 'billing_code', 'JOB-' || s_nationkey
            FROM fx_usage JOIN supplier ON job_id = CAST(s_suppkey AS VARCHAR) WHERE NOT is_serverless
            UNION ALL SELECT is_serverless, usage_quantity, 'cost_center', 'DQ-Scanning'
            FROM fx_usage JOIN supplier ON job_id = CAST(s_suppkey AS VARCHAR) WHERE NOT is_serverless)
        SELECT is_serverless, k, v, count(*) AS usage_rows, sum(usage_quantity) AS units
        FROM resolved GROUP BY ALL""",
    # --- registry
    "registry_merge": f"""
        SELECT billing_code, client_name, contact_email, schemas_allowed, is_active, created_at
        FROM fx_registry
        UNION ALL
        SELECT DISTINCT 'BC-' || (o_custkey * 2), 'Newcomer', CAST(NULL AS VARCHAR),
               CAST(NULL AS VARCHAR), true, DATE '{EVENTS_AS_OF[:10]}'
        FROM orders WHERE 'BC-' || (o_custkey * 2) NOT IN (SELECT billing_code FROM fx_registry)""",
    "request_validation": """
        SELECT request_id, billing_code, client_name, target_schemas, schemas_allowed, requested_by,
               is_valid,
               CASE WHEN NOT is_valid THEN 'Unknown or inactive billing code' END AS reason
        FROM fx_validated""",
    "dispatch_scans": """
        SELECT w.billing_code, w.client_name AS requesting_team, b.schema_name, b.rule_name,
               count(DISTINCT w.request_id) AS requests, count(*) AS bindings,
               'DQ-Scanning' AS cost_center, 'ad-hoc' AS scan_type
        FROM fx_wanted w
        JOIN fx_bindings b ON w.schema_full_name = b.catalog_name || '.' || b.schema_name
        WHERE w.is_allowed GROUP BY ALL""",
    "rejected_requests": """
        SELECT request_id, billing_code, CAST(NULL AS VARCHAR) AS schema_full_name,
               'Unknown or inactive billing code' AS reason
        FROM fx_validated WHERE NOT is_valid
        UNION ALL
        SELECT request_id, billing_code, schema_full_name, 'Schema not allowed for this client'
        FROM fx_wanted WHERE NOT is_allowed""",
    "audit_append": _AUDIT_ROWS,
    "request_stream": _AUDIT_ROWS,
    "audit_view": f"""
        WITH {_AUDIT}
        SELECT request_id, client_name, DATE '{EVENTS_AS_OF[:10]}' AS request_time,
               CASE WHEN len(scanned) = 0 THEN 'REJECTED' WHEN CAST(request_id AS BIGINT) % 3 = 0 THEN 'COMPLETED'
                    WHEN CAST(request_id AS BIGINT) % 3 = 1 THEN 'FAILED' ELSE 'SUBMITTED' END AS status
        FROM entries""",
    # --- profiling
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("customer", "orders", "lineitem", "part", "supplier", "events", "documents")
    ),
    "null_profile": f"""
        SELECT column_name, total_rows, null_rows,
               {rounded("null_rows * 100.0 / total_rows", 2)} AS null_pct
        FROM (SELECT unnest(['c_custkey', 'segment', 'email']) AS column_name, count(*) AS total_rows,
                     unnest([count(*) - count(c_custkey), count(*) - count(segment),
                             count(*) - count(email)]) AS null_rows
              FROM fx_contacts)""",
    "value_counts": "SELECT segment, count(*) AS count FROM fx_contacts GROUP BY segment",
}


def _needed(sql: str) -> list[str]:
    """Views a text refers to, each after the views it needs itself."""
    out: list[str] = []
    for name in re.findall(r"\bfx_\w+", sql):
        for dependency in [*_needed(VIEWS[name]), name]:
            if dependency not in out:
                out.append(dependency)
    return out


def statement(key: str) -> str:
    """The oracle of a query as one self-contained statement."""
    sql = ORACLE[key].strip()
    ctes = [f"{name} AS ({VIEWS[name].strip()})" for name in _needed(sql)]
    if not ctes:
        return sql
    for head in ("WITH RECURSIVE ", "WITH "):
        if sql.startswith(head):
            return head + ",\n".join(ctes) + ",\n" + sql.removeprefix(head)
    return "WITH " + ",\n".join(ctes) + "\n" + sql
