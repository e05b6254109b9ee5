"""Declared schemas of the input and output tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, BOOLEAN = T.StringType(), T.LongType(), T.BooleanType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()
MONEY = T.DecimalType(18, 6)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def strings(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, STRING)


RULE_MAPPING = struct(
    **strings("tag_name", "tag_value", "rule_name", "sql_expression", "criticality"),
    created_at=TIMESTAMP,
)
DQ_RESULTS = struct(
    **strings("table_name", "column_name", "rule_name"),
    total_rows=LONG,
    rows_error=LONG,
    rows_warn=LONG,
    scan_date=TIMESTAMP,
    run_id=STRING,
)
COLUMN_TAGS = struct(
    **strings("catalog_name", "schema_name", "table_name", "column_name", "tag_name", "tag_value")
)
TABLE_TAGS = struct(
    **strings("catalog_name", "schema_name", "table_name", "tag_name", "tag_value")
)
SCHEMA_TAGS = struct(**strings("catalog_name", "schema_name", "tag_name", "tag_value"))
SCHEMATA = struct(**strings("catalog_name", "schema_name", "schema_id"))
TABLES = struct(**strings("table_id", "catalog_name", "schema_name", "table_name"))
MONITORS = struct(**strings("catalog_name", "schema_name"), enabled_at=TIMESTAMP)
COMMITS = struct(table_id=STRING, commit_time=TIMESTAMP, rows_added=LONG)
LINEAGE = struct(**strings("upstream_table_id", "downstream_table_id"))


def _checked(value: T.DataType, prediction: str) -> T.StructType:
    return struct(**strings("status", "error_code"), last_value=value, **{prediction: value})


_COUNT = _checked(LONG, "min_predicted_value")
TABLE_RESULTS = struct(
    event_time=TIMESTAMP,
    **strings("catalog_name", "schema_name", "table_name", "schema_id", "table_id", "status"),
    freshness=struct(status=STRING, commit_freshness=_checked(TIMESTAMP, "predicted_value")),
    completeness=struct(status=STRING, total_row_count=_COUNT, daily_row_count=_COUNT),
    downstream_impact=struct(
        impact_level=STRING, num_downstream_tables=LONG, num_queries_on_affected_tables=LONG
    ),
    root_cause_analysis=struct(upstream_jobs=T.ArrayType(STRING)),
)
USAGE = struct(
    usage_date=DATE,
    usage_start_time=TIMESTAMP,
    **strings("workspace_id", "sku_name"),
    usage_quantity=MONEY,
    billing_origin_product=STRING,
    usage_metadata=struct(
        **strings("schema_id", "table_id", "job_id", "job_run_id", "notebook_id")
    ),
    custom_tags=T.MapType(STRING, STRING),
)
LIST_PRICES = struct(
    sku_name=STRING,
    price_start_time=TIMESTAMP,
    price_end_time=TIMESTAMP,
    pricing=struct(effective_list=struct(default=MONEY)),
)
QUERY_HISTORY = struct(
    statement_id=STRING,
    start_time=TIMESTAMP,
    **strings("statement_text", "execution_status"),
    total_duration_ms=LONG,
    read_rows=LONG,
    read_bytes=LONG,
)
JOB_RUN_TIMELINE = struct(
    run_id=LONG, **strings("run_name", "result_state"), start_time=TIMESTAMP, end_time=TIMESTAMP
)
POLICIES = struct(
    **strings("policy_id", "policy_name"),
    custom_tags=T.ArrayType(struct(**strings("key", "value"))),
)
JOBS = struct(**strings("job_id", "name"), tags=T.MapType(STRING, STRING))
CLIENT_REGISTRY = struct(
    **strings("billing_code", "client_name", "contact_email", "schemas_allowed"),
    is_active=BOOLEAN,
    created_at=TIMESTAMP,
)
SCAN_REQUESTS = struct(**strings("request_id", "billing_code", "schemas", "requested_by"))
SCAN_STATES = struct(**strings("request_id", "status"), state_time=TIMESTAMP)
SCAN_AUDIT_LOG = struct(
    **strings(
        "request_id", "billing_code", "client_name", "schemas_scanned", "job_run_id", "requested_by"
    ),
    request_time=TIMESTAMP,
    status=STRING,
)
