"""The registered queries: each operator over the sample views of a test directory."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagquality.fixtures.views import (
    EVENTS_AS_OF,
    ORDERS_AS_OF,
    USAGE_AS_OF,
    VOLUME_AS_OF,
    SampleTables,
)
from tagquality.functions import table_functions
from tagquality.operators import (
    chargeback,
    health,
    monitor,
    profile,
    query_usage,
    registry,
    rules,
    scan,
    scores,
    tags,
)
from tagquality.plans.session import cut, shared_folder
from tagquality.schemas import SCAN_AUDIT_LOG
from tagquality.sources.tables import append_results, write_promoted
from tagquality.streaming import events, requests

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_ID = "run-0001"
#: Requests in a file of the stream at most, about.
REQUESTS_PER_FILE = 250_000


def query(build: Callable[[SampleTables], DataFrame]) -> Callable[[SampleTables], DataFrame]:
    """Register a builder over the sample views under its own name."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(SampleTables(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def _scan_lines(results: DataFrame) -> DataFrame:
    return results.withColumn("scan_date", F.to_date("scan_date"))


def _scan_of(t: SampleTables, *rule_names: str) -> DataFrame:
    chosen = t.scan_rules.where(F.col("rule_name").isin(*rule_names)) if rule_names else t.scan_rules
    return _scan_lines(
        scan.run_scan(t.scan_tags, chosen, t.scanned_table, RUN_ID, EVENTS_AS_OF)
    )


def _rules_on(t: SampleTables, table: str) -> list[rules.BoundRule]:
    bindings = rules.discover_bindings(t.scan_tags.where(F.col("table_name") == table), t.scan_rules)
    return rules.bound_rules(bindings.collect())


# --- rule scan --------------------------------------------------------------------------


@query
def rule_bindings(t: SampleTables) -> DataFrame:
    return rules.discover_bindings(t.column_tags, t.rule_mapping)


@query
def rule_template(t: SampleTables) -> DataFrame:
    return rules.bound_texts(rules.discover_bindings(t.column_tags, t.rule_mapping)).select(
        "catalog_name", "schema_name", "table_name", "check_name", "predicate"
    )


@query
def rule_row_flags(t: SampleTables) -> DataFrame:
    flagged = rules.annotate_rows(t.base("customer"), _rules_on(t, "customer"))

    def names(column: str) -> Column:
        return F.array_join(F.sort_array(F.col(f"{column}.name")), ",")

    return flagged.select(
        "c_custkey", names("_errors").alias("errors"), names("_warnings").alias("warnings")
    )


@query
def rule_scan_summary(t: SampleTables) -> DataFrame:
    bound = _rules_on(t, "customer")
    return _scan_lines(
        scan.scan_table(t.base("customer"), "main.sales.customer", bound, RUN_ID, EVENTS_AS_OF)
    )


@query
def universal_scan(t: SampleTables) -> DataFrame:
    return _scan_of(t)


@query
def name_conformance(t: SampleTables) -> DataFrame:
    return _scan_of(t, "Name Conformance")


@query
def email_conformance(t: SampleTables) -> DataFrame:
    return _scan_of(t, "Email Conformance")


@query
def warn_rules(t: SampleTables) -> DataFrame:
    return _scan_of(t, "Balance Not Negative", "Priority Specified", "Text Long Enough")


@query
def scan_with_exclusions(t: SampleTables) -> DataFrame:
    return _scan_lines(
        scan.run_scan(
            t.scan_tags, t.scan_rules, t.scanned_table, RUN_ID, EVENTS_AS_OF, table_tags=t.scan_table_tags
        )
    )


@query
def scan_with_bad_rules(t: SampleTables) -> DataFrame:
    """A run in which some rules fail on data: what it appended, and what it reported."""
    root = f"{shared_folder(t.spark)}/scan/{uuid.uuid4()}"
    scan.run_scan_into(
        t.scan_tags,
        t.scan_rules.unionByName(t.failing_rules),
        t.scanned_table,
        append=lambda df: append_results(df, f"{root}/results"),
        run_id=RUN_ID,
        as_of=EVENTS_AS_OF,
        on_error="report",
        report=lambda df: df.write.mode("append").parquet(f"{root}/failed"),
        tables_per_write=3,
    )
    counts = ["total_rows", "rows_error", "rows_warn"]
    done = t.spark.read.parquet(f"{root}/results")
    failed = t.spark.read.parquet(f"{root}/failed")
    names = ["table_name", "column_name", "rule_name"]
    return done.select(*names, *counts, F.lit(False).alias("failed")).unionByName(
        failed.select(*names, *[F.lit(None).cast("long").alias(c) for c in counts], F.lit(True).alias("failed"))
    )


# --- scores -----------------------------------------------------------------------------


@query
def error_rate_all_time(t: SampleTables) -> DataFrame:
    return scores.error_rates(t.dq_results)


@query
def error_rate_latest_run(t: SampleTables) -> DataFrame:
    return scores.latest_run_rates(t.dq_results)


@query
def error_rate_largest_run_id(t: SampleTables) -> DataFrame:
    return scores.latest_run_rates(t.dq_results, latest_by="run_id")


@query
def error_rate_latest_per_table(t: SampleTables) -> DataFrame:
    return scores.latest_run_rates(t.dq_results, latest_by="table")


@query
def dq_score_latest_per_table(t: SampleTables) -> DataFrame:
    return scores.fn_score(t.dq_results, "i", latest_by="table")


@query
def top_error_tables_per_table(t: SampleTables) -> DataFrame:
    return scores.top_tables(t.dq_results, 5, latest_by="table")


@query
def dq_daily_trend(t: SampleTables) -> DataFrame:
    return scores.daily_trend(t.dq_results)


@query
def dq_score_by_table(t: SampleTables) -> DataFrame:
    return scores.fn_score(t.dq_results, "i")


@query
def dq_trend_window(t: SampleTables) -> DataFrame:
    return scores.fn_trend(t.dq_results, "i", 60, ORDERS_AS_OF)


@query
def dq_table_score(t: SampleTables) -> DataFrame:
    wanted = t.base("documents").selectExpr("'cat.sch.' || lang AS table_name").distinct()
    known = t.dq_results.select("table_name").distinct()
    return scores.table_scores(t.dq_results, wanted.unionByName(known))


@query
def dq_scorecard(t: SampleTables) -> DataFrame:
    return scores.scorecard(t.dq_results)


@query
def dq_scorecard_warnings(t: SampleTables) -> DataFrame:
    per_rule = t.dq_results.withColumn("table_name", F.concat_ws(".", "table_name", "run_id"))
    return scores.scorecard(per_rule, "WARN").select("table_name", "score", "status")


@query
def top_error_tables(t: SampleTables) -> DataFrame:
    return scores.top_tables(t.dq_results, 5)


def _results_view(t: SampleTables) -> str:
    t.dq_results.createOrReplaceTempView("tagquality_dq_results")
    return "tagquality_dq_results"


@query
def fn_dq_score_by_table(t: SampleTables) -> DataFrame:
    table_functions.register_score_function(t.spark, _results_view(t))
    return t.spark.sql(
        "SELECT * EXCEPT (scan_date), CAST(scan_date AS DATE) AS scan_date "
        "FROM fn_dq_score_by_table('i')"
    )


@query
def fn_dq_trend(t: SampleTables) -> DataFrame:
    table_functions.register_trend_function(t.spark, _results_view(t))
    return t.spark.sql(f"SELECT * FROM fn_dq_trend('i', 60, TIMESTAMP '{ORDERS_AS_OF}')")


# --- tags and enrolment -----------------------------------------------------------------


@query
def set_tags(t: SampleTables) -> DataFrame:
    return tags.set_tags(t.schema_tags, t.new_tags)


@query
def tagged_schemas(t: SampleTables) -> DataFrame:
    return tags.tagged_schemas(t.schema_tags)


@query
def tagged_schemas_audit(t: SampleTables) -> DataFrame:
    return tags.tagged_schemas(t.schema_tags, audit=True)


@query
def tag_listing(t: SampleTables) -> DataFrame:
    return tags.list_tags(t.schema_tags, "SALES_EU")


@query
def tag_value_listing(t: SampleTables) -> DataFrame:
    return tags.list_tag_values(t.schema_tags)


@query
def owner_inventory(t: SampleTables) -> DataFrame:
    return tags.owner_inventory(t.schema_tags, "askid")


@query
def bulk_enrol(t: SampleTables) -> DataFrame:
    _, report = tags.enrol(t.schema_tags, t.schemata, t.monitors, as_of=EVENTS_AS_OF)
    return report


@query
def monitors_after_enrol(t: SampleTables) -> DataFrame:
    monitors, _ = tags.enrol(t.schema_tags, t.schemata, t.monitors, as_of=EVENTS_AS_OF)
    return monitors.withColumn("enabled_at", F.to_date("enabled_at"))


@query
def monitors_after_reset(t: SampleTables) -> DataFrame:
    catalog = t.schemata.where("schema_name = 'SCHEMA_1'").select("catalog_name").first()[0]
    again = tags.enrol_schema(t.schemata, t.monitors, catalog, "SCHEMA_1", EVENTS_AS_OF)
    return again.withColumn("enabled_at", F.to_date("enabled_at"))


@query
def exclude_tagged_tables(t: SampleTables) -> DataFrame:
    bindings = rules.discover_bindings(t.column_tags, t.rule_mapping)
    kept, excluded = tags.split_excluded(bindings, t.table_tags)
    return kept.withColumn("scanned", F.lit(True)).unionByName(
        excluded.withColumn("scanned", F.lit(False))
    )


@query
def schema_tag_dim(t: SampleTables) -> DataFrame:
    return tags.tag_dim(t.schema_tags, t.schemata, "askid")


@query
def tagged_columns(t: SampleTables) -> DataFrame:
    return tags.tagged_columns(t.column_tags, "dq_type", "SCHEMA_1")


# --- table health -----------------------------------------------------------------------


def _project_dim(t: SampleTables) -> DataFrame:
    return tags.tag_dim(t.schema_tags, t.schemata, "askid")


def _tenant_dim(t: SampleTables) -> DataFrame:
    return tags.tag_dim(t.schema_tags, t.schemata, "tenant")


@query
def freshness_check(t: SampleTables) -> DataFrame:
    checked = monitor.freshness(t.commits, EVENTS_AS_OF)
    return checked.select(
        "table_id",
        "last_commit",
        "num_gaps",
        F.round("median_gap_sec", 3).alias("median_gap_sec"),
        F.round("mad_gap_sec", 3).alias("mad_gap_sec"),
        F.date_trunc("MILLISECOND", "predicted_commit").cast("timestamp_ntz").alias("predicted_commit"),
        "freshness_status",
    )


@query
def completeness_check(t: SampleTables) -> DataFrame:
    rows = t.base("events")
    checked = monitor.completeness(rows, ["event_type"], "ts", VOLUME_AS_OF, known=rows)
    return checked.select(
        "event_type",
        "actual_rows",
        "baseline_days",
        F.round("expected_rows", 4).alias("expected_rows"),
        F.round("mad_rows", 4).alias("mad_rows"),
        F.round("min_predicted_rows", 4).alias("min_predicted_rows"),
        "completeness_status",
    )


@query
def percent_null_check(t: SampleTables) -> DataFrame:
    # A late outbreak of nulls in one column, a steady share in another.
    rows = t.base("events").withColumns(
        {
            "event_type": F.expr("nullif(event_type, 'signup')"),
            "value": F.expr("if(ts >= TIMESTAMP_NTZ '2024-01-30' AND value > 20, NULL, value)"),
        }
    )
    checked = monitor.percent_null(rows, ["event_type", "value", "props"], "ts", EVENTS_AS_OF)
    return checked.select(
        "column_name",
        "baseline_days",
        "null_status",
        *[F.round(c, 4).alias(c) for c in ("null_pct", "avg_null_pct", "max_predicted_pct")],
    )


@query
def table_results(t: SampleTables) -> DataFrame:
    rows = t.base("events").withColumn("table_id", F.col("user_id").cast("string"))
    known = rows.where(F.col("ts") <= F.lit(VOLUME_AS_OF).cast("timestamp_ntz"))
    # Both are read twice below.
    volume = cut(monitor.completeness(rows, ["table_id"], "ts", VOLUME_AS_OF, known=known))
    fresh = cut(monitor.freshness(t.commits, EVENTS_AS_OF))
    impact = monitor.downstream_impact(t.tables, t.lineage, t.query_history)
    unhealthy = monitor.unhealthy_tables(fresh, volume)
    records = monitor.assemble_results(
        fresh,
        volume,
        t.tables.select("table_id", "catalog_name", "schema_name", "table_name"),
        t.schemata,
        impact,
        EVENTS_AS_OF,
        monitor.table_totals(t.commits, EVENTS_AS_OF),
        monitor.root_causes(unhealthy, t.lineage, t.writes, t.job_run_timeline, EVENTS_AS_OF),
    )
    return records.select(
        F.to_date("event_time").alias("event_day"),
        "catalog_name",
        "schema_name",
        "table_name",
        "schema_id",
        "table_id",
        "status",
        F.col("freshness.status").alias("freshness_status"),
        F.col("freshness.commit_freshness.last_value").cast("timestamp_ntz").alias("last_commit"),
        F.col("completeness.status").alias("completeness_status"),
        F.col("completeness.daily_row_count.last_value").alias("actual_rows"),
        F.col("completeness.daily_row_count.min_predicted_value").alias("min_expected_rows"),
        F.col("completeness.total_row_count.status").alias("total_status"),
        F.col("completeness.total_row_count.error_code").alias("total_error"),
        F.col("completeness.total_row_count.last_value").alias("total_rows"),
        F.col("completeness.total_row_count.min_predicted_value").alias("min_total_rows"),
        "downstream_impact.*",
        F.array_join("root_cause_analysis.upstream_jobs", ",").alias("upstream_jobs"),
    )


@query
def health_recent(t: SampleTables) -> DataFrame:
    return health.recent_results(t.table_results, 50)


@query
def health_anomalies(t: SampleTables) -> DataFrame:
    return health.anomalies(t.table_results)


@query
def anomaly_preview(t: SampleTables) -> DataFrame:
    return health.anomaly_preview(t.table_results)


@query
def last_scan_per_schema(t: SampleTables) -> DataFrame:
    return health.last_scans(t.table_results)


@query
def scan_coverage(t: SampleTables) -> DataFrame:
    return health.coverage(t.schemata, t.table_results)


@query
def tag_vs_scan(t: SampleTables) -> DataFrame:
    return health.tag_vs_scan(t.schema_tags, t.table_results)


@query
def health_by_project(t: SampleTables) -> DataFrame:
    return health.health_by_tag(t.table_results, _project_dim(t))


@query
def health_summary(t: SampleTables) -> DataFrame:
    return health.health_summary(t.table_results, _project_dim(t), tie_breakers=["event_id"])


@query
def health_trend(t: SampleTables) -> DataFrame:
    return health.health_trend(t.table_results)


# --- events -----------------------------------------------------------------------------

_PAYLOAD_TYPES = {
    "event_time": "timestamp_ntz",
    "freshness_last_commit": "timestamp_ntz",
    "freshness_predicted_commit": "timestamp_ntz",
    "last_commit": "timestamp_ntz",
    "completeness_actual_rows": "bigint",
    "completeness_min_expected": "bigint",
    "actual_rows": "bigint",
    "min_expected_rows": "bigint",
    "downstream_tables": "bigint",
    "queries_affected": "bigint",
}


def _parsed(sent: DataFrame, kind: str) -> DataFrame:
    """Events read back from their JSON."""
    ddl = ", ".join(f"{n} {_PAYLOAD_TYPES.get(n, 'string')}" for n in events.PAYLOADS[kind])
    value = F.from_json("value", T.StructType.fromDDL(ddl)).alias("value")
    return sent.select(F.col("key").alias("event_key"), value).select("event_key", "value.*")


@query
def event_payload(t: SampleTables) -> DataFrame:
    return _parsed(events.to_events(t.table_results, "full"), "full")


@query
def event_payload_brief(t: SampleTables) -> DataFrame:
    return _parsed(events.to_events(t.table_results, "brief"), "brief")


@query
def event_anomalies_only(t: SampleTables) -> DataFrame:
    return _parsed(events.anomaly_events(t.table_results), "anomaly")


@query
def event_stream(t: SampleTables) -> DataFrame:
    """The events file as a stream, through to a parquet sink, read back."""
    root = f"{shared_folder(t.spark)}/event_stream/{uuid.uuid4()}"

    class Streamed(SampleTables):
        def base(self, name: str) -> DataFrame:
            table = super().base(name)
            if name != "events":
                return table
            # A pattern, since the source takes a plain path for a directory.
            path = f"{self.sf_dir}/events.parque[t]"
            return events.read_results_stream(self.spark, path, table.schema)

    stream = events.anomaly_events(Streamed(t.spark, t.sf_dir).table_results)
    events.write_events(
        stream,
        f"anomalies_{uuid.uuid4().hex}",
        options={"path": f"{root}/out"},
        checkpoint=f"{root}/checkpoint",
        available_now=True,
    ).awaitTermination()
    return _parsed(t.spark.read.parquet(f"{root}/out"), "anomaly")


# --- chargeback through schema tags -----------------------------------------------------


@query
def usage_detail(t: SampleTables) -> DataFrame:
    return chargeback.usage_detail(t.usage, n=50)


@query
def chargeback_units(t: SampleTables) -> DataFrame:
    return chargeback.chargeback_units(t.usage, _tenant_dim(t))


@query
def price_usage(t: SampleTables) -> DataFrame:
    priced = chargeback.price_usage(t.usage, t.list_prices)
    return priced.groupBy("sku_name", "unit_price").agg(
        F.count(F.lit(1)).alias("usage_rows"),
        F.sum("usage_quantity").alias("total_units"),
        F.round(F.sum("cost_usd"), 2).alias("total_cost"),
        F.min("usage_start_time").alias("first_start"),
        F.max("usage_start_time").alias("last_start"),
    )


@query
def price_usage_daily(t: SampleTables) -> DataFrame:
    """Usage against prices that change every day: thousands of periods of a SKU."""
    priced = chargeback.price_usage(t.usage, t.daily_prices)
    return priced.groupBy("sku_name").agg(
        F.count(F.lit(1)).alias("usage_rows"), F.round(F.sum("cost_usd"), 2).alias("total_cost")
    )


@query
def chargeback_cost(t: SampleTables) -> DataFrame:
    return chargeback.chargeback_cost(t.usage, _tenant_dim(t), t.list_prices)


@query
def chargeback_by_table(t: SampleTables) -> DataFrame:
    return chargeback.chargeback_by_table(t.usage, _tenant_dim(t), t.tables)


@query
def chargeback_project(t: SampleTables) -> DataFrame:
    return chargeback.chargeback_cost(t.usage, _project_dim(t), t.list_prices, owner="askid")


# --- query history ----------------------------------------------------------------------


@query
def query_usage_by_project(t: SampleTables) -> DataFrame:
    return query_usage.query_usage(
        t.query_history, _project_dim(t), ORDERS_AS_OF, days=3000, match="like"
    )


@query
def query_usage_exact(t: SampleTables) -> DataFrame:
    return query_usage.query_usage(
        t.query_history, _project_dim(t), ORDERS_AS_OF, days=3000, match="identifier"
    )


@query
def full_chargeback(t: SampleTables) -> DataFrame:
    # The sample tables end years apart; the period spans them all.
    report = query_usage.full_report(
        _project_dim(t),
        t.usage,
        t.table_results,
        t.query_history,
        EVENTS_AS_OF,
        days=12000,
        match="like",
    )
    return report.withColumn("schemas", F.array_join("schemas", ","))


# --- chargeback through usage tags ------------------------------------------------------


@query
def tagged_usage_detail(t: SampleTables) -> DataFrame:
    return chargeback.tagged_usage(t.usage, n=50)


@query
def billing_units(t: SampleTables) -> DataFrame:
    return chargeback.billing_units(t.usage)


@query
def billing_units_promoted(t: SampleTables) -> DataFrame:
    """The same report over usage stored with its tags as columns."""
    path = f"{shared_folder(t.spark)}/usage/{uuid.uuid4()}"
    write_promoted(t.usage, path, ["cost_center", "billing_code", "requesting_team"])
    return chargeback.billing_units(t.spark.read.parquet(path))


@query
def billing_cost(t: SampleTables) -> DataFrame:
    return chargeback.billing_cost(t.usage, t.list_prices)


@query
def billing_run_detail(t: SampleTables) -> DataFrame:
    return chargeback.run_detail(t.usage, n=100)


@query
def run_timeline_cost(t: SampleTables) -> DataFrame:
    return chargeback.run_cost(t.job_run_timeline, t.usage, n=50)


@query
def billing_summary_all(t: SampleTables) -> DataFrame:
    return chargeback.billing_summary(t.usage)


@query
def fn_chargeback(t: SampleTables) -> DataFrame:
    return chargeback.fn_chargeback(t.usage, "ORCHID-11", 24, USAGE_AS_OF)


@query
def fn_dq_chargeback(t: SampleTables) -> DataFrame:
    t.usage.createOrReplaceTempView("tagquality_usage")
    table_functions.register_chargeback_function(t.spark, "tagquality_usage")
    return t.spark.sql(f"SELECT * FROM fn_dq_chargeback(NULL, 24, DATE '{USAGE_AS_OF[:10]}')")


@query
def resolve_custom_tags(t: SampleTables) -> DataFrame:
    resolved = chargeback.resolve_tags(
        t.usage, t.policies, t.jobs
    )
    return (
        resolved.select("is_serverless", "usage_quantity", F.explode("custom_tags").alias("k", "v"))
        .groupBy("is_serverless", "k", "v")
        .agg(F.count(F.lit(1)).alias("usage_rows"), F.sum("usage_quantity").alias("units"))
    )


# --- registry ---------------------------------------------------------------------------


@query
def registry_merge(t: SampleTables) -> DataFrame:
    newcomers = (
        t.base("orders")
        .selectExpr("'BC-' || (o_custkey * 2) AS billing_code", "'Newcomer' AS client_name")
        .distinct()
    )
    merged = registry.register_clients(t.registry, newcomers, EVENTS_AS_OF)
    return merged.withColumn("created_at", F.to_date("created_at"))


@query
def request_validation(t: SampleTables) -> DataFrame:
    return registry.validate_requests(t.requests, t.registry)


@query
def dispatch_scans(t: SampleTables) -> DataFrame:
    bindings = rules.discover_bindings(t.column_tags, t.rule_mapping)
    return registry.dispatch_summary(t.requests, t.registry, bindings).drop("catalog_name")


@query
def rejected_requests(t: SampleTables) -> DataFrame:
    return registry.rejected(t.requests, t.registry)


def _audit(t: SampleTables) -> DataFrame:
    validated = registry.validate_requests(t.requests, t.registry)
    return registry.audit_rows(validated, EVENTS_AS_OF).withColumn(
        "request_time", F.to_date("request_time")
    )


def _logged(t: SampleTables) -> DataFrame:
    """The audit log after the same entries have been appended twice, as after a restart."""
    path = f"{shared_folder(t.spark)}/audit/{uuid.uuid4()}"
    for _ in range(2):
        registry.append_audit(_audit(t), path)
    log = registry.read_log(t.spark, path, SCAN_AUDIT_LOG)
    return log.withColumn("request_time", F.to_date("request_time"))


@query
def audit_append(t: SampleTables) -> DataFrame:
    return _logged(t)


@query
def audit_view(t: SampleTables) -> DataFrame:
    log = _logged(t)
    ended = log.where("status = 'SUBMITTED' AND CAST(request_id AS BIGINT) % 3 < 2")
    state = F.when(F.col("request_id").cast("bigint") % 3 == 0, "COMPLETED").otherwise("FAILED")
    view = registry.audit_log(log, registry.audit_states(ended, state, EVENTS_AS_OF))
    return view.select("request_id", "client_name", "request_time", "status")


@query
def request_stream(t: SampleTables) -> DataFrame:
    """Requests as a stream of several micro-batches into the audit log."""
    root = f"{shared_folder(t.spark)}/request_stream/{uuid.uuid4()}"
    files = max(3, -(-t.requests.count() // REQUESTS_PER_FILE))
    t.requests.repartition(files, "request_id").write.parquet(f"{root}/requests")
    log = requests.RequestLog(f"{root}/log")
    stream = requests.read_requests_stream(t.spark, f"{root}/requests", max_files=-(-2 * files // 3))
    requests.process_requests(
        stream, f"requests_{uuid.uuid4().hex}", log, lambda: t.registry, as_of=EVENTS_AS_OF, available_now=True
    ).awaitTermination()
    return log.audit(t.spark).withColumn("request_time", F.to_date("request_time"))


# --- profiling --------------------------------------------------------------------------

_COUNTED = ("customer", "orders", "lineitem", "part", "supplier", "events", "documents")


@query
def table_counts(t: SampleTables) -> DataFrame:
    return profile.row_counts({name: t.base(name) for name in _COUNTED})


@query
def null_profile(t: SampleTables) -> DataFrame:
    return profile.null_profile(t.contacts)


@query
def value_counts(t: SampleTables) -> DataFrame:
    return profile.value_counts(t.contacts, "segment")
