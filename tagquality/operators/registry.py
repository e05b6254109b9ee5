"""Client registry, scan requests, dispatch and audit log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagquality.constants import SCANNING_COST_CENTER
from tagquality.operators.scan import ResolveTable, scan_bindings
from tagquality.plans.calendar import AsOf, as_of_ts
from tagquality.plans.joins import lookup_join
from tagquality.schemas import SCAN_AUDIT_LOG

UNKNOWN_CODE = "Unknown or inactive billing code"
NOT_ALLOWED = "Schema not allowed for this client"


def merge_new(
    target: DataFrame, source: DataFrame, key: str, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Target plus the source rows whose key it lacks; existing rows stay as they are.

    A column the source lacks, or leaves null, takes its default. A null key is an error.
    """
    defaults = dict(defaults or {})
    no_key = F.raise_error(F.lit(f"{key} must not be null")).cast(target.schema[key].dataType)

    def filled(name: str) -> Column:
        if name == key:
            return F.coalesce(F.col(key), no_key)
        given = F.col(name) if name in source.columns else F.lit(None)
        value = F.coalesce(given, defaults[name]) if name in defaults else given
        return value.cast(target.schema[name].dataType)

    rows = source.select(*[filled(c).alias(c) for c in target.columns])
    return target.unionByName(rows.join(target.select(key), key, "left_anti"))


def register_clients(registry: DataFrame, clients: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Insert-only registration: new codes are active from `as_of` on unless they say otherwise."""
    return merge_new(
        registry,
        clients,
        "billing_code",
        {"is_active": F.lit(True), "created_at": as_of_ts(as_of)},
    )


def _names(schemas: str | Column) -> Column:
    """The trimmed, non-empty, distinct names in a comma list."""
    names = F.transform(F.split(schemas, ","), lambda n: F.trim(n))
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def validate_requests(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Requests with their client, target schemas and verdict; works on a stream of requests too.

    A request without an id gets one. It is made anew whenever the result is computed: store
    the result, or name the requests before, if it is used more than once.
    """
    clients = registry.where(F.col("is_active")).select(
        "billing_code", "client_name", "schemas_allowed", F.lit(True).alias("_registered")
    )
    requests = requests.withColumn("request_id", F.coalesce("request_id", F.expr("uuid()")))
    valid = F.coalesce("_registered", F.lit(False))
    asked = F.nullif(F.col("schemas"), F.lit(""))
    return lookup_join(requests, clients, ["billing_code"], "left").select(
        "request_id",
        "billing_code",
        "client_name",
        F.when(valid, F.coalesce(asked, "schemas_allowed")).alias("target_schemas"),
        "schemas_allowed",
        "requested_by",
        valid.alias("is_valid"),
        F.when(~valid, F.lit(UNKNOWN_CODE)).alias("reason"),
    )


def requested_schemas(validated: DataFrame) -> DataFrame:
    """One row per (valid request, schema), and whether the client may scan it."""
    return (
        validated.where("is_valid")
        .withColumn("schema_full_name", F.explode(_names("target_schemas")))
        .withColumn(
            "is_allowed",
            F.coalesce(
                F.array_contains(_names("schemas_allowed"), F.col("schema_full_name")), F.lit(False)
            ),
        )
        .drop("schemas_allowed", "is_valid", "reason", "target_schemas")
    )


def rejected(requests: DataFrame, registry: DataFrame, enforce_allowed: bool = True) -> DataFrame:
    """Requests, or single schemas of a request, that will not be scanned, with the reason."""
    validated = validate_requests(requests, registry)
    columns = ["request_id", "billing_code", "schema_full_name", "reason"]
    refused = validated.where(~F.col("is_valid")).select(
        "request_id", "billing_code", F.lit(None).cast("string").alias("schema_full_name"), "reason"
    )
    if not enforce_allowed:
        return refused
    outside = requested_schemas(validated).where(~F.col("is_allowed"))
    return refused.unionByName(outside.withColumn("reason", F.lit(NOT_ALLOWED)).select(*columns))


def dispatch(
    requests: DataFrame, registry: DataFrame, bindings: DataFrame, enforce_allowed: bool = True
) -> DataFrame:
    """The bindings each accepted request has to scan, with the tags of the request."""
    wanted = requested_schemas(validate_requests(requests, registry))
    if enforce_allowed:
        wanted = wanted.where("is_allowed")
    schema_name = F.concat("catalog_name", F.lit("."), "schema_name")
    named = bindings.withColumn("schema_full_name", schema_name)
    return lookup_join(wanted.drop("is_allowed"), named, ["schema_full_name"]).select(
        "request_id",
        "billing_code",
        F.col("client_name").alias("requesting_team"),
        F.lit(SCANNING_COST_CENTER).alias("cost_center"),
        F.lit("ad-hoc").alias("scan_type"),
        "requested_by",
        *bindings.columns,
    )


def dispatch_summary(
    requests: DataFrame, registry: DataFrame, bindings: DataFrame, enforce_allowed: bool = True
) -> DataFrame:
    """How many requests and (request, binding) pairs each client has per schema and rule.

    Requests are counted per client and schema, and bindings per schema and rule, before they meet;
    `dispatch` lists the pairs.
    """
    wanted = requested_schemas(validate_requests(requests, registry))
    if enforce_allowed:
        wanted = wanted.where("is_allowed")
    asked = wanted.groupBy("billing_code", "client_name", "schema_full_name").agg(
        F.countDistinct("request_id").alias("requests"), F.count(F.lit(1)).alias("_asked")
    )
    place = F.concat("catalog_name", F.lit("."), "schema_name").alias("schema_full_name")
    offered = bindings.groupBy(place, "catalog_name", "schema_name", "rule_name").agg(F.count(F.lit(1)).alias("_offered"))
    return lookup_join(asked, offered, ["schema_full_name"]).select(
        "billing_code",
        F.col("client_name").alias("requesting_team"),
        "catalog_name",
        "schema_name",
        "rule_name",
        "requests",
        (F.col("_asked") * F.col("_offered")).alias("bindings"),
        F.lit(SCANNING_COST_CENTER).alias("cost_center"),
        F.lit("ad-hoc").alias("scan_type"),
    )


def run_requests(
    requests: DataFrame,
    registry: DataFrame,
    bindings: DataFrame,
    resolve_table: ResolveTable,
    as_of: AsOf = None,
    enforce_allowed: bool = True,
) -> DataFrame | None:
    """Scan results per request; None if nothing is to be scanned.

    A table that several requests ask for is scanned once; the run id is the request id.
    """
    wanted = requested_schemas(validate_requests(requests, registry))
    if enforce_allowed:
        wanted = wanted.where("is_allowed")
    place = F.concat("catalog_name", F.lit("."), "schema_name").alias("schema_full_name")
    named = bindings.select(place, *bindings.columns)
    # The requests meet the few result rows of their schemas, not the bindings.
    scanned = lookup_join(named, wanted.select("schema_full_name").distinct(), ["schema_full_name"], "left_semi")
    parts = list(scan_bindings(scanned.select(*bindings.columns).distinct(), resolve_table, "", as_of))
    if not parts:
        return None
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    full_name = F.concat_ws(".", "catalog_name", "schema_name", "table_name").alias("table_name")
    places = scanned.select(full_name, "schema_full_name").distinct()
    asked = wanted.select(
        "schema_full_name",
        F.col("request_id").alias("run_id"),
        "billing_code",
        F.col("client_name").alias("requesting_team"),
        F.lit(SCANNING_COST_CENTER).alias("cost_center"),
        F.lit("ad-hoc").alias("scan_type"),
    ).distinct()
    placed = results.drop("run_id").join(places, "table_name")
    return placed.join(asked, "schema_full_name").drop("schema_full_name")


def audit_rows(validated: DataFrame, as_of: AsOf = None, enforce_allowed: bool = True) -> DataFrame:
    """Audit entry of each valid request, to be appended to the log.

    It names the schemas that are scanned, so not those the client may not scan; a request
    with nothing left to scan is logged as rejected.
    """
    scanned = F.coalesce(_names("target_schemas"), F.array().cast("array<string>"))
    if enforce_allowed:
        allowed = F.coalesce(_names("schemas_allowed"), F.array().cast("array<string>"))
        scanned = F.array_intersect(scanned, allowed)
    return validated.where("is_valid").select(
        "request_id",
        "billing_code",
        "client_name",
        F.nullif(F.array_join(scanned, ","), F.lit("")).alias("schemas_scanned"),
        F.concat(F.lit("scan-"), "billing_code", F.lit("-"), "request_id").alias("job_run_id"),
        "requested_by",
        as_of_ts(as_of).alias("request_time"),
        F.when(F.size(scanned) > 0, "SUBMITTED").otherwise("REJECTED").alias("status"),
    )


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A log below `path`; empty where nothing has been appended yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_audit(rows: DataFrame, path: str) -> None:
    """Append the entries of requests that the log does not have yet, one for each; to append twice is harmless."""
    spark = rows.sparkSession
    known = read_log(spark, path, SCAN_AUDIT_LOG).select("request_id")
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCAN_AUDIT_LOG.fields])
    # Shuffled before they are sorted: a task sorts its share of the requests, not a whole input file.
    typed.repartition("request_id").dropDuplicates(["request_id"]).join(known, "request_id", "left_anti").select(
        *SCAN_AUDIT_LOG.fieldNames()
    ).write.mode("append").parquet(path)


def audit_states(done: DataFrame, state: str | Column, as_of: AsOf = None) -> DataFrame:
    """Rows for the log of states: what became of the requests in `done`."""
    state = F.lit(state) if isinstance(state, str) else state
    return done.select("request_id", state.alias("status"), as_of_ts(as_of).alias("state_time"))


def audit_log(log: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """The whole audit log, newest first and then by request, each request with its newest state.

    Many requests have one time; by that alone all of them would be sorted in one task.
    """
    if states is not None:
        newest = F.max_by("status", F.struct("state_time", "status"))
        latest = states.groupBy("request_id").agg(newest.alias("_state"))
        log = log.join(latest, "request_id", "left")
        log = log.withColumn("status", F.coalesce("_state", "status")).drop("_state")
    return log.orderBy(F.desc("request_time"), "request_id")
