"""Usage and cost charged back to owners: through schema tags, or through tags on the usage.

Usage is the large table. It is summed by its own keys (schema, table, run, month)
before it meets a dimension, so a hot schema or run shrinks on the map side and
only sums are shuffled. The price list is the one lookup joined row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagquality.constants import MONITORING_PRODUCT, OPEN_END, SCANNING_COST_CENTER, TENANT_TAG
from tagquality.plans.calendar import AsOf, as_of_date, month_of
from tagquality.plans.joins import lookup_join

SCHEMA_ID = "usage_metadata.schema_id"


def _top(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """The first `n` rows, or all, in an order made total by the other columns."""
    rows = df.orderBy(*order, *df.columns)
    return rows if n is None else rows.limit(n)


def _units(column: str = "usage_quantity") -> Column:
    return F.sum(column)


# Periods of a SKU up to which a usage row is compared with all of them.
FEW_PERIODS = 16


def _at(moment: str | Column) -> Column:
    return F.unix_micros((F.col(moment) if isinstance(moment, str) else moment).cast("timestamp"))


def price_grid(periods: DataFrame) -> DataFrame:
    """(sku_name, _first, _width, _bins): time of each SKU cut into as many bins as it has periods.

    Bins are even between its first and its last start; the last one has no end.
    """
    grid = periods.groupBy("sku_name").agg(
        F.min(_at("_from")).alias("_first"), F.max(_at("_from")).alias("_last"), F.count(F.lit(1)).alias("_bins")
    )
    width = F.greatest(F.lit(1), F.ceil((F.col("_last") - F.col("_first")) / F.col("_bins")))
    return grid.select("sku_name", "_first", width.alias("_width"), "_bins")


def _bin(at: Column) -> Column:
    place = F.floor((at - F.col("_first")) / F.col("_width"))
    return F.greatest(F.lit(0), F.least(F.col("_bins"), place))


def binned_periods(periods: DataFrame, grid: DataFrame) -> DataFrame:
    """A row for each period and bin that it touches: about two per period where none overlap."""
    last = _bin(_at("_until") - 1)
    cut = periods.where(F.col("_from") < F.col("_until")).join(grid, "sku_name")
    return cut.withColumn("_bin", F.explode(F.sequence(_bin(_at("_from")), last))).drop("_first", "_width", "_bins")


def price_usage(usage: DataFrame, prices: DataFrame, few: int = FEW_PERIODS) -> DataFrame:
    """Usage rows with the list price in force when they started.

    Usage without a price disappears; overlapping price periods repeat it. Where a SKU has more than `few`
    periods, usage meets only the periods that touch its bin of time: an equal-key join.
    """
    periods = prices.select(
        "sku_name",
        F.col("price_start_time").alias("_from"),
        F.coalesce(
            "price_end_time",
            F.lit(OPEN_END).cast(prices.schema["price_end_time"].dataType),
        ).alias("_until"),
        F.col("pricing.effective_list.default").alias("unit_price"),
    )
    started = F.col("usage_start_time")
    most = periods.groupBy("sku_name").count().agg(F.max("count")).first()[0] or 0
    if most <= few:
        met = lookup_join(usage, periods, ["sku_name"])
    else:
        grid = price_grid(periods)
        placed = lookup_join(usage, grid, ["sku_name"]).withColumn("_bin", _bin(_at("usage_start_time")))
        placed = placed.drop("_first", "_width", "_bins")
        met = lookup_join(placed, binned_periods(periods, grid), ["sku_name", "_bin"]).drop("_bin")
    return (
        met.where((started >= F.col("_from")) & (started < F.col("_until")))
        .drop("_from", "_until")
        .withColumn("cost_usd", F.col("usage_quantity") * F.col("unit_price"))
    )


def check_price_overlaps(prices: DataFrame) -> DataFrame:
    """Price periods that start before an earlier one of the same SKU has ended.

    One SKU's periods are few, and the running maximum finds an overlap with any
    earlier period, not only with the one just before.
    """
    end = F.coalesce(
        "price_end_time", F.lit(OPEN_END).cast(prices.schema["price_end_time"].dataType)
    )
    earlier = (
        Window.partitionBy("sku_name")
        .orderBy("price_start_time", end)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        prices.withColumn("covered_until", F.max(end).over(earlier))
        .where(F.col("price_start_time") < F.col("covered_until"))
        .select("sku_name", "price_start_time", "price_end_time", "covered_until")
    )


# --- through schema tags ---------------------------------------------------------------


def product_usage(usage: DataFrame, product: str = MONITORING_PRODUCT) -> DataFrame:
    return usage.where(F.col("billing_origin_product") == product)


def usage_detail(usage: DataFrame, product: str = MONITORING_PRODUCT, n: int | None = None) -> DataFrame:
    """The usage rows of a product, newest first; `n` of them, or all."""
    rows = product_usage(usage, product).select(
        "usage_date",
        "workspace_id",
        "sku_name",
        "usage_quantity",
        F.col(SCHEMA_ID).alias("schema_id"),
        F.col("usage_metadata.table_id").alias("table_id"),
        "billing_origin_product",
    )
    return _top(rows, n, F.desc("usage_date"))


def chargeback_units(
    usage: DataFrame,
    dim: DataFrame,
    product: str = MONITORING_PRODUCT,
    owner: str = TENANT_TAG,
) -> DataFrame:
    """Units and billing events per (owner, schema, month)."""
    per_schema = (
        product_usage(usage, product)
        .where(F.col(SCHEMA_ID).isNotNull())
        .groupBy(F.col(SCHEMA_ID).alias("schema_id"), month_of("usage_date").alias("usage_month"))
        .agg(_units().alias("_units"), F.count(F.lit(1)).alias("_events"))
    )
    return (
        per_schema.join(dim, "schema_id")
        .groupBy(owner, "catalog_name", "schema_name", "usage_month")
        .agg(
            F.round(_units("_units"), 4).alias("total_dbus"),
            F.sum("_events").alias("billing_events"),
        )
        .orderBy(F.desc("usage_month"), F.desc("total_dbus"))
    )


def chargeback_cost(
    usage: DataFrame,
    dim: DataFrame,
    prices: DataFrame,
    product: str = MONITORING_PRODUCT,
    owner: str = TENANT_TAG,
) -> DataFrame:
    """Units and list-price cost per (owner, month); the project report is another `owner`."""
    used = (
        product_usage(usage, product)
        .where(F.col(SCHEMA_ID).isNotNull())
        .select(
            "usage_date",
            "usage_start_time",
            "sku_name",
            "usage_quantity",
            F.col(SCHEMA_ID).alias("schema_id"),
        )
    )
    per_schema = (
        price_usage(used, prices)
        .groupBy("schema_id", month_of("usage_date").alias("usage_month"))
        .agg(_units().alias("_units"), F.sum("cost_usd").alias("_cost"))
    )
    return (
        per_schema.join(dim.select(owner, "schema_id"), "schema_id")
        .groupBy(owner, "usage_month")
        .agg(
            F.round(_units("_units"), 4).alias("total_dbus"),
            F.round(F.sum("_cost"), 2).alias("estimated_cost_usd"),
        )
        .orderBy(F.desc("usage_month"), F.desc("estimated_cost_usd"))
    )


def chargeback_by_table(
    usage: DataFrame,
    dim: DataFrame,
    tables: DataFrame,
    product: str = MONITORING_PRODUCT,
    owner: str = TENANT_TAG,
) -> DataFrame:
    """Units and rows per (owner, table path, month); a table without a name shows its id."""
    per_table = (
        product_usage(usage, product)
        .groupBy(
            F.col(SCHEMA_ID).alias("schema_id"),
            F.col("usage_metadata.table_id").alias("table_id"),
            month_of("usage_date").alias("usage_month"),
        )
        .agg(_units().alias("_units"), F.count(F.lit(1)).alias("_scans"))
    )
    path = F.concat("catalog_name", F.lit("."), "schema_name", F.lit("."), "table_name")
    names = tables.select("table_id", path.alias("_path"))
    # Sums without a schema, or without a table, do not wait in one task for a match.
    owned = lookup_join(per_table, dim.select(owner, "schema_id"), ["schema_id"], "left")
    return (
        lookup_join(owned, names, ["table_id"], "left")
        .groupBy(owner, F.coalesce("_path", "table_id").alias("table_path"), "usage_month")
        .agg(
            F.round(_units("_units"), 4).alias("total_dbus"),
            F.sum("_scans").alias("scan_count"),
        )
        .orderBy(F.desc("total_dbus"))
    )


# --- through tags on the usage rows ----------------------------------------------------


def tag_value(usage: DataFrame, key: str) -> Column:
    """A usage tag: from a column of its own where tags have been promoted, else from the map.

    Only a column lets the scan skip row groups; see `sources.tables.promote_tags`.
    """
    if key in usage.columns:
        return F.col(key)
    return F.col("custom_tags")[key]


def scanning_usage(
    usage: DataFrame, cost_center: str = SCANNING_COST_CENTER, keep_null: bool = False
) -> DataFrame:
    """Usage of one cost center with its tags as columns; without a code only if `keep_null`."""
    tags = {
        f"_{key}": tag_value(usage, key)
        for key in ("billing_code", "requesting_team", "cost_center", "scan_type")
    }
    rows = usage.where(tags["_cost_center"] == cost_center)
    if not keep_null:
        rows = rows.where(tags["_billing_code"].isNotNull())
    return rows.withColumns(tags)


def tagged_usage(
    usage: DataFrame, cost_center: str = SCANNING_COST_CENTER, n: int | None = None
) -> DataFrame:
    """The tagged usage rows, newest first; `n` of them, or all."""
    rows = scanning_usage(usage, cost_center).select(
        "usage_date",
        F.col("_billing_code").alias("billing_code"),
        F.col("_requesting_team").alias("requesting_team"),
        F.col("_cost_center").alias("cost_center"),
        "sku_name",
        "billing_origin_product",
        F.col("usage_quantity").alias("dbus"),
        F.col("usage_metadata.job_id").alias("job_id"),
        F.col("usage_metadata.job_run_id").alias("job_run_id"),
    )
    return _top(rows, n, F.desc("usage_date"))


def billing_units(usage: DataFrame, cost_center: str = SCANNING_COST_CENTER) -> DataFrame:
    """Units, distinct runs and rows per (code, team, month)."""
    return (
        scanning_usage(usage, cost_center)
        .groupBy(
            F.col("_billing_code").alias("billing_code"),
            F.col("_requesting_team").alias("requesting_team"),
            month_of("usage_date").alias("usage_month"),
        )
        .agg(
            F.round(_units(), 4).alias("total_dbus"),
            F.countDistinct("usage_metadata.job_run_id").alias("scan_runs"),
            F.count(F.lit(1)).alias("billing_events"),
        )
        .orderBy(F.desc("usage_month"), F.desc("total_dbus"))
    )


def billing_cost(
    usage: DataFrame, prices: DataFrame, cost_center: str = SCANNING_COST_CENTER
) -> DataFrame:
    """Units and list-price cost per (code, team, month)."""
    used = scanning_usage(usage, cost_center).select(
        F.col("_billing_code").alias("billing_code"),
        F.col("_requesting_team").alias("requesting_team"),
        "usage_date",
        "usage_start_time",
        "sku_name",
        "usage_quantity",
    )
    return (
        price_usage(used, prices)
        .groupBy("billing_code", "requesting_team", month_of("usage_date").alias("usage_month"))
        .agg(
            F.round(_units(), 4).alias("total_dbus"),
            F.round(F.sum("cost_usd"), 2).alias("estimated_cost_usd"),
        )
        .orderBy(F.desc("usage_month"), F.desc("estimated_cost_usd"))
    )


def run_detail(
    usage: DataFrame, cost_center: str = SCANNING_COST_CENTER, n: int | None = None
) -> DataFrame:
    """One line per tagged usage row, newest first; `n` of them, or all."""
    rows = scanning_usage(usage, cost_center).select(
        F.col("_billing_code").alias("billing_code"),
        F.col("_requesting_team").alias("requesting_team"),
        "usage_date",
        F.col("usage_metadata.job_id").alias("job_id"),
        F.col("usage_metadata.job_run_id").alias("run_id"),
        "sku_name",
        F.round("usage_quantity", 6).alias("dbus"),
        F.col("_scan_type").alias("scan_type"),
    )
    return _top(rows, n, F.desc("usage_date"), F.asc("billing_code"))


def run_cost(
    timeline: DataFrame, usage: DataFrame, cost_center: str = SCANNING_COST_CENTER, n: int | None = None
) -> DataFrame:
    """Units per job run with its state and whole minutes, newest first; `n` runs, or all.

    Usage is summed per run first: a run with very many usage rows meets the
    timeline as one row. Several timeline rows of a run repeat its units.
    """
    per_run = (
        scanning_usage(usage, cost_center, keep_null=True)
        .where(F.col("usage_metadata.job_run_id").isNotNull())
        .groupBy(
            F.col("usage_metadata.job_run_id").alias("_run"),
            F.col("_billing_code").alias("billing_code"),
            F.col("_requesting_team").alias("requesting_team"),
        )
        .agg(_units().alias("_units"))
    )
    runs = timeline.select(
        F.col("run_id").cast("string").alias("_run"),
        "run_name",
        "result_state",
        "start_time",
        "end_time",
    )
    key = ["run_name", "result_state", "start_time", "end_time"]
    rows = (
        runs.join(per_run, "_run")
        .groupBy(*key, "billing_code", "requesting_team")
        .agg(F.round(_units("_units"), 4).alias("total_dbus"))
        .withColumn("duration_minutes", F.timestamp_diff("MINUTE", "start_time", "end_time"))
        .select(*key, "duration_minutes", "billing_code", "requesting_team", "total_dbus")
    )
    return _top(rows, n, F.desc("start_time"))


def billing_summary(usage: DataFrame, cost_center: str = SCANNING_COST_CENTER) -> DataFrame:
    """Units per (code, team, month), including usage without a billing code."""
    return (
        scanning_usage(usage, cost_center, keep_null=True)
        .groupBy(
            F.col("_billing_code").alias("billing_code"),
            F.col("_requesting_team").alias("team"),
            month_of("usage_date").alias("month"),
        )
        .agg(F.round(_units(), 4).alias("dbus"))
        .orderBy(F.desc("month"), F.desc("dbus"))
    )


def fn_chargeback(
    usage: DataFrame,
    code: str | None = None,
    months_back: int = 3,
    as_of: AsOf = None,
    cost_center: str = SCANNING_COST_CENTER,
) -> DataFrame:
    """Units and distinct runs per (code, team, month) of the last months; one code or all."""
    since = F.add_months(as_of_date(as_of), -months_back)
    rows = scanning_usage(usage, cost_center).where(F.col("usage_date") >= since)
    if code is not None:
        rows = rows.where(F.col("_billing_code") == code)
    return (
        rows.groupBy(
            F.col("_billing_code").alias("billing_code"),
            F.col("_requesting_team").alias("requesting_team"),
            month_of("usage_date").alias("usage_month"),
        )
        .agg(
            F.round(_units(), 4).cast("double").alias("total_dbus"),
            F.countDistinct("usage_metadata.job_run_id").alias("scan_runs"),
        )
        .orderBy(F.desc("usage_month"), F.desc("total_dbus"))
    )


def resolve_tags(usage: DataFrame, policies: DataFrame, jobs: DataFrame) -> DataFrame:
    """Fill `custom_tags`: serverless rows take their policy's tags, classic rows their job's.

    Usage needs the columns `is_serverless`, `policy_id` and `usage_metadata.job_id`.
    """
    policy_tags = policies.select(
        "policy_id", F.map_from_entries("custom_tags").alias("_policy_tags")
    )
    job_tags = jobs.select(F.col("job_id").alias("_job"), F.col("tags").alias("_job_tags"))
    rows = usage.drop("custom_tags").withColumn("_job", F.col("usage_metadata.job_id"))
    with_policy = lookup_join(rows, policy_tags, ["policy_id"], "left")
    with_both = lookup_join(with_policy, job_tags, ["_job"], "left")
    tags = F.when(F.col("is_serverless"), F.col("_policy_tags")).otherwise(F.col("_job_tags"))
    none = F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    return with_both.withColumn("custom_tags", F.coalesce(tags, none)).drop(
        "_policy_tags", "_job_tags", "_job"
    )
