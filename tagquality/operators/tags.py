"""Schema, table and column tags; enrolment of tagged schemas for monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagquality.constants import EXCLUDE_TAG, EXCLUDE_VALUE, MONITOR_TAG, MONITOR_VALUE
from tagquality.plans.calendar import AsOf, as_of_ts
from tagquality.plans.joins import lookup_join

SCHEMA_KEY = ["catalog_name", "schema_name"]
TABLE_KEY = [*SCHEMA_KEY, "table_name"]


def set_tags(
    schema_tags: DataFrame, new_tags: DataFrame, applied_order: str | None = None
) -> DataFrame:
    """The tag table after an upsert: a new value replaces the old one of the same tag name.

    If `new_tags` may hold a tag twice, `applied_order` names its column that says which is later.
    """
    key = [*SCHEMA_KEY, "tag_name"]
    order = F.struct(*([applied_order] if applied_order else []), "tag_value")
    latest = new_tags.groupBy(*key).agg(F.max_by("tag_value", order).alias("tag_value"))
    kept = schema_tags.select(*key, "tag_value").join(latest.select(*key), key, "left_anti")
    return kept.unionByName(latest)


def tagged_schemas(
    schema_tags: DataFrame, name: str = MONITOR_TAG, value: str = MONITOR_VALUE, audit: bool = False
) -> DataFrame:
    """Distinct schemas with a tag pair; `audit` also shows the pair, sorted."""
    found = schema_tags.where((F.col("tag_name") == name) & (F.col("tag_value") == value))
    if audit:
        columns = [*SCHEMA_KEY, "tag_name", "tag_value"]
        return found.select(*columns).distinct().orderBy(*SCHEMA_KEY)
    return found.select(*SCHEMA_KEY).distinct()


def list_tags(schema_tags: DataFrame, catalog: str) -> DataFrame:
    """Tags of one catalog."""
    return (
        schema_tags.where(F.col("catalog_name") == catalog)
        .select(*SCHEMA_KEY, "tag_name", "tag_value")
        .orderBy("schema_name", "tag_name")
    )


def list_tag_values(
    schema_tags: DataFrame, name: str = MONITOR_TAG, value_as: str = "dqm_tag_value"
) -> DataFrame:
    """Schemas with a tag name, the value under a name of its own."""
    return (
        schema_tags.where(F.col("tag_name") == name)
        .select(*SCHEMA_KEY, F.col("tag_value").alias(value_as))
        .orderBy(*SCHEMA_KEY)
    )


def owner_inventory(schema_tags: DataFrame, name: str) -> DataFrame:
    """Schemas per owner: the tag value as a column with the name of the tag."""
    return (
        schema_tags.where(F.col("tag_name") == name)
        .select(F.col("tag_value").alias(name), *SCHEMA_KEY, "tag_name")
        .orderBy(name, *SCHEMA_KEY)
    )


def tag_dim(
    schema_tags: DataFrame, schemata: DataFrame, name: str, owner: str | None = None
) -> DataFrame:
    """(owner, schema_id, catalog, schema) for one tag name: the dimension of all reports.

    A schema with two values of the tag has two rows.
    """
    owner = owner or name
    owners = schema_tags.where(F.col("tag_name") == name).select(
        *SCHEMA_KEY, F.col("tag_value").alias(owner)
    )
    return schemata.join(owners, SCHEMA_KEY).select(owner, "schema_id", *SCHEMA_KEY)


def tagged_columns(
    column_tags: DataFrame, name: str, schema: str, catalog: str | None = None
) -> DataFrame:
    """Columns of a schema that carry a tag name, whatever the value."""
    found = (F.col("tag_name") == name) & (F.col("schema_name") == schema)
    if catalog is not None:
        found &= F.col("catalog_name") == catalog
    return (
        column_tags.where(found)
        .select(*TABLE_KEY, "column_name", "tag_value")
        .orderBy(*TABLE_KEY, "column_name")
    )


def split_excluded(
    bindings: DataFrame, table_tags: DataFrame, name: str = EXCLUDE_TAG, value: str = EXCLUDE_VALUE
) -> tuple[DataFrame, DataFrame]:
    """(bindings to scan, bindings of tables tagged as excluded).

    Each task holds the excluded tables of its part and lets the bindings pass: these are many rows of
    long texts that compress well, so that a part of usual size would take many times that to be sorted.
    """
    excluded = (
        table_tags.where((F.col("tag_name") == name) & (F.col("tag_value") == value))
        .select(*TABLE_KEY)
        .distinct()
        .hint("shuffle_hash")
    )
    return (
        bindings.join(excluded, TABLE_KEY, "left_anti"),
        bindings.join(excluded, TABLE_KEY, "left_semi"),
    )


def enrol(
    schema_tags: DataFrame,
    schemata: DataFrame,
    monitors: DataFrame,
    name: str = MONITOR_TAG,
    value: str = MONITOR_VALUE,
    as_of: AsOf = None,
) -> tuple[DataFrame, DataFrame]:
    """Enrol every tagged schema; returns (monitors afterwards, report).

    The report says ENABLED, ALREADY ENABLED or ERROR for each tagged schema.
    """
    known = schemata.select(*SCHEMA_KEY).distinct().withColumn("_known", F.lit(True))
    enrolled = monitors.select(*SCHEMA_KEY).distinct().withColumn("_enrolled", F.lit(True))
    full_name = F.concat_ws(".", *SCHEMA_KEY)
    problem = F.concat(F.lit("Schema '"), full_name, F.lit("' does not exist."))
    judged = (
        tagged_schemas(schema_tags, name, value)
        .join(known, SCHEMA_KEY, "left")
        .join(enrolled, SCHEMA_KEY, "left")
        .withColumn(
            "status",
            F.when(F.col("_known").isNull(), F.concat(F.lit("ERROR: "), problem))
            .when(F.col("_enrolled"), "ALREADY ENABLED")
            .otherwise("ENABLED"),
        )
    )
    report = judged.select(full_name.alias("schema_full_name"), "status")
    added = judged.where("status = 'ENABLED'").select(
        *SCHEMA_KEY, as_of_ts(as_of).cast(monitors.schema["enabled_at"].dataType).alias("enabled_at")
    )
    return monitors.select(*SCHEMA_KEY, "enabled_at").unionByName(added), report


def enrol_schema(
    schemata: DataFrame, monitors: DataFrame, catalog: str, schema: str, as_of: AsOf = None
) -> DataFrame:
    """Monitors after one schema has been enrolled anew: an existing entry is replaced."""
    this = (F.col("catalog_name") == catalog) & (F.col("schema_name") == schema)
    added = (
        schemata.where(this)
        .select(*SCHEMA_KEY)
        .distinct()
        .withColumn("enabled_at", as_of_ts(as_of).cast(monitors.schema["enabled_at"].dataType))
    )
    kept = monitors.select(*SCHEMA_KEY, "enabled_at").join(added, SCHEMA_KEY, "left_anti")
    return kept.unionByName(added)


def with_owner(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts joined to the tag dimension on `schema_id`, row by row."""
    extra = [c for c in dim.columns if c not in facts.columns or c == "schema_id"]
    return lookup_join(facts, dim.select(*extra), ["schema_id"])
