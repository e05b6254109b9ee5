"""Table health judged from history: freshness, completeness, null share, assembled records.

Freshness and completeness compare the newest observation with the median and the median
deviation of a bounded baseline, taken from the same weekday where there are enough of it, so
that a table that rests on some days is not flagged on them. Null shares are compared with mean and
sample deviation. Time is cut into 24-hour buckets counted back from `as_of`; bucket 0 is the newest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagquality.operators.query_usage import IDENTIFIER_3, dotted_name, identifiers
from tagquality.plans.calendar import AsOf, as_of_ts, days_before, instant
from tagquality.plans.joins import lookup_join
from tagquality.plans.session import cut
from tagquality.schemas import TABLE_RESULTS

DAY_MICROS = 24 * 60 * 60 * 1_000_000
HEALTHY, UNHEALTHY, UNKNOWN = "Healthy", "Unhealthy", "Unknown"
NEWEST_SALTS = 32
# The deviation of a normal distribution is this multiple of its median absolute deviation.
MAD_SCALE = 1.4826
# Observations of the same weekday that are enough for a baseline, and the part of the median that
# an observation may always be off by.
MIN_SAME_WEEKDAY = 3
TOLERANCE = 0.1
# States of a run that did not do its work.
FAILED_STATES = ("FAILED", "ERROR", "TIMEDOUT", "CANCELED", "INTERNAL_ERROR", "UPSTREAM_FAILED")


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def newest_per_key(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """The `n` newest rows per key.

    Rows are counted per key and day first; only the newest days that hold `n` rows are read
    again and sorted. These are cut down inside salted parts before, so that one task never
    sorts all rows of a key that is hot on one day.
    """
    keys = list(keys)
    day = F.to_date(order)
    newer = Window.partitionBy(*keys).orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    days = (
        df.groupBy(*keys, day.alias("_day"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_newer", F.coalesce(F.sum("_rows").over(newer), F.lit(0)))
        .where(F.col("_newer") < n)
        .groupBy(*keys)
        .agg(F.min("_day").alias("_first_day"))
    )
    parts = lookup_join(df, days, keys).where(day >= F.col("_first_day")).drop("_first_day")
    parts = parts.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(NEWEST_SALTS)))
    for partition in ([*keys, "_part"], keys):
        rank = F.row_number().over(Window.partitionBy(*partition).orderBy(F.desc(order)))
        parts = parts.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
    return parts.drop("_part")


def _median(values: Column) -> Column:
    """The median of an array of numbers without nulls; null if it is empty."""
    in_order, n = F.array_sort(values), F.size(values)
    low = F.get(in_order, F.floor((n - 1) / 2).cast("int"))
    high = F.get(in_order, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2.0)


def freshness(
    commits: DataFrame,
    as_of: AsOf = None,
    gaps: int = 30,
    min_gaps: int = 5,
    sigmas: float = 3.0,
) -> DataFrame:
    """Predict each table's next commit from its last gaps; stale once that time has passed.

    Of the last `gaps` gaps those count that began on the weekday of the last commit, or all if they
    are fewer than MIN_SAME_WEEKDAY. The next commit is due after their median and `sigmas` deviations, at
    least TOLERANCE of the median.
    """
    known = commits.where(F.col("commit_time") <= instant(commits, "commit_time", as_of)).select(
        "table_id", "commit_time"
    )
    # At most gaps + 1 entries per table.
    times = newest_per_key(known, ["table_id"], "commit_time", gaps + 1).groupBy("table_id").agg(
        F.max("commit_time").alias("last_commit"),
        F.sort_array(
            F.collect_list(F.struct(_micros(F.col("commit_time")).alias("at"), F.weekday("commit_time").alias("weekday")))
        ).alias("_times"),
    )

    def gap(i: Column) -> Column:
        before, after = F.get("_times", i), F.get("_times", i + 1)
        return F.struct(((after["at"] - before["at"]) / F.lit(1e6)).alias("sec"), before["weekday"].alias("weekday"))

    count = F.size("_times") - 1
    all_gaps = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), gap))
    rows = times.select(
        "table_id", "last_commit", count.cast("long").alias("num_gaps"),
        F.coalesce(all_gaps, F.array().cast("array<struct<sec: double, weekday: int>>")).alias("_gaps"),
    )
    same = F.filter("_gaps", lambda g: g["weekday"] == F.weekday("last_commit"))
    chosen = F.when(F.size(same) >= MIN_SAME_WEEKDAY, same).otherwise(F.col("_gaps"))
    rows = rows.withColumn("_chosen", F.transform(chosen, lambda g: g["sec"]))
    rows = rows.withColumn("median_gap_sec", _median(F.col("_chosen")))
    off = F.transform("_chosen", lambda x: F.abs(x - F.col("median_gap_sec")))
    rows = rows.withColumn("mad_gap_sec", _median(off))
    spread = F.greatest(sigmas * MAD_SCALE * F.col("mad_gap_sec"), TOLERANCE * F.col("median_gap_sec"))
    allowance = F.round((F.col("median_gap_sec") + spread) * 1e6).cast("long")
    predicted = F.timestamp_micros(_micros(F.col("last_commit")) + allowance)
    return (
        rows.withColumn("predicted_commit", F.when(F.col("num_gaps") >= min_gaps, predicted))
        .withColumn(
            "freshness_status",
            F.when(F.col("predicted_commit").isNull(), UNKNOWN)
            .when(as_of_ts(as_of) > F.col("predicted_commit"), UNHEALTHY)
            .otherwise(HEALTHY),
        )
        .drop("_gaps", "_chosen")
    )


def _recent_buckets(df: DataFrame, ts_col: str, as_of: AsOf, buckets: int) -> DataFrame:
    """Rows of the newest `buckets` buckets, with their bucket number."""
    end = instant(df, ts_col, as_of)
    age = _micros(as_of_ts(as_of)) - _micros(F.col(ts_col))
    recent = (F.col(ts_col) <= end) & (F.col(ts_col) > days_before(end, buckets))
    return df.where(recent).withColumn("_bucket", F.floor(age / F.lit(DAY_MICROS)).cast("int"))


def completeness(
    rows: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    as_of: AsOf = None,
    baseline: int = 28,
    min_baseline: int = 7,
    sigmas: float = 3.0,
    known: DataFrame | None = None,
) -> DataFrame:
    """Expected row volume of the newest day per table; unhealthy below the predicted minimum.

    Expected is the median of the days of the same weekday, and the deviation is that of all days from
    the medians of their weekdays; with fewer than MIN_SAME_WEEKDAY of the same weekday, both are of
    all days. The minimum is `sigmas` deviations below, at least TOLERANCE of what is expected.

    Buckets without rows count as zero. The baseline of a table starts at its oldest
    bucket with rows among the `baseline` ones. Only that many days are read, so that a
    table without rows in all of them is seen only if `known` has its keys: it is then
    unhealthy, with no rows and no baseline.
    """
    keys = list(keys)
    counts = (
        _recent_buckets(rows, ts_col, as_of, baseline + 1)
        .groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    # At most baseline + 1 entries per table; the empty buckets are filled in from them.
    filled = F.map_from_entries(F.collect_list(F.struct("_bucket", "_rows")))
    stats = counts.groupBy(*keys).agg(filled.alias("_filled"), F.max("_bucket").alias("_oldest"))

    def on_day(day: Column) -> Column:
        return F.coalesce(F.try_element_at("_filled", day), F.lit(0))

    stats = stats.select(
        *keys,
        on_day(F.lit(0)).alias("actual_rows"),
        F.col("_oldest").cast("long").alias("baseline_days"),
        # The counts of each weekday, that of bucket 0 first.
        F.transform(
            F.sequence(F.lit(0), F.lit(6)),
            lambda w: F.transform(
                F.filter(F.sequence(F.lit(0), "_oldest"), lambda d: (d > 0) & (d % 7 == w)), on_day
            ),
        ).alias("_weekdays"),
    )
    same = F.get("_weekdays", F.lit(0))
    enough = F.size(same) >= MIN_SAME_WEEKDAY
    stats = stats.withColumn("_groups", F.when(enough, F.col("_weekdays")).otherwise(F.array(F.flatten("_weekdays"))))
    # The median of a group is taken once, not for each of its days.
    middle = F.transform("_groups", lambda days: F.struct(days.alias("days"), _median(days).alias("median")))
    off = F.flatten(F.transform(middle, lambda g: F.transform(g["days"], lambda x: F.abs(x - g["median"]))))
    stats = stats.select(
        *keys, "actual_rows", "baseline_days",
        _median(F.get("_groups", F.lit(0))).alias("expected_rows"), _median(off).alias("mad_rows"),
    )
    silent = F.lit(False)
    if known is not None:
        # Both sides have one row per table.
        stats = stats.join(known.select(*keys).dropna().distinct(), keys, "full_outer")
        stats = stats.withColumn("_silent", F.col("baseline_days").isNull()).fillna(
            0, ["actual_rows", "baseline_days"]
        )
        silent = F.col("_silent")
    spread = F.greatest(sigmas * MAD_SCALE * F.col("mad_rows"), TOLERANCE * F.col("expected_rows"))
    floor = F.greatest(F.lit(0.0), F.col("expected_rows") - spread)
    return stats.withColumn(
        "min_predicted_rows", F.when(F.col("baseline_days") >= min_baseline, floor)
    ).withColumn(
        "completeness_status",
        F.when(silent, UNHEALTHY)
        .when(F.col("min_predicted_rows").isNull(), UNKNOWN)
        .when(F.col("actual_rows") < F.col("min_predicted_rows"), UNHEALTHY)
        .otherwise(HEALTHY),
    ).drop("_silent")


def table_totals(commits: DataFrame, as_of: AsOf = None, tolerance: float = TOLERANCE) -> DataFrame:
    """All rows of each table, from what its commits added; a table must not lose more than `tolerance` in a day."""
    end = instant(commits, "commit_time", as_of)
    added = F.coalesce("rows_added", F.lit(0))
    before = F.sum(F.when(F.col("commit_time") <= days_before(end, 1), added))
    return (
        commits.where(F.col("commit_time") <= end)
        .groupBy("table_id")
        .agg(F.sum(added).alias("total_rows"), before.alias("_before"))
        .select(
            "table_id", "total_rows", F.ceil(F.col("_before") * (1.0 - tolerance)).cast("long").alias("min_total_rows")
        )
    )


def percent_null(
    df: DataFrame,
    columns: Sequence[str],
    ts_col: str,
    as_of: AsOf = None,
    baseline: int = 14,
    min_baseline: int = 7,
    sigmas: float = 3.0,
    floor_pct: float = 1.0,
) -> DataFrame:
    """Null percentage of each column on the newest day, against the days before it."""
    filled = [F.count(F.col(f"`{c}`")).alias(f"_filled_{i}") for i, c in enumerate(columns)]
    share = [
        F.struct(
            F.lit(c).alias("column_name"),
            ((F.col("_total") - F.col(f"_filled_{i}")) * 100.0 / F.col("_total")).alias("_pct"),
        )
        for i, c in enumerate(columns)
    ]
    days = (
        _recent_buckets(df, ts_col, as_of, baseline + 1)
        .groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_total"), *filled)
        .select("_bucket", F.inline(F.array(*share)))
    )
    past = F.when(F.col("_bucket") > 0, F.col("_pct"))
    stats = days.groupBy("column_name").agg(
        F.max(F.when(F.col("_bucket") == 0, F.col("_pct"))).alias("null_pct"),
        F.count(past).alias("baseline_days"),
        F.avg(past).alias("avg_null_pct"),
        F.stddev_samp(past).alias("stddev_null_pct"),
    )
    limit = F.greatest(
        F.lit(floor_pct), F.col("avg_null_pct") + sigmas * F.col("stddev_null_pct")
    )
    unknown = (F.col("baseline_days") < min_baseline) | F.col("null_pct").isNull()
    return stats.withColumn("max_predicted_pct", F.when(~unknown, limit)).withColumn(
        "null_status",
        F.when(unknown, UNKNOWN)
        .when(F.col("null_pct") > F.col("max_predicted_pct"), UNHEALTHY)
        .otherwise(HEALTHY),
    )


def table_mentions(history: DataFrame, tables: DataFrame) -> DataFrame:
    """(statement_id, table_id) for every table a statement names in full."""
    names = tables.select(
        dotted_name("catalog_name", "schema_name", "table_name").alias("_name"), "table_id"
    )
    spoken = history.select("statement_id", identifiers("statement_text", IDENTIFIER_3).alias("_name"))
    return lookup_join(spoken, names, ["_name"]).select("statement_id", "table_id")


def _edges(lineage: DataFrame) -> DataFrame:
    """Distinct lineage without loops of a table to itself."""
    named = lineage.where("upstream_table_id <> downstream_table_id")
    return named.select("upstream_table_id", "downstream_table_id").distinct()


def downstream_tables(lineage: DataFrame) -> DataFrame:
    """(root, table_id): every table that can be reached from another, however many steps away.

    Level by level: each round follows the edges of what the last one found first, so that cycles
    end; a table does not count as downstream of itself. Each level is written to the shared folder.
    """
    edges = cut(_edges(lineage))
    step = edges.select(F.col("upstream_table_id").alias("table_id"), F.col("downstream_table_id").alias("_next"))
    new = edges.select(F.col("upstream_table_id").alias("_root"), F.col("downstream_table_id").alias("table_id"))
    found = [new]
    while not new.isEmpty():
        known = reduce(DataFrame.unionByName, found)
        ahead = new.join(step, "table_id").where("_next <> _root")
        ahead = ahead.select("_root", F.col("_next").alias("table_id")).distinct()
        new = cut(ahead.join(known, ["_root", "table_id"], "left_anti"))
        found.append(new)
    return reduce(DataFrame.unionByName, found)


def downstream_impact(
    tables: DataFrame,
    lineage: DataFrame,
    history: DataFrame,
    high_tables: int = 10,
    high_queries: int = 100,
) -> DataFrame:
    """All downstream tables, and statements that name the table or one of those."""
    reached = cut(downstream_tables(lineage))
    fan_out = reached.groupBy(F.col("_root").alias("table_id")).agg(
        F.count(F.lit(1)).alias("num_downstream_tables")
    )
    affected = reached.unionByName(tables.select(F.col("table_id").alias("_root"), "table_id").distinct())
    # Many statements name the same tables: each distinct set of them meets the lineage once.
    spoken = table_mentions(history, tables).where(F.col("statement_id").isNotNull())
    sets = (
        spoken.groupBy("statement_id")
        .agg(F.array_sort(F.collect_set("table_id")).alias("_set"))
        .groupBy("_set")
        .agg(F.count(F.lit(1)).alias("_statements"))
        .withColumn("table_id", F.explode("_set"))
    )
    asked = (
        sets.join(affected, "table_id")
        .select("_root", "_set", "_statements")
        .distinct()
        .groupBy(F.col("_root").alias("table_id"))
        .agg(F.sum("_statements").alias("num_queries_on_affected_tables"))
    )
    n_tables = F.coalesce("num_downstream_tables", F.lit(0))
    n_queries = F.coalesce("num_queries_on_affected_tables", F.lit(0))
    return (
        tables.select("table_id")
        .join(fan_out, "table_id", "left")
        .join(asked, "table_id", "left")
        .select(
            "table_id",
            F.when((n_tables >= high_tables) | (n_queries >= high_queries), "HIGH")
            .when((n_tables > 0) | (n_queries > 0), "MEDIUM")
            .otherwise("LOW")
            .alias("impact_level"),
            n_tables.alias("num_downstream_tables"),
            n_queries.alias("num_queries_on_affected_tables"),
        )
    )


def failed_writers(writes: DataFrame, timeline: DataFrame, as_of: AsOf = None) -> DataFrame:
    """(table_id, run_name) of the tables whose newest run, of those that wrote them, failed.

    `writes` has (table_id, run_id).
    """
    ended = timeline.where(F.col("end_time") <= instant(timeline, "end_time", as_of))
    runs = ended.select("run_id", "run_name", F.upper("result_state").alias("_state"), "end_time")
    newest = F.max_by(F.struct("run_name", "_state"), F.struct("end_time", "run_id"))
    latest = writes.select("table_id", "run_id").join(runs, "run_id").groupBy("table_id").agg(newest.alias("_run"))
    return latest.where(F.col("_run._state").isin(*FAILED_STATES)).select("table_id", "_run.run_name")


def root_causes(
    unhealthy: DataFrame, lineage: DataFrame, writes: DataFrame, timeline: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """(table_id, upstream_jobs): the nearest failed runs upstream of each unhealthy table.

    The walk begins with the run that wrote the table itself and goes back level by level, until a level has
    a table whose newest run failed; all failed runs of that level are named. A table
    with none upstream is not in the result.
    """
    back = cut(_edges(lineage)).select(F.col("downstream_table_id").alias("table_id"), F.col("upstream_table_id").alias("_up"))
    failed = cut(failed_writers(writes, timeline, as_of))
    here = cut(unhealthy.select(F.col("table_id").alias("_root"), "table_id").distinct())
    seen, found = [here], []
    while not here.isEmpty():
        blamed = cut(here.join(failed, "table_id").select("_root", "run_name").distinct())
        found.append(blamed)
        going = here.join(blamed.select("_root").distinct(), "_root", "left_anti")
        ahead = going.join(back, "table_id").select("_root", F.col("_up").alias("table_id")).distinct()
        here = cut(ahead.join(reduce(DataFrame.unionByName, seen), ["_root", "table_id"], "left_anti"))
        seen.append(here)
    if not found:
        return unhealthy.select("table_id", F.array().cast("array<string>").alias("upstream_jobs")).where("false")
    every = reduce(DataFrame.unionByName, found)
    return every.groupBy(F.col("_root").alias("table_id")).agg(
        F.sort_array(F.collect_set("run_name")).alias("upstream_jobs")
    )


def unhealthy_tables(freshness_df: DataFrame, completeness_df: DataFrame) -> DataFrame:
    """Ids of the tables that fail one of the checks.

    The checks' outcomes are written first: a filter on a status, moved below them, would hold each median many times over.
    """
    fresh = freshness_df.select("table_id", F.col("freshness_status").alias("_status"))
    outcomes = cut(fresh.unionByName(completeness_df.select("table_id", F.col("completeness_status").alias("_status"))))
    return outcomes.where(F.col("_status") == UNHEALTHY).select("table_id").distinct()


def assemble_results(
    freshness_df: DataFrame,
    completeness_df: DataFrame,
    tables: DataFrame,
    schemata: DataFrame,
    impact: DataFrame,
    as_of: AsOf = None,
    totals: DataFrame | None = None,
    causes: DataFrame | None = None,
) -> DataFrame:
    """One nested health record per checked table, in the shape of `schemas.TABLE_RESULTS`.

    `totals` are those of `table_totals`; without them the total count repeats the daily one. `causes` are
    those of `root_causes`; a table without one has a null there.
    """
    fresh, daily = F.col("freshness_status"), F.col("completeness_status")
    total, lost = F.col("_total_status"), F.lit("ROWS_LOST")
    no_code = F.lit(None).cast("string")
    record = (
        freshness_df.join(completeness_df, "table_id", "full_outer")
        .withColumns(
            {
                "freshness_status": F.coalesce(fresh, F.lit(UNKNOWN)),
                "completeness_status": F.coalesce(daily, F.lit(UNKNOWN)),
            }
        )
        .join(tables, "table_id")
        .join(impact, "table_id", "left")
        .join(schemata, ["catalog_name", "schema_name"], "left")
    )
    # A count is below the predicted minimum if and only if it is below its ceiling.
    at_least = F.ceil("min_predicted_rows").cast("long")
    if totals is None:
        record = record.withColumns({"total_rows": F.col("actual_rows"), "min_total_rows": at_least, "_total_status": daily})
    else:
        record = record.join(totals, "table_id", "left").withColumn(
            "_total_status",
            F.when(F.col("min_total_rows").isNull(), UNKNOWN)
            .when(F.col("total_rows") < F.col("min_total_rows"), UNHEALTHY)
            .otherwise(HEALTHY),
        )
    if causes is None:
        record = record.withColumn("upstream_jobs", F.lit(None).cast("array<string>"))
    else:
        record = record.join(causes, "table_id", "left")

    def either(*parts: Column) -> Column:
        bad = reduce(Column.__or__, [p == UNHEALTHY for p in parts])
        unknown = reduce(Column.__and__, [p == UNKNOWN for p in parts])
        return F.when(bad, UNHEALTHY).when(unknown, UNKNOWN).otherwise(HEALTHY)

    def counted(status: Column, code: Column, value: str, least: Column) -> Column:
        parts = {"status": status, "error_code": code, "last_value": F.col(value), "min_predicted_value": least}
        return F.struct(*[c.alias(name) for name, c in parts.items()])

    record = record.select(
        as_of_ts(as_of).alias("event_time"),
        "catalog_name",
        "schema_name",
        "table_name",
        "schema_id",
        "table_id",
        either(fresh, daily, total).alias("status"),
        F.struct(
            fresh.alias("status"),
            F.struct(
                fresh.alias("status"),
                no_code.alias("error_code"),
                F.col("last_commit").cast("timestamp").alias("last_value"),
                F.col("predicted_commit").alias("predicted_value"),
            ).alias("commit_freshness"),
        ).alias("freshness"),
        F.struct(
            either(daily, total).alias("status"),
            counted(
                total, F.when(total == UNHEALTHY, lost).otherwise(no_code), "total_rows", F.col("min_total_rows")
            ).alias("total_row_count"),
            counted(daily, no_code, "actual_rows", at_least).alias("daily_row_count"),
        ).alias("completeness"),
        F.struct(
            "impact_level", "num_downstream_tables", "num_queries_on_affected_tables"
        ).alias("downstream_impact"),
        F.when(F.col("upstream_jobs").isNotNull(), F.struct("upstream_jobs")).alias("root_cause_analysis"),
    )
    return record.select(*[F.col(f.name).cast(f.dataType) for f in TABLE_RESULTS.fields])
