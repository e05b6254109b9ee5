"""Scans: error and warning counts per (table, column, rule), one table pass for all rules."""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce
from itertools import groupby, islice

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tagquality.operators.rules import (
    BoundRule,
    bind_rule,
    bound_rules,
    discover_bindings,
    why_rejected,
)
from tagquality.operators.tags import split_excluded
from tagquality.plans.calendar import AsOf, as_of_ts
from tagquality.schemas import DQ_RESULTS

# Rules per pass over a table: beyond this, the generated code grows past what pays off.
RULES_PER_PASS = 100
TABLES_PER_WRITE = 32
# Jobs of a run that go side by side.
WORKERS = 4

# What a rule can end a pass with: it does not fit its table, or it fails on a value.
RULE_ERRORS = (PySparkException, Py4JJavaError, ValueError)
FAILED_RULES = "table_name STRING, column_name STRING, rule_name STRING, reason STRING"

ResolveTable = Callable[[str], DataFrame]


def _one_pass(
    df: DataFrame, table_name: str, rules: Sequence[BoundRule], null_result: str
) -> DataFrame:
    # Tags or rules given twice make two result rows, but are evaluated once.
    first_of = {r.predicate: r for r in reversed(rules)}
    slots = {predicate: f"_failed_{i}" for i, predicate in enumerate(first_of)}
    # count(when(..)) rather than count_if(..): its predicates stay apart in the generated
    # code, which keeps wide passes fast.
    counts = [
        F.count(F.when(rule.failed(null_result), 1)).alias(slots[predicate])
        for predicate, rule in first_of.items()
    ]
    zero = F.lit(0).cast("long")
    lines = [
        F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.rule_name).alias("rule_name"),
            F.col("_total").alias("total_rows"),
            (F.col(slots[r.predicate]) if r.criticality == "error" else zero).alias("rows_error"),
            (F.col(slots[r.predicate]) if r.criticality == "warn" else zero).alias("rows_warn"),
        )
        for r in rules
    ]
    return (
        df.agg(F.count(F.lit(1)).alias("_total"), *counts)
        .where("_total > 0")
        .select(F.inline(F.array(*lines)))
    )


def scan_table(
    df: DataFrame,
    table_name: str,
    rules: Sequence[BoundRule],
    run_id: str,
    as_of: AsOf = None,
    null_result: str = "pass",
) -> DataFrame:
    """Counts of one table, a row per rule. A table without rows gives no result rows."""
    if not rules:
        return df.sparkSession.createDataFrame([], DQ_RESULTS)
    # Passes take rules in column order, so that each one reads few columns.
    ordered = sorted(rules, key=lambda r: (r.column, r.rule_name))
    passes = [
        _one_pass(df, table_name, ordered[i : i + RULES_PER_PASS], null_result)
        for i in range(0, len(ordered), RULES_PER_PASS)
    ]
    counts = reduce(DataFrame.unionByName, passes)
    return counts.withColumns({"scan_date": as_of_ts(as_of), "run_id": F.lit(run_id)})


def _tables_of(bindings: DataFrame) -> Iterator[tuple[str, list[Row]]]:
    """Bindings table by table. The driver holds those of one partition, not all of them."""
    name = F.concat_ws(".", "catalog_name", "schema_name", "table_name")
    rows = (
        bindings.select(name.alias("_table"), "column_name", "rule_name", "sql_expression", "criticality")
        .orderBy("_table", "column_name", "rule_name")
        .toLocalIterator()
    )
    for table_name, group in groupby(rows, key=lambda r: r["_table"]):
        yield table_name, list(group)


def scan_bindings(
    bindings: DataFrame,
    resolve_table: ResolveTable,
    run_id: str,
    as_of: AsOf = None,
    null_result: str = "pass",
) -> Iterator[DataFrame]:
    """Lazy results of each bound table; every table is read once for all its rules."""
    for table_name, rows in _tables_of(bindings):
        yield scan_table(
            resolve_table(table_name), table_name, bound_rules(rows), run_id, as_of, null_result
        )


def _bindings(column_tags: DataFrame, rule_mapping: DataFrame, table_tags: DataFrame | None) -> DataFrame:
    """Bindings of the tables that `table_tags`, if given, do not exclude."""
    found = discover_bindings(column_tags, rule_mapping)
    return found if table_tags is None else split_excluded(found, table_tags)[0]


def _check_on_error(on_error: str) -> None:
    if on_error not in ("raise", "report"):
        raise ValueError(f"on_error must be 'raise' or 'report', got {on_error!r}")


def run_scan(
    column_tags: DataFrame,
    rule_mapping: DataFrame,
    resolve_table: ResolveTable,
    run_id: str | None = None,
    as_of: AsOf = None,
    null_result: str = "pass",
    on_error: str = "raise",
    table_tags: DataFrame | None = None,
) -> DataFrame:
    """Results of a whole scan as one DataFrame.

    Tables that `table_tags` marks as excluded are not scanned. `on_error="raise"` stops at the first
    rule that does not fit its table; `"report"` scans the others, and `rejected_bindings` lists the ones
    left out. Rules that fail on data can only be taken out by `run_scan_into`, which starts jobs.
    """
    _check_on_error(on_error)
    bindings = _bindings(column_tags, rule_mapping, table_tags)
    if on_error == "report":
        bindings = _runnable(bindings, resolve_table)
    run_id = run_id or str(uuid.uuid4())
    parts = list(scan_bindings(bindings, resolve_table, run_id, as_of or _now(), null_result))
    if not parts:
        return column_tags.sparkSession.createDataFrame([], DQ_RESULTS)
    return reduce(DataFrame.unionByName, parts)


def _now() -> datetime:
    return datetime.now(UTC)


@dataclass(frozen=True)
class _Job:
    """What the tables of a run have in common."""

    resolve_table: ResolveTable
    run_id: str
    as_of: AsOf
    null_result: str
    on_error: str

    def group(self, tables: Sequence[tuple[str, list[Row]]]) -> tuple[list[Row], list[tuple]]:
        """(result rows, failed rules) of some tables, in one job unless a rule fails."""
        try:
            parts = [
                scan_table(self.resolve_table(name), name, bound_rules(rows), self.run_id, self.as_of, self.null_result)
                for name, rows in tables
            ]
            return reduce(DataFrame.unionByName, parts).collect(), []
        except RULE_ERRORS:
            if self.on_error == "raise":
                raise
        done, failed = [], []
        for name, rows in tables:
            df = self.resolve_table(name)
            df.agg(F.count(F.lit(1))).collect()  # a table that cannot be read is no rule's fault
            results, bad = self._halved(df, name, rows)
            done += results
            failed += bad
        return done, failed

    def _halved(self, df: DataFrame, name: str, rows: list[Row]) -> tuple[list[Row], list[tuple]]:
        """Counts of the rules that run; half of the rules at a time where a pass fails."""
        try:
            bound = bound_rules(rows)
            return scan_table(df, name, bound, self.run_id, self.as_of, self.null_result).collect(), []
        except RULE_ERRORS as error:
            if len(rows) == 1:
                reason = str(error).split("\n")[0]
                return [], [(name, rows[0]["column_name"], rows[0]["rule_name"], reason)]
        middle = len(rows) // 2
        left, right = self._halved(df, name, rows[:middle]), self._halved(df, name, rows[middle:])
        return left[0] + right[0], left[1] + right[1]


def run_scan_into(
    column_tags: DataFrame,
    rule_mapping: DataFrame,
    resolve_table: ResolveTable,
    append: Callable[[DataFrame], None],
    run_id: str | None = None,
    as_of: AsOf = None,
    null_result: str = "pass",
    tables_per_write: int = TABLES_PER_WRITE,
    on_error: str = "raise",
    report: Callable[[DataFrame], None] | None = None,
    table_tags: DataFrame | None = None,
    workers: int = WORKERS,
    pool: str | None = None,
) -> str:
    """Scan and append; returns the run id.

    A job scans a group of tables; `workers` such jobs run side by side, in the scheduler pool `pool`. What a
    job counted, a row for each rule of its tables, is appended as one file after all of it has
    ended, so that nothing is appended twice or in part; appends follow one another. All rows of a run have one
    scan date. With `on_error="report"` a pass that fails, by analysis or on data, is run again
    with halves of its rules until the failing ones are alone; `report` is given these, and
    everything else counts as if they were not there.
    """
    _check_on_error(on_error)
    spark = column_tags.sparkSession
    job = _Job(resolve_table, run_id or str(uuid.uuid4()), as_of or _now(), null_result, on_error)
    groups = _grouped(_tables_of(_bindings(column_tags, rule_mapping, table_tags)), tables_per_write)

    @inheritable_thread_target(spark)
    def scan(group: list[tuple[str, list[Row]]]) -> tuple[list[Row], list[tuple]]:
        if pool is not None:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        return job.group(group)

    def keep(future: Future) -> None:
        rows, failed = future.result()
        if rows:
            append(spark.createDataFrame(rows, DQ_RESULTS).coalesce(1))
        if failed and report is not None:
            report(spark.createDataFrame(failed, FAILED_RULES).withColumn("run_id", F.lit(job.run_id)))

    with ThreadPoolExecutor(workers) as threads:
        waiting: deque[Future] = deque()
        for group in groups:
            # Bindings are fetched only as far ahead as there are threads.
            if len(waiting) > workers:
                keep(waiting.popleft())
            waiting.append(threads.submit(scan, group))
        while waiting:
            keep(waiting.popleft())
    return job.run_id


def _grouped(tables: Iterator[tuple[str, list[Row]]], size: int) -> Iterator[list[tuple[str, list[Row]]]]:
    while group := list(islice(tables, size)):
        yield group


def _judged(bindings: DataFrame, resolve_table: ResolveTable) -> list[tuple]:
    out = []
    for table_name, rows in _tables_of(bindings):
        df = resolve_table(table_name)
        for b in rows:
            text = bind_rule(b["sql_expression"], b["column_name"])
            rule = BoundRule(b["column_name"], b["rule_name"], text, b["criticality"])
            reason = why_rejected(df, rule)
            if reason is not None:
                out.append((table_name, b["column_name"], b["rule_name"], reason))
    return out


def rejected_bindings(bindings: DataFrame, resolve_table: ResolveTable) -> DataFrame:
    """Bindings whose rule does not analyse against its table, with the reason."""
    return bindings.sparkSession.createDataFrame(
        _judged(bindings, resolve_table),
        FAILED_RULES,
    )


def _runnable(bindings: DataFrame, resolve_table: ResolveTable) -> DataFrame:
    bad = rejected_bindings(bindings, resolve_table).select(
        F.col("table_name").alias("_table"), "column_name", "rule_name"
    )
    full_name = F.concat_ws(".", "catalog_name", "schema_name", "table_name")
    return (
        bindings.withColumn("_table", full_name)
        .join(bad, ["_table", "column_name", "rule_name"], "left_anti")
        .select(*bindings.columns)
    )
