"""Query history attributed to owners through the schemas named in the statement text.

Two ways to find the schemas. `like` finds the text `CATALOG.SCHEMA` anywhere, with
the wildcards of LIKE, so `a.s1` is also found in `a.s10`. `identifier` cuts whole
names out of the text and matches those. Both are joins on equal keys, so no
statement is compared with every schema: `like` gives each catalog a key of literal
characters near the dot, turns each schema name into a length and the places of its
wildcards, and cuts keys of those shapes from the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagquality.constants import MONITORING_PRODUCT, PROJECT_TAG
from tagquality.operators.health import is_anomaly
from tagquality.operators.tags import SCHEMA_KEY
from tagquality.plans.calendar import AsOf, as_of_date, days_before, instant, month_of
from tagquality.plans.joins import BROADCAST_BYTES, lookup_join

# Literal characters of a key: the lengths to which a run of them is cut, longest first; a run of
# at least STRONG characters is a key by itself. Runs are looked for within REACH characters of the dot.
RUN_STEPS = (8, 5, 3, 2, 1)
STRONG = 3
REACH = 24

# A dotted name starts where no name is under way; its parts are taken whole or not at all.
_START = r"(?<![\p{L}\p{N}_`.])"
_PART = r"(?:`[^`]+`|[\p{L}\p{N}_]++)"
IDENTIFIER_2 = rf"{_START}{_PART}\.{_PART}(?=\.)"
IDENTIFIER_3 = rf"{_START}{_PART}\.{_PART}\.{_PART}"


_WORD = r"[\p{L}\p{N}_]+"


def dotted_name(*columns: str) -> Column:
    """Upper-case dotted name; parts that are not plain words stand in backticks."""

    def part(column: str) -> Column:
        name = F.upper(column)
        quoted = F.concat(F.lit("`"), name, F.lit("`"))
        return F.when(name.rlike(f"^{_WORD}$"), name).otherwise(quoted)

    return F.concat_ws(".", *[part(c) for c in columns])


def identifiers(text: str, pattern: str) -> Column:
    """Explode the distinct dotted names in a text, written as `dotted_name` writes them."""
    found = F.regexp_extract_all(F.upper(text), F.lit(pattern), F.lit(0))

    def plain(name: Column) -> Column:
        unquoted = F.regexp_replace(name, f"`({_WORD})`", "$1")
        return F.when(F.contains(name, F.lit("`")), unquoted).otherwise(name)

    return F.explode(F.array_distinct(F.transform(found, lambda n: plain(n))))


def _best_run(side: Column) -> Column:
    """(at, step): the longest run of literal characters of a side read from the dot, and its place.

    Runs end at the wildcard `_`; they are compared after they are cut to a step, and of equal ones
    the nearest to the dot counts. Both are 0 where the side has none.
    """

    def better(best: Column, piece: Column) -> Column:
        size = F.length(piece)
        step = F.lit(0)
        for n in reversed(RUN_STEPS):
            step = F.when(size >= n, n).otherwise(step)
        more = step > best["step"]
        return F.struct(
            (best["next"] + size + 1).alias("next"),
            F.when(more, best["next"]).otherwise(best["at"]).alias("at"),
            F.when(more, step).otherwise(best["step"]).alias("step"),
        )

    start = F.struct(F.lit(0).alias("next"), F.lit(0).alias("at"), F.lit(0).alias("step"))
    return F.aggregate(F.split(F.left(side, F.lit(REACH)), "_"), start, better)


def _key(shape: Column, before: Column, after: Column) -> Column:
    """The literal characters that a shape (la, ls, ra, rs) takes from both sides of a dot."""
    left = F.substr(before, shape["la"] + 1, shape["ls"])
    right = F.substr(after, shape["ra"] + 1, shape["rs"])
    places = F.concat_ws(",", *[shape[c].cast("string") for c in ("la", "ls", "ra", "rs")])
    return F.concat_ws(".", places, left, right)


def _patterns(dim: DataFrame) -> DataFrame:
    """The dimension with the parts of its LIKE pattern on either side of the dot, and a key.

    A part ends where a `%` or an escape stands; the full pattern is then tested too. The key is a run
    of literal characters of the catalog, the one whose step is longest. If the catalog has
    only short runs, a run of the schema is added.
    """
    catalog, schema = F.upper("catalog_name"), F.upper("schema_name")
    whole = ~F.concat(catalog, schema).rlike(r"[%\\]")
    parts = dim.withColumns(
        {
            "_tail": F.regexp_extract(catalog, r"[^%\\]*$", 0),
            "_head": F.regexp_extract(schema, r"^[^%\\]*", 0),
            "_pattern": F.when(~whole, F.concat(F.lit("%"), catalog, F.lit("."), schema, F.lit("%"))),
        }
    )
    runs = parts.withColumn("_left", _best_run(F.reverse("_tail"))).withColumn("_right", _best_run(F.col("_head")))
    strong = F.col("_left.step") >= STRONG

    def of_schema(field: str) -> Column:
        return F.when(strong, 0).otherwise(F.col("_right")[field])

    shape = F.struct(
        F.col("_left.at").alias("la"),
        F.col("_left.step").alias("ls"),
        of_schema("at").alias("ra"),
        of_schema("step").alias("rs"),
    )
    keyed = runs.withColumn("_shape", shape)
    return keyed.withColumn("_key", _key(F.col("_shape"), F.reverse("_tail"), F.col("_head"))).drop("_left", "_right")


def _catalogs(patterns: DataFrame) -> DataFrame:
    """Per catalog and key: a regex for what follows the catalog's dots, and the shapes of its schemas.

    The shape of a schema name is its length and the places of its wildcards.
    """
    escaped = F.regexp_replace("_tail", r"[\p{Punct}&&[^_]]", r"\\$0")
    size = F.length("_head")
    places = F.filter(F.sequence(F.lit(1), size), lambda i: F.substr("_head", i, F.lit(1)) == "_")
    shape = F.struct(
        size.alias("size"), F.when(size > 0, places).otherwise(F.array()).alias("wild")
    )
    return (
        patterns.groupBy("_tail", "_key")
        .agg(
            F.collect_set(shape).alias("_shapes"),
            F.max(size).alias("_longest"),
            F.bool_or(F.col("_pattern").isNotNull()).alias("_retest"),
        )
        .select(
            "_tail",
            "_key",
            "_shapes",
            "_retest",
            # Looks ahead only, so places that overlap are all found.
            F.concat(
                F.lit("(?s)(?="),
                F.replace(escaped, F.lit("_"), F.lit(".")),
                F.lit(r"\.(.{0,"),
                F.col("_longest").cast("string"),
                F.lit("}))"),
            ).alias("_regex"),
        )
    )


def _dots(text: Column) -> Column:
    """What stands on both sides of each dot of a text, read from the dot, up to REACH characters."""
    pieces = F.split(text, r"\.")
    ends = F.transform(pieces, lambda p: F.right(p, F.lit(REACH)))
    begins = F.transform(pieces, lambda p: F.left(p, F.lit(REACH)))

    def sides(k: Column) -> Column:
        first = F.greatest(F.lit(1), k - REACH)
        before = F.right(F.array_join(F.slice(ends, first, k - first + 1), "."), F.lit(REACH))
        after = F.left(F.array_join(F.slice(begins, k + 1, F.lit(REACH + 1)), "."), F.lit(REACH))
        return F.struct(F.reverse(before).alias("before"), after.alias("after"))

    places = F.when(F.size(pieces) > 1, F.sequence(F.lit(1), F.size(pieces) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, sides))


def _text_keys(text: Column, shapes: Sequence[tuple[int, int, int, int]]) -> Column:
    """The distinct keys that a text has at its dots, of the shapes that occur."""
    names = ("la", "ls", "ra", "rs")
    known = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(s, names, strict=True)]) for s in shapes])

    def keys(dot: Column) -> Column:
        fits = F.filter(
            known,
            lambda s: (s["la"] + s["ls"] <= F.length(dot["before"])) & (s["ra"] + s["rs"] <= F.length(dot["after"])),
        )
        return F.transform(fits, lambda s: _key(s, dot["before"], dot["after"]))

    return F.array_distinct(F.flatten(F.transform(_dots(text), keys)))


def _heads() -> Column:
    """What follows the dots of a catalog, cut to each shape, wildcard places blanked."""
    after = F.array_distinct(F.regexp_extract_all("_text", F.col("_regex"), F.lit(1)))

    def cut(window: Column, shape: Column) -> Column:
        return F.aggregate(
            shape["wild"],
            F.left(window, shape["size"]),
            lambda head, place: F.overlay(head, F.lit("_"), place, F.lit(1)),
        )

    def cuts(window: Column) -> Column:
        long_enough = F.filter("_shapes", lambda s: s["size"] <= F.length(window))
        return F.transform(long_enough, lambda s: cut(window, s))

    return F.array_distinct(F.flatten(F.transform(after, cuts)))


def catalog_candidates(history: DataFrame, patterns: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Statements with each (catalog, key) whose key they have at one of their dots.

    A key is never empty: it holds a dot and the literal characters nearest to it that are
    worth most. Shapes of keys are few: places and lengths of a run within REACH characters.
    Statements are dealt evenly beforehand: a text costs far more work than its bytes tell, so that
    files, joins before or coalesced partitions would leave many to a few tasks.
    """
    found = patterns.select("_shape.*").dropna().distinct().collect()
    tasks = int(history.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = history.repartition(tasks).withColumn("_text", F.upper("statement_text"))
    keys = _text_keys(F.col("_text"), sorted(tuple(r) for r in found))
    if not found:
        keys = F.array().cast("array<string>")
    return lookup_join(text.withColumn("_key", F.explode(keys)), _catalogs(patterns), ["_key"], max_bytes=max_bytes)


def match_by_like(history: DataFrame, dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Statements with each dimension row whose `CATALOG.SCHEMA` pattern the text is like.

    Patterns are walked like a trie that begins at the dot: first the catalogs a text may name, by their
    keys, then the schemas of those, by their names with wildcard places blanked. Both are equal-key
    joins. A pattern has one key and one head, and the keys of a statement
    are distinct, so a statement meets a dimension row once, however often it names it.
    """
    patterns = _patterns(dim)
    near = catalog_candidates(history, patterns, max_bytes)
    # The text travels on only where a full pattern is still to be tested.
    keyed = near.withColumn("_head", F.explode(_heads())).withColumn(
        "_text", F.when(F.col("_retest"), F.col("_text"))
    )
    found = lookup_join(
        keyed.drop("_regex", "_shapes", "_retest"), patterns.drop("_shape"), ["_tail", "_key", "_head"], max_bytes=max_bytes
    )
    full = F.col("_pattern").isNull() | F.like(F.col("_text"), F.col("_pattern"))
    return found.where(full).drop("_text", "_tail", "_head", "_key", "_pattern")


def match_by_identifier(history: DataFrame, dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Statements with each dimension row whose schema they name in full."""
    named = history.withColumn("_name", identifiers("statement_text", IDENTIFIER_2))
    return lookup_join(
        named, dim.withColumn("_name", dotted_name(*SCHEMA_KEY)), ["_name"], max_bytes=max_bytes
    ).drop("_name")


def _matched(history: DataFrame, dim: DataFrame, match: str) -> DataFrame:
    if match == "like":
        return match_by_like(history, dim)
    if match == "identifier":
        return match_by_identifier(history, dim)
    raise ValueError(f"match must be 'like' or 'identifier', got {match!r}")


def _hours(millis: Column) -> Column:
    return F.round(millis / 1000.0 / 3600.0, 2)


def query_usage(
    history: DataFrame,
    dim: DataFrame,
    as_of: AsOf = None,
    days: int = 30,
    match: str = "identifier",
    owner: str = PROJECT_TAG,
) -> DataFrame:
    """Statements, hours and volume per (owner, month); a statement on two schemas counts twice."""
    since = days_before(instant(history, "start_time", as_of), days)
    finished = history.where(
        (F.col("start_time") >= since) & F.col("execution_status").isin("FINISHED", "FAILED")
    ).select(
        "start_time",
        "statement_text",
        "execution_status",
        "total_duration_ms",
        "read_rows",
        "read_bytes",
    )
    return (
        _matched(finished, dim.select(owner, *SCHEMA_KEY), match)
        .groupBy(owner, month_of("start_time").alias("query_month"))
        .agg(
            F.count(F.lit(1)).alias("total_queries"),
            F.count_if(F.col("execution_status") == "FINISHED").alias("successful_queries"),
            F.count_if(F.col("execution_status") == "FAILED").alias("failed_queries"),
            _hours(F.sum("total_duration_ms")).alias("total_compute_hours"),
            F.round(F.avg("total_duration_ms") / 1000.0, 1).alias("avg_query_duration_sec"),
            F.sum("read_rows").alias("total_rows_read"),
            F.round(F.sum("read_bytes") / (1024 * 1024 * 1024.0), 2).alias("total_gb_read"),
        )
        .orderBy(F.desc("query_month"), F.desc("total_queries"))
    )


def full_report(
    dim: DataFrame,
    usage: DataFrame,
    results: DataFrame,
    history: DataFrame,
    as_of: AsOf = None,
    days: int = 30,
    match: str = "identifier",
    owner: str = PROJECT_TAG,
    product: str = MONITORING_PRODUCT,
) -> DataFrame:
    """One row per owner: schemas, units, monitored tables, anomalies, statements and hours."""
    owners = dim.groupBy(owner).agg(
        F.sort_array(
            F.collect_set(F.concat("catalog_name", F.lit("."), "schema_name"))
        ).alias("schemas")
    )
    owned = dim.select(owner, "schema_id")

    # Facts are summed per schema first; only those sums meet the dimension.
    first_day = F.date_sub(as_of_date(as_of), days)
    cost = (
        usage.where(
            (F.col("billing_origin_product") == product) & (F.col("usage_date") >= first_day)
        )
        .groupBy(F.col("usage_metadata.schema_id").alias("schema_id"))
        .agg(F.sum("usage_quantity").alias("_units"))
        .join(owned, "schema_id")
        .groupBy(owner)
        .agg(F.round(F.sum("_units"), 4).alias("dqm_dbus_30d"))
    )
    since = days_before(instant(results, "event_time", as_of), days)
    health = (
        results.where(F.col("event_time") >= since)
        .groupBy("schema_id", "table_name")
        .agg(F.count_if(is_anomaly()).alias("_anomalies"))
        .join(owned, "schema_id")
        .groupBy(owner)
        .agg(
            F.countDistinct("table_name").alias("tables_monitored"),
            F.sum("_anomalies").alias("anomalies_30d"),
        )
    )
    asked_since = days_before(instant(history, "start_time", as_of), days)
    asked = history.where(F.col("start_time") >= asked_since).select(
        "statement_text", "total_duration_ms"
    )
    volume = (
        _matched(asked, dim.select(owner, *SCHEMA_KEY), match)
        .groupBy(owner)
        .agg(
            F.count(F.lit(1)).alias("queries_30d"),
            _hours(F.sum("total_duration_ms")).alias("compute_hours_30d"),
        )
    )

    report = owners
    for part in (cost, health, volume):
        report = report.join(part, owner, "left")
    numbers = [
        "dqm_dbus_30d",
        "tables_monitored",
        "anomalies_30d",
        "queries_30d",
        "compute_hours_30d",
    ]
    return report.select(
        owner, "schemas", *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers]
    ).orderBy(F.desc("dqm_dbus_30d"))
