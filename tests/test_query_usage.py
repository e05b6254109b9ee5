from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tagquality.operators import query_usage

DIM = "askid STRING, schema_id STRING, catalog_name STRING, schema_name STRING"
HISTORY = (
    "statement_id STRING, start_time TIMESTAMP, statement_text STRING, execution_status STRING, "
    "total_duration_ms BIGINT, read_rows BIGINT, read_bytes BIGINT"
)


def texts(spark, *statements):
    rows = [(str(i), s) for i, s in enumerate(statements)]
    return spark.createDataFrame(rows, "statement_id STRING, statement_text STRING")


def dims(spark, *names):
    rows = [(f"P{i}", str(i), c, s) for i, (c, s) in enumerate(names)]
    return spark.createDataFrame(rows, DIM)


def pairs(df):
    return sorted((r["statement_id"], r["askid"]) for r in df.select("statement_id", "askid").collect())


def brute_force(history, dim):
    """Every statement against every pattern; small inputs only."""
    pattern = F.concat(F.lit("%"), F.upper("catalog_name"), F.lit("."), F.upper("schema_name"), F.lit("%"))
    return pairs(history.crossJoin(dim).where(F.like(F.upper("statement_text"), pattern)))


def test_like_finds_prefixes_and_wildcards(spark):
    dim = dims(spark, ("x_y", "s1"), ("x_y", "s10"), ("xzy", "s10"))
    history = texts(spark, "select * from x_y.s10.t", "select * from xzy.s1.t")
    assert pairs(query_usage.match_by_like(history, dim)) == [("0", "P0"), ("0", "P1"), ("1", "P0")]
    assert pairs(query_usage.match_by_identifier(history, dim)) == [("0", "P1")]


def test_a_statement_meets_a_schema_once(spark):
    dim = dims(spark, ("cat", "sch"), ("c_t", "sch"))
    history = texts(
        spark, "select * from cat.sch.a join cat.sch.b join CAT.SCH.c", "cat.sch", "cut.sch cat.sch"
    )
    assert pairs(query_usage.match_by_like(history, dim)) == brute_force(history, dim)
    assert pairs(query_usage.match_by_identifier(history, dim)) == [("0", "P0")]


def test_like_equals_comparing_all_pairs(spark):
    rng = random.Random(11)

    def name(alphabet, size):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(1, size)))

    catalogs = [name("ab_", 4) for _ in range(6)] + ["a.b", "a%b", "_", "prod_main_eu", "a+b", "%"]
    names = {(rng.choice(catalogs), name("ab_1%.", 6)) for _ in range(80)}
    dim = dims(spark, *sorted(names), ("a", "b\\_1"), ("b\\%", "a"))
    statements = [name("ab_1. .ABx+%", 40) for _ in range(150)]
    statements += [f"from {c}.{s}.t, {c}.{s}" for c, s in sorted(names)[:40]]
    history = texts(spark, *statements, None, "", "no dots", ".", "..", "a.b_1", "b%.a")
    expected = brute_force(history, dim)
    assert len(expected) > 300
    assert pairs(query_usage.match_by_like(history, dim)) == expected


def test_ways_beyond_the_broadcast_bound_agree(spark):
    dim = dims(spark, *[("cat", f"s{i}") for i in range(30)])
    history = texts(spark, *[f"select 1 from cat.s{i % 7}.t, cat.s{i % 31}.u" for i in range(60)])
    like, exact = brute_force(history, dim), pairs(query_usage.match_by_identifier(history, dim))
    assert pairs(query_usage.match_by_like(history, dim, max_bytes=0)) == like
    assert pairs(query_usage.match_by_identifier(history, dim, max_bytes=0)) == exact
    assert set(exact) <= set(like)


def test_statements_of_one_partition_are_matched_by_several_tasks(spark):
    dim = dims(spark, ("cat", "sch"))
    history = texts(spark, *[f"select {k} from cat.sch.t" for k in range(40)]).coalesce(1)
    found = query_usage.match_by_like(history, dim).select("statement_id", F.spark_partition_id().alias("task")).collect()
    assert sorted(int(r["statement_id"]) for r in found) == list(range(40))
    assert len({r["task"] for r in found}) > 1


def test_wildcards_may_stand_for_dots_and_runs_may_be_short(spark):
    rng = random.Random(23)
    parts = ["DEV_U1", "dev.u1", "DEVxU1", "SALES_EU", "sales1eu", "_", "__", "A_B", "a.b", "_x", "é_ü", "s", ".", "a%_b", "ab_"]
    names = sorted({(rng.choice(parts), rng.choice(parts) + rng.choice(["", "1", "_", "_q"])) for _ in range(90)})
    dim = dims(spark, *names)
    statements = [rng.choice(["", " ", "x"]).join(rng.choice([*parts, ".", ".", "1"]) for _ in range(rng.randint(1, 9))) for _ in range(200)]
    statements += [f"from {c.replace('_', '.')}.{s.replace('_', 'k')}" for c, s in names]
    statements += ["." * 60, "x" * 200 + ".".join("abcdefgh" * 6), "Dev.U1." * 40]
    history = texts(spark, *statements)
    expected = brute_force(history, dim)
    assert len(expected) > 300
    assert pairs(query_usage.match_by_like(history, dim)) == expected


def test_candidates_of_a_statement_are_the_catalogs_it_names(spark):
    """Catalogs that end in a wildcard place, many schemas each: no statement meets what it does not name."""
    catalogs = ["DEV_U1", "DEV_U2", "SALES_EU", "SALES_US", "A_1", "PROD_"]
    dim = dims(spark, *[(c, f"SCHEMA_{i}") for c in catalogs for i in range(150)])
    history = texts(
        spark,
        "select * from other.thing.t join more.of.this",
        "select * from dev_u1.schema_7.t",
        "select * from dev_u1.schema_7.t, sales_eu.schema_149.t, u1.schema_7, 1.schema_7, x.eu",
        "select 1",
        "from a_1.schema_12.t where x.y = 1.5",
    )
    near = query_usage.catalog_candidates(history, query_usage._patterns(dim))
    met = {r["statement_id"]: r["count"] for r in near.groupBy("statement_id").count().collect()}
    assert met.get("0", 0) == 0 and met.get("3", 0) == 0
    assert met["1"] <= 3 and met["2"] <= 6 and met["4"] <= 3
    assert near.where(F.length(F.regexp_replace("_key", "^[0-9,]+[.]", "")) <= 1).isEmpty()
    assert pairs(query_usage.match_by_like(history, dim)) == brute_force(history, dim)


def test_identifiers_may_be_quoted_or_foreign(spark):
    dim = dims(spark, ("my cat", "sch"), ("données", "été"), ("a", "b.c"))
    history = texts(
        spark, "from `my cat`.sch.t", "from données.été.t", "from a.`b.c`.t", "from a.b.c.t",
        "xdonnées.été.t", "from `Données`.`été`.t", "from db.a.`b.c`.t",
    )
    got = pairs(query_usage.match_by_identifier(history, dim))
    assert got == [("0", "P0"), ("1", "P1"), ("2", "P2"), ("5", "P1")]


def usage_rows(spark):
    now = datetime(2024, 1, 20)
    rows = [
        ("1", now, "from c.s1.t join c.s2.t", "FINISHED", 3_600_000, 10, 1 << 30),
        ("2", now, "from c.s1.t", "FAILED", 1_800_000, 5, 0),
        ("3", now, "from c.s1.t", "RUNNING", 9, 9, 9),
        ("4", datetime(2023, 1, 1), "from c.s1.t", "FINISHED", 9, 9, 9),
    ]
    return spark.createDataFrame(rows, HISTORY)


@pytest.mark.parametrize("match", ["like", "identifier"])
def test_two_schemas_of_one_project_count_twice(spark, match):
    dim = spark.createDataFrame([("P", "1", "c", "s1"), ("P", "2", "c", "s2")], DIM)
    row = query_usage.query_usage(usage_rows(spark), dim, "2024-01-31", match=match).collect()
    assert len(row) == 1
    assert row[0].asDict() == {
        "askid": "P",
        "query_month": datetime(2024, 1, 1).date(),
        "total_queries": 3,
        "successful_queries": 2,
        "failed_queries": 1,
        "total_compute_hours": 2.5,
        "avg_query_duration_sec": 3000.0,
        "total_rows_read": 25,
        "total_gb_read": 2.0,
    }


def test_unknown_way_is_refused(spark):
    with pytest.raises(ValueError):
        query_usage.query_usage(usage_rows(spark), dims(spark, ("c", "s")), match="guess")


def test_full_report_fills_missing_parts(spark):
    dim = spark.createDataFrame(
        [("P", "1", "c", "s1"), ("P", "2", "c", "s2"), ("Q", "3", "c", "s3")], DIM
    )
    usage = spark.createDataFrame(
        [
            (datetime(2024, 1, 20), 2.5, "DATA_QUALITY_MONITORING", ("1",)),
            (datetime(2024, 1, 20), 1.0, "JOBS", ("1",)),
            (datetime(2023, 1, 20), 1.0, "DATA_QUALITY_MONITORING", ("1",)),
        ],
        "usage_date DATE, usage_quantity DOUBLE, billing_origin_product STRING, "
        "usage_metadata STRUCT<schema_id: STRING>",
    )
    results = spark.createDataFrame(
        [
            (datetime(2024, 1, 20), "1", "t", "Unhealthy"),
            (datetime(2024, 1, 21), "2", "t", None),
            (datetime(2024, 1, 21), "2", "t", "HEALTHY"),
            (datetime(2023, 1, 21), "2", "old", "Unhealthy"),
        ],
        "event_time TIMESTAMP, schema_id STRING, table_name STRING, status STRING",
    )
    report = query_usage.full_report(dim, usage, results, usage_rows(spark), "2024-01-31")
    got = [tuple(r) for r in report.collect()]
    # The running statement counts here; the table of two schemas is one name.
    assert got == [("P", ["c.s1", "c.s2"], 2.5, 1, 1, 4, 2.5), ("Q", ["c.s3"], 0.0, 0, 0, 0, 0.0)]
