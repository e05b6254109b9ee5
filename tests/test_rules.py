from __future__ import annotations

import random
import threading

import pytest
from pyspark.sql import functions as F

from tagquality.constants import EMAIL_RULE, NAME_RULE
from tagquality.operators import rules, scan
from tagquality.operators.rules import BoundRule, bind_rule
from tagquality.schemas import COLUMN_TAGS, RULE_MAPPING, TABLE_TAGS
from tagquality.sources.tables import append_results, rows_of

AS_OF = "2024-01-31 00:00:00"
RULE_COLUMNS = ["tag_name", "tag_value", "rule_name", "sql_expression", "criticality"]


def rule(text, column="v", level="error", name="Rule One"):
    return BoundRule(column, name, bind_rule(text, column), level)


def counts(df):
    return {(r["column_name"], r["rule_name"]): tuple(r)[3:6] for r in df.collect()}


def failing(spark, text, values, null_result="pass"):
    df = spark.createDataFrame([(v,) for v in values], "v STRING")
    return [r["v"] for r in df.where(rule(text).failed(null_result)).collect()]


def test_name_rule(spark):
    good = ["O'Brien", "obrien", "Mary-Jo Lee", "A"]
    bad = ["", "  ", None, "J0hn1", "!!B", "123", " Ann"]
    assert failing(spark, NAME_RULE, good + bad) == bad


def test_name_rule_accepts_a_final_newline(spark):
    assert failing(spark, NAME_RULE, ["Ann\n"]) == []


def test_email_rule(spark):
    bad = ["not-an-email", "x@domain", "@x.com", "", None, "a b@c.de"]
    assert failing(spark, EMAIL_RULE, ["a@b.co", *bad]) == bad


def test_null_result_of_a_rule(spark):
    assert failing(spark, "{col} <> 'x'", [None, "x", "y"]) == ["x"]
    assert failing(spark, "{col} <> 'x'", [None, "x", "y"], "fail") == [None, "x"]
    with pytest.raises(ValueError):
        rule("{col} > 1").failed("maybe")


def test_template_quotes_every_place(spark):
    assert bind_rule("{col} > 0 AND `{col}` < 9", "a b") == "`a b` > 0 AND `a b` < 9"
    assert bind_rule("{col} > 0", "we`ird") == "`we``ird` > 0"
    assert rule("{col}", name="First Name Conformance").check_name == (
        "dq_check_First_Name_Conformance"
    )
    df = spark.createDataFrame([(1,), (-1,)], "`odd name` INT")
    got = scan.scan_table(df, "t", [rule("{col} > 0", "odd name")], "run", AS_OF)
    assert counts(got) == {("odd name", "Rule One"): (2, 1, 0)}


def test_row_annotation(spark):
    df = spark.createDataFrame([(1, "x"), (-1, "x"), (-99, None)], "n INT, v STRING")
    bound = [
        rule("{col} > 0", "n", "error", "Positive Number"),
        rule("{col} > -50", "n", "error", "Not Tiny"),
        rule("{col} IS NOT NULL", "v", "warn", "Present"),
    ]
    rows = rules.annotate_rows(df, bound).orderBy(F.desc("n")).collect()
    assert rows[0]["_errors"] is None and rows[0]["_warnings"] is None
    assert [e["name"] for e in rows[1]["_errors"]] == ["dq_check_Positive_Number"]
    assert [e["name"] for e in rows[2]["_errors"]] == [
        "dq_check_Positive_Number",
        "dq_check_Not_Tiny",
    ]
    assert rows[2]["_warnings"][0]["criticality"] == "warn"
    assert rules.annotate_rows(df, bound[:1]).where("_warnings IS NOT NULL").count() == 0


def test_levels_go_to_their_own_column(spark):
    df = spark.createDataFrame([(1,), (-1,)], "v INT")
    got = scan.scan_table(
        df, "t", [rule("{col} > 0", name="E"), rule("{col} > 0", "v", "warn", "W")], "run", AS_OF
    )
    assert counts(got) == {("v", "E"): (2, 1, 0), ("v", "W"): (2, 0, 1)}


def test_unknown_level_is_refused():
    row = {"column_name": "v", "rule_name": "r", "sql_expression": "{col} > 0", "criticality": "bad"}
    with pytest.raises(ValueError, match="criticality"):
        rules.bound_rules([row])


def test_empty_table_gives_no_result(spark):
    df = spark.createDataFrame([], "v INT")
    assert scan.scan_table(df, "t", [rule("{col} > 0")], "run", AS_OF).count() == 0
    assert scan.scan_table(df, "t", [], "run", AS_OF).count() == 0


def test_one_pass_equals_one_job_per_rule(spark):
    rng = random.Random(7)
    data = [(rng.choice([None, *range(-20, 20)]), rng.choice("abc")) for _ in range(500)]
    df = spark.createDataFrame(data, "n INT, v STRING")
    bound = [
        rule(f"{{col}} > {i % 30 - 15}", "n", ("error", "warn")[i % 2], f"Rule {i}")
        for i in range(260)
    ]
    together = counts(scan.scan_table(df.repartition(5), "t", bound, "run", AS_OF))
    assert len(together) == 260
    for one in bound[::37]:
        assert together[("n", one.rule_name)] == counts(
            scan.scan_table(df, "t", [one], "run", AS_OF)
        )[("n", one.rule_name)]


def test_rules_of_a_table_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT").write.parquet(path)
    bound = [rule("{col} > 0", "a", name=f"R{i}") for i in range(20)] + [rule("{col} > 0", "b")]
    plan = scan.scan_table(spark.read.parquet(path), "t", bound, "run", AS_OF)._jdf
    text = plan.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "c#" not in text.split("FileScan")[1].split("]")[0]


def test_scan_of_all_tagged_tables(spark):
    tables = {
        "c.s.people": spark.createDataFrame([("Ann", 1), ("7", -1)], "name STRING, n INT"),
        "c.s.places": spark.createDataFrame([("Rome",)], "town STRING"),
        "c.s.empty": spark.createDataFrame([], "town STRING"),
    }
    tags = spark.createDataFrame(
        [
            ("c", "s", "people", "name", "dq", "name"),
            ("c", "s", "people", "n", "dq", "number"),
            ("c", "s", "places", "town", "dq", "name"),
            ("c", "s", "empty", "town", "dq", "name"),
            ("c", "s", "places", "town", "dq", "nothing"),
        ],
        COLUMN_TAGS,
    )
    mapping = rows_of(
        spark,
        RULE_MAPPING,
        RULE_COLUMNS,
        [
            ("dq", "name", "Name", NAME_RULE, "error"),
            ("dq", "number", "Positive", "{col} > 0", "warn"),
            ("dq", "unused", "Unused", "{col} > 0", "warn"),
        ],
    )
    got = scan.run_scan(tags, mapping, tables.__getitem__, as_of=AS_OF)
    rows = {(r["table_name"], r["column_name"]): tuple(r)[3:6] for r in got.collect()}
    assert rows == {
        ("c.s.people", "name"): (2, 1, 0),
        ("c.s.people", "n"): (2, 0, 1),
        ("c.s.places", "town"): (1, 0, 0),
    }
    assert got.select("run_id").distinct().count() == 1

    written = []
    run_id = scan.run_scan_into(
        tags, mapping, tables.__getitem__, written.append, as_of=AS_OF, tables_per_write=2
    )
    assert len(written) == 2
    assert sum(w.where(F.col("run_id") == run_id).count() for w in written) == 3
    nothing = scan.run_scan(tags.where("false"), mapping, tables.__getitem__)
    assert nothing.count() == 0 and nothing.columns == got.columns


def test_bad_rules_raise_or_are_reported(spark):
    table = spark.createDataFrame([(1,)], "n INT")
    tags = spark.createDataFrame(
        [("c", "s", "t", "n", "dq", "x"), ("c", "s", "t", "gone", "dq", "x")], COLUMN_TAGS
    )
    mapping = rows_of(
        spark,
        RULE_MAPPING,
        RULE_COLUMNS,
        [("dq", "x", "Positive", "{col} > 0", "error"), ("dq", "x", "Sum", "sum({col}) > 0", "error")],
    )
    resolve = {"c.s.t": table}.__getitem__
    with pytest.raises(Exception, match="gone"):
        scan.run_scan(tags, mapping, resolve).collect()
    kept = scan.run_scan(tags, mapping, resolve, on_error="report", as_of=AS_OF)
    assert counts(kept) == {("n", "Positive"): (1, 0, 0)}
    bad = scan.rejected_bindings(rules.discover_bindings(tags, mapping), resolve)
    assert {(r["column_name"], r["rule_name"]) for r in bad.collect()} == {
        ("gone", "Positive"),
        ("gone", "Sum"),
        ("n", "Sum"),
    }


def number_tags(spark, tables, column="n"):
    return spark.createDataFrame([("c", "s", t, column, "dq", "x") for t in tables], COLUMN_TAGS)


def test_rules_that_fail_on_data_are_taken_out(spark, tmp_path):
    """99 rules run, one fails on a value: it is reported, everything else is appended once."""
    table = spark.createDataFrame([(i, f"{i}" if i != 77 else "x") for i in range(200)], "n INT, v STRING")
    tags = number_tags(spark, ["t"], "v")
    rows = [("dq", "x", f"R{i}", f"LENGTH({{col}}) > {i % 4}", ("error", "warn")[i % 2]) for i in range(99)]
    rows.append(("dq", "x", "Bad", "CAST({col} AS INT) >= 0", "error"))
    mapping = rows_of(spark, RULE_MAPPING, RULE_COLUMNS, rows)
    resolve = {"c.s.t": table}.__getitem__
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        scan.run_scan_into(tags, mapping, resolve, pytest.fail, as_of=AS_OF)
    out, failed = str(tmp_path / "out"), []
    scan.run_scan_into(
        tags, mapping, resolve, lambda df: append_results(df, out), as_of=AS_OF, on_error="report", report=failed.append
    )
    got = spark.read.parquet(out)
    assert got.count() == 99 and got.select("rule_name").distinct().count() == 99
    assert [tuple(r)[:3] for df in failed for r in df.collect()] == [("c.s.t", "v", "Bad")]
    assert "CAST_INVALID_INPUT" in failed[0].first()["reason"]


def test_all_kinds_of_bad_rules_at_once(spark):
    good = spark.createDataFrame([(1, "a"), (0, "b")], "n INT, v STRING")
    tables = {"c.s.a": good, "c.s.b": good, "c.s.empty": good.where("false")}
    tags = number_tags(spark, ["a", "b", "empty"]).unionByName(number_tags(spark, ["b"], "gone"))
    mapping = rows_of(
        spark, RULE_MAPPING, RULE_COLUMNS,
        [("dq", "x", "Positive", "{col} > 0", "error"), ("dq", "x", "Inverse", "1 DIV {col} > 0", "warn"),
         ("dq", "x", "Sum", "sum({col}) > 0", "error"), ("dq", "x", "Level", "{col} > 0", "fatal")],
    )
    done, failed = [], []
    scan.run_scan_into(
        tags, mapping, tables.__getitem__, done.append, as_of=AS_OF, on_error="report", report=failed.append, tables_per_write=2
    )
    assert sorted(tuple(r)[:6] for df in done for r in df.collect()) == [
        ("c.s.a", "n", "Positive", 2, 1, 0), ("c.s.b", "n", "Positive", 2, 1, 0),
    ]
    names = {tuple(r)[:3] for df in failed for r in df.collect()}
    assert {("c.s.a", "n", "Inverse"), ("c.s.b", "n", "Sum"), ("c.s.empty", "n", "Level"), ("c.s.b", "gone", "Positive")} <= names
    assert ("c.s.empty", "n", "Inverse") not in names


def test_a_table_that_cannot_be_read_is_not_blamed_on_rules(spark):
    broken = spark.createDataFrame([("x",)], "v STRING").selectExpr("CAST(v AS INT) AS n")
    mapping = rows_of(spark, RULE_MAPPING, RULE_COLUMNS, [("dq", "x", "Positive", "{col} > 0", "error")])
    tables = {"c.s.t": broken.where("n > 0")}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        scan.run_scan_into(number_tags(spark, ["t"]), mapping, tables.__getitem__, pytest.fail, on_error="report")


def test_many_small_tables_make_few_files_with_one_instant(spark, tmp_path):
    table = spark.createDataFrame([(i,) for i in range(-5, 5)], "n INT")
    names = [f"t{i:03}" for i in range(200)]
    mapping = rows_of(spark, RULE_MAPPING, RULE_COLUMNS, [("dq", "x", "Positive", "{col} > 0", "error")])
    excluded = spark.createDataFrame([("c", "s", n, "dqm_exclude", "true") for n in names[:10]], TABLE_TAGS)
    out, threads = tmp_path / "out", set()

    def resolve(name):
        threads.add(threading.get_ident())
        return table

    run_id = scan.run_scan_into(
        number_tags(spark, names), mapping, resolve, lambda df: append_results(df, str(out)),
        table_tags=excluded, tables_per_write=50, workers=3, pool="scans",
    )
    got = spark.read.parquet(str(out))
    assert got.count() == 190 and got.select("table_name").distinct().count() == 190
    assert got.where("total_rows = 10 AND rows_error = 6").count() == 190
    assert got.select("scan_date", "run_id").distinct().collect()[0]["run_id"] == run_id
    assert got.select("scan_date").distinct().count() == 1
    assert len(list(out.rglob("part-*.parquet"))) == 4
    assert 1 <= len(threads) <= 3 and threading.get_ident() not in threads


def test_several_rules_of_a_tag_multiply(spark):
    tags = spark.createDataFrame([("c", "s", "t", "n", "dq", "x")] * 2, COLUMN_TAGS)
    mapping = rows_of(
        spark, RULE_MAPPING, RULE_COLUMNS, [("dq", "x", f"R{i}", "{col} > 0", "error") for i in (1, 2, 3)]
    )
    assert rules.discover_bindings(tags, mapping).count() == 6


def test_seed_rules():
    names = rules.name_rules("quality")
    assert [r[:3] for r in names] == [
        ("quality", "firstName", "First Name Conformance"),
        ("quality", "lastName", "Last Name Conformance"),
    ]
    assert rules.email_rule("quality")[4] == "error"
