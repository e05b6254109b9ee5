"""Every registered query against its SQL oracle, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


#: Queries that SQL cannot express. Each has a test in tests/llm against a brute-force version, the library
#: that it must equal, an exact round trip, or held-out accuracy.
WITHOUT_SQL = {
    "op1_warc", "op2_line_dedup", "op4_secrets", "op5_bpe", "op6_language_id", "op7_simhash", "op8_fingerprint",
    "op9_toxicity", "op10_token_counts", "op11_licenses", "pipeline",
}


def test_queries_have_sql_or_are_known_to_have_none():
    queries, sql = set(entry.queries()), set(entry.oracle_sql())
    assert sql <= queries
    assert queries - sql <= WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "table_name", "column_name", "rule_name", "total_rows", "rows_error", "rows_warn", "scan_date", "run_id",
    ]
    assert df.count() > 0
