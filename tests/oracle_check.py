"""Compare every registered query with its SQL oracle: names, rows and values, in any order.

    python tests/oracle_check.py [sf] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both sides agree, else what differs."""
    cursor = con.execute(sql)
    theirs_columns = [d[0] for d in cursor.description]
    theirs = normal(theirs_columns, cursor.fetchall())
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(df.columns)} != {sorted(theirs_columns)}"
    if ours == theirs:
        return ""
    ours_set, theirs_set = set(ours), set(theirs)
    missing = sorted(theirs_set - ours_set, key=repr)[:2]
    extra = sorted(ours_set - theirs_set, key=repr)[:2]
    return f"{len(ours)} rows != {len(theirs)} rows; missing {missing}; extra {extra}"


def main() -> None:
    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(build(spark, sf_dir), con, oracles[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} differences")


if __name__ == "__main__":
    main()
