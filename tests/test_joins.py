from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from tagquality.plans.joins import heavy_keys, lookup_join, payload_bytes


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_shuffled_join_equals_broadcast_join(spark, how):
    # One key holds most rows, some rows repeat, some have no key.
    facts = spark.createDataFrame(
        [("hot", i % 40) for i in range(400)] + [("cold", i) for i in range(20)]
        + [(None, 1), ("none", 2)],
        "k STRING, n INT",
    )
    lookup = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("cold", "c"), (None, "d")], "k STRING, v STRING")
    small = lookup_join(facts, lookup, ["k"], how)
    shuffled = lookup_join(facts, lookup, ["k"], how, max_bytes=0)
    assert small.columns == shuffled.columns
    assert rows(small) == rows(shuffled)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    plan = shuffled._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan
    # Only the lookup row of the hot key is copied.
    assert plan.count("Generate") == 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_a_hot_key_is_dealt_to_all_tasks(spark, how):
    """Half of the rows have one key, a tenth have none; nothing is split at run time."""
    facts = spark.range(60_000).selectExpr(
        "CASE WHEN id % 10 < 5 THEN 0 WHEN id % 10 < 9 THEN 1 + id % 3001 END AS k", "id AS n", "map('a', id) AS m"
    )
    lookup = spark.range(4_000).selectExpr("id AS k", "id * 2 AS v")
    want = rows(facts.drop("m").join(lookup, "k", how))
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in held}
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        assert set(heavy_keys(facts, ["k"], 16).values()) == {36}
        joined = lookup_join(facts, lookup, ["k"], how, max_bytes=0).drop("m")
        tasks = joined.where("k IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()
        sizes = sorted(r["count"] for r in tasks)
        assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
        assert rows(joined) == want
        plain = facts.drop("m").join(lookup, "k", how).where("k IS NOT NULL").groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in plain.collect()) > 30_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_even_keys_are_not_spread(spark):
    facts = spark.range(5_000).selectExpr("id % 1000 AS k", "id AS n")
    assert heavy_keys(facts, ["k"], 8) == {}
    assert heavy_keys(facts.where("false"), ["k"], 8) == {}
    assert heavy_keys(facts.selectExpr("CAST(NULL AS BIGINT) AS k"), ["k"], 8) == {}
    names = facts.selectExpr("IF(n < 4000, 'x', 'y' || n) AS k", "IF(n < 4000, 1, n) AS j", "n AS _part")
    assert len(heavy_keys(names, ["k", "j"], 8)) == 1
    lookup = names.select("k", "j").distinct().withColumn("_PART_", F.lit(1))
    assert lookup_join(names, lookup, ["k", "j"], max_bytes=0).count() == 5_000


def test_other_joins_are_refused(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        lookup_join(df, df, ["id"], "right")


def test_payload_grows_with_rows_and_values(spark):
    short = spark.createDataFrame([("a",)] * 10, "v STRING")
    long = spark.createDataFrame([("a" * 1000,)] * 10, "v STRING")
    assert payload_bytes(spark.createDataFrame([], "v STRING")) == 0
    assert payload_bytes(short) < 1000 < 10_000 <= payload_bytes(long)
    nested = spark.createDataFrame([({"k": "v" * 500},)], "m MAP<STRING, STRING>")
    assert payload_bytes(nested) > 500
