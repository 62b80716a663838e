import pytest
from pyspark.sql import functions as F

from clinflow.operators.lookups import (
    fetch_by_id,
    hot_keys,
    lookup_join,
    measured_bytes,
    spread_join,
    wanted_keys,
)


@pytest.fixture
def skewed(spark):
    """One key with a third of the rows, copies of one row, rows without a key, and misses."""
    return spark.range(0, 900, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50))
        .otherwise(F.lit(None))
        .alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"),
    )


@pytest.fixture
def reference(spark):
    known = spark.range(40).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("w"))
    return known.union(spark.createDataFrame([("hot", 99)], "k string, w long"))


def counted(df):
    return sorted(
        (tuple(r) for r in df.groupBy(*sorted(df.columns)).count().collect()), key=str
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_a_plain_join(skewed, reference, how):
    plain = skewed.join(reference, "k", how)
    assert counted(spread_join(skewed, reference, ["k"], how, hot_rows=50)) == counted(plain)


def test_spread_join_on_two_keys(skewed, reference):
    left = skewed.withColumn("j", F.lit(1))
    right = reference.withColumn("j", F.lit(1))
    got = spread_join(left, right, ["k", "j"], "left", hot_rows=50)
    assert counted(got) == counted(left.join(right, ["k", "j"], "left"))


def test_a_hot_key_is_spread_over_tasks(spark, skewed, reference):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_join(skewed, reference, ["k"], "left", hot_rows=50)
        tasks = joined.filter("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tasks > 1


def test_hot_keys_are_few_and_sized(skewed):
    assert sorted(tuple(r) for r in hot_keys(skewed.dropna(), ["k"], 50)) == [("hot", 6)]
    assert {tuple(r) for r in hot_keys(skewed, ["k"], 50)} == {(None, 6), ("hot", 6)}
    assert hot_keys(skewed, ["k"], 500) == []


def test_without_hot_keys_bucketed_tables_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.range(200).write.bucketBy(4, "id").mode("overwrite").saveAsTable("clinflow_left")
    spark.range(50).selectExpr("id", "id AS w").write.bucketBy(4, "id").mode(
        "overwrite"
    ).saveAsTable("clinflow_right")
    try:
        joined = spread_join(spark.table("clinflow_left"), spark.table("clinflow_right"), ["id"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.filter("w IS NOT NULL").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE clinflow_left")
        spark.sql("DROP TABLE clinflow_right")


def test_only_rows_without_a_key_are_hot(spark, skewed, reference):
    left = skewed.filter("k IS NULL OR k <> 'hot'")
    got = spread_join(left, reference, ["k"], "left", hot_rows=200)
    assert counted(got) == counted(left.join(reference, "k", "left"))


def test_only_measured_tables_are_broadcast(spark, tmp_path, reference):
    path = str(tmp_path / "reference")
    reference.write.parquet(path)
    small = spark.read.parquet(path)
    assert 0 < measured_bytes(small) < 10_000
    assert measured_bytes(small, limit=100) is None


def test_both_ways_give_the_same(spark, tmp_path, skewed, reference):
    path = str(tmp_path / "reference")
    reference.write.parquet(path)
    stored = spark.read.parquet(path)
    broadcast = lookup_join(skewed, stored, ["k"])
    shuffled = lookup_join(skewed, stored, ["k"], broadcast_bytes=10, hot_rows=50)
    adaptive = lookup_join(skewed, stored, ["k"], broadcast_bytes=10, hot_rows=None)
    assert "BroadcastHashJoin" in broadcast._jdf.queryExecution().executedPlan().toString()
    assert counted(broadcast) == counted(shuffled) == counted(adaptive)


def test_fetch_keeps_misses(rows):
    ids = rows(["a", "b", "a", None], "name string")
    store = rows([("a", "x")], "name string, data string")
    got = sorted((r.name or "", r.found, r.data) for r in fetch_by_id(ids, store).collect())
    assert got == [("", False, None), ("a", True, "x"), ("a", True, "x"), ("b", False, None)]


def test_few_wanted_keys_cut_a_large_table_down(spark, tmp_path, skewed, reference):
    path = str(tmp_path / "reference")
    reference.write.parquet(path)
    stored = spark.read.parquet(path)
    joined = lookup_join(skewed, stored, ["k"], small=False, hot_rows=50)
    assert counted(joined) == counted(skewed.join(reference, "k", "left"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan
    assert "GreaterThanOrEqual(k,hot)" in plan
    nothing = lookup_join(skewed.filter("k IS NULL"), stored, ["k"], small=False)
    assert nothing.filter("w IS NULL").count() == 300


def test_many_wanted_keys_are_not_pinned(spark, monkeypatch, skewed, reference):
    assert wanted_keys(skewed, ["k"]).count() == 51
    monkeypatch.setattr("clinflow.operators.lookups.MAX_WANTED_KEYS", 20)
    assert wanted_keys(skewed, ["k"]) is None
    joined = lookup_join(skewed, reference, ["k"], small=False, hot_rows=50)
    assert counted(joined) == counted(skewed.join(reference, "k", "left"))


def test_large_inputs_are_not_looked_at(spark, monkeypatch, tmp_path, skewed):
    skewed.write.parquet(str(tmp_path / "left"))
    stored = spark.read.parquet(str(tmp_path / "left"))
    assert wanted_keys(stored, ["k"]) is not None
    monkeypatch.setattr("clinflow.operators.lookups.MEASURE_BYTES", 10)
    assert wanted_keys(stored, ["k"]) is None
    assert measured_bytes(stored) is None
