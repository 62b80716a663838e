"""Filters of keys, and the joins that are cut down by them."""

import pytest
from pyspark.sql import functions as F

from clinflow.operators.key_filter import key_filter, with_possible
from clinflow.operators.lookups import fetch_by_id
from clinflow.operators.resources import current_messages


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 20])
def test_no_key_is_missed_and_few_others_pass(spark, tmp_path, bits):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("name")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    words = key_filter(keys, ["name"], bits)
    words.write.parquet(str(tmp_path / "w"))
    words = spark.read.parquet(str(tmp_path / "w"))
    assert words.count() <= bits // 64
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("name"), F.lit(1).alias("_p"), "id")
    found = with_possible(rows, words, ["name"], "maybe", bits)
    assert found.columns == ["name", "id", "maybe"] or "maybe" in found.columns
    assert found.count() == 20_000 and found.filter("id < 1000 AND NOT maybe").count() == 0
    passed = found.filter("id >= 1000 AND maybe").count()
    assert passed == 19_000 if bits == 64 else passed < (12_000 if bits == 1 << 12 else 20)


def test_a_filter_has_a_power_of_two_bits(spark):
    with pytest.raises(ValueError):
        key_filter(spark.range(1), ["id"], 100)


def names(spark, n):
    return spark.range(n).select(F.concat(F.lit("m/"), "id").alias("name"), F.col("id").alias("seq"), F.lit("x").alias("data"))


def test_only_possible_rows_are_shuffled_for_many_tombstones(spark):
    store = names(spark, 5000)
    gone = store.filter("seq % 10 = 0").select("name", (F.col("seq") + F.when(F.col("seq") % 20 == 0, 1).otherwise(-1)).alias("seq"))
    few = current_messages(store, gone)
    many = current_messages(store, gone, broadcast_bytes=0, filter_bits=1 << 16)
    assert sorted(many.collect()) == sorted(few.collect()) and many.count() == 4750
    assert many.columns == store.columns
    many.collect()
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "_possible" not in many.columns


def test_fetch_with_a_filter_finds_the_same(spark):
    store = names(spark, 3000).select("name", "data")
    ids = spark.createDataFrame([("m/7",), ("m/2999",), ("m/3000",), (None,), ("m/7",)], "name string")
    plain = fetch_by_id(ids, store)
    cut = fetch_by_id(ids, store, filter_bits=1 << 12, broadcast_bytes=0)
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect())) and cut.count() == 5
