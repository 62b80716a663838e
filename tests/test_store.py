import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clinflow.operators.resources import (
    current_messages,
    current_resources,
    read_resource,
    search_resources,
)
from clinflow.operators.store import (
    first_by_time,
    pinned_bounds,
    required_bounds,
    scan,
    send_bounds,
    sorted_ranges,
    store_scan,
    time_slices,
    unite_stores,
    with_slice,
)
from clinflow.sinks.messages import create_messages, delete_messages, ingest_messages

HOUR = 3_600_000
DAY = 24 * HOUR


def slices_of(rows, start, end, **spans):
    bounds = rows([("s", start, end)], "store string, from_ms long, to_ms long")
    got = time_slices(bounds, ["store"], **spans).orderBy("slice_id").collect()
    return [(r.slice_from, r.slice_to) for r in got]


def test_slices(rows):
    assert slices_of(rows, 0, 1) == [(0, 1)]
    assert slices_of(rows, 0, DAY) == [(0, DAY)]
    assert slices_of(rows, 5, 5 + DAY + HOUR - 1) == [(5, 5 + DAY + HOUR - 1)]
    assert slices_of(rows, 5, 5 + DAY + HOUR) == [(5, 5 + DAY), (5 + DAY, 5 + DAY + HOUR)]
    assert slices_of(rows, 0, 10, width=dt.timedelta(milliseconds=4),
                     shortest=dt.timedelta(milliseconds=2)) == [(0, 4), (4, 8), (8, 10)]


def messages(rows, *times):
    made = [("s", f"m{i}", t) for i, t in enumerate(times)]
    return rows(made, "store string, name string, send_time timestamp")


def test_every_message_is_in_the_slice_that_holds_it(rows):
    start = dt.datetime(2024, 1, 1)
    store = messages(rows, *[start + dt.timedelta(hours=7 * i, microseconds=900) for i in range(40)])
    bounds = pinned_bounds(store, ["store"])
    slices = {r.slice_id: r for r in time_slices(bounds, ["store"]).collect()}
    for r in with_slice(store, bounds, ["store"]).collect():
        ms = int((r.send_time - dt.datetime(1970, 1, 1)) / dt.timedelta(milliseconds=1))
        assert slices[r.slice_id].slice_from <= ms < slices[r.slice_id].slice_to


def test_bounds_of_missing_times(rows):
    store = messages(rows, dt.datetime(2024, 1, 1), None)
    r = send_bounds(store, ["store"]).first()
    assert r.from_ms == 0
    assert r.to_ms > 1_704_067_200_000 + 1


def test_bounds_of_text_times(rows):
    store = rows([("s", "2024-01-01T00:00:00.5Z"), ("s", "2024-01-01T00:00:01Z")],
                 "store string, send_time string")
    assert tuple(send_bounds(store, ["store"]).first()) == ("s", 1704067200500, 1704067201001)


def test_a_scan_without_messages_has_no_bounds(rows):
    store = messages(rows, dt.datetime(2024, 1, 1)).filter("store = 'x'")
    with pytest.raises(PySparkException, match="no message"):
        required_bounds(store).collect()


def test_missing_stores_and_times_have_a_slice(rows):
    """They don't stretch the slices of others, and no row is lost."""
    day = [dt.datetime(2024, 1, d) for d in (1, 2, 4)]
    made = [("a", "m0", day[0]), ("a", "m1", None), ("a", "m2", day[2]), (None, "m3", day[1]), ("b", "m4", None)]
    df = rows(made, "store string, name string, send_time timestamp")
    bounds = pinned_bounds(df, ["store"])
    assert time_slices(bounds, ["store"]).count() == 5
    got = {r.name: (r.store, r.slice_id) for r in with_slice(df, bounds, ["store"]).collect()}
    assert got == {"m0": ("a", 0), "m1": ("a", 0), "m2": ("a", 2), "m3": (None, 0), "m4": ("b", 0)}
    assert store_scan(df).count() == 5


def test_many_stores_are_joined_by_shuffle(rows, monkeypatch):
    df = rows([(f"s{i}", f"m{i}", dt.datetime(2024, 1, 1)) for i in range(50)],
              "store string, name string, send_time timestamp")
    monkeypatch.setattr("clinflow.operators.store.is_small", lambda df: False)
    assert store_scan(df).filter("slice_id = 0").count() == 50


@pytest.mark.parametrize("writer", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
@pytest.mark.parametrize("reader", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_days_are_pruned_alike_in_every_zone(spark, tmp_path, writer, reader):
    path = str(tmp_path / "store")
    hours = spark.range(72).selectExpr(
        "'s' AS store", "concat('m', id) AS name", "'d' AS data", "'{}' AS schematized_data",
        "map('a', 'b') AS labels", "timestamp_seconds(1704067200 + 3600 * id) AS create_time",
        "timestamp_seconds(1704067200 + 3600 * id) AS send_time",
    )
    try:
        spark.conf.set("spark.sql.session.timeZone", writer)
        create_messages(hours, path, 0)
        spark.conf.set("spark.sql.session.timeZone", reader)
        stored = spark.read.parquet(path)
        bounds = ("2024-01-02T00:00:00", "2024-01-03T00:00:00")
        pruned = {r.name for r in scan(stored, *bounds).select("name").collect()}
        assert pruned == {r.name for r in scan(stored.drop("send_date"), *bounds).select("name").collect()}
        assert len(pruned) > 15
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_predicate_holds_without_bounds(rows):
    store = messages(rows, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert scan(store, where="name = 'm1'").count() == 1
    assert scan(store, start="2024-01-02T00:00:00").count() == 1
    assert scan(store, end=dt.datetime(2024, 1, 2)).count() == 1


def test_bounds_reach_the_reader_and_prune_folders(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    store = messages(rows, *[dt.datetime(2024, 1, d) for d in range(1, 11)]).withColumns(
        {
            "data": F.lit("d"),
            "schematized_data": F.lit("{}"),
            "labels": F.create_map(F.lit("a"), F.lit("b")),
            "create_time": F.col("send_time"),
        }
    )
    create_messages(store, path, 0)
    create_messages(store, path, 0)
    got = scan(spark.read.parquet(path), "2024-01-03T00:00:00", "2024-01-05T00:00:00")
    assert sorted(r.name for r in got.collect()) == ["m2", "m3"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(send_date" in plan
    assert "GreaterThanOrEqual(send_time" in got._sc._jvm.PythonSQLUtils.explainString(
        got._jdf.queryExecution(), "formatted"
    )


def test_ranges_are_sorted_and_split_one_instant(spark, rows):
    store = messages(rows, *[dt.datetime(2024, 1, 1)] * 400)
    ranged = sorted_ranges(store, partitions=4).select("name", F.spark_partition_id().alias("p"))
    parts = {}
    for r in ranged.collect():
        parts.setdefault(r.p, []).append(r.name)
    assert len(parts) > 1
    assert all(names == sorted(names) for names in parts.values())


def test_first_and_last_agree_with_bounds(rows):
    store = messages(rows, *[dt.datetime(2024, 1, d) for d in (5, 2, 9)])
    assert first_by_time(store).first().name == "m1"
    assert first_by_time(store, latest=True).first().name == "m2"


def test_store_scan_keeps_every_message(rows):
    store = messages(rows, *[dt.datetime(2024, 1, d) for d in (5, 2, 9)])
    assert store_scan(store).count() == 3


def test_unite_stores_fills_missing_columns(rows):
    one = unite_stores({"a": rows([(1, 2)], "x int, y int"), "b": rows([(3)], "x int")})
    assert sorted((r.store, r.x, r.y) for r in one.collect()) == [("a", 1, 2), ("b", 3, None)]


def resource_log(rows):
    made = [
        ("P", "1", 1, 0, '{"s":"a"}'),
        ("P", "1", 2, 0, '{"s":"b"}'),
        ("P", "1", 2, 1, '{"s":"c","t":{"u":[5]}}'),
        ("P", "2", 1, 0, '{"s":"c"}'),
        ("Q", "1", 1, 0, '{"s":"c"}'),
    ]
    return rows(made, "resource_type string, id string, version long, seq long, body string")


def test_current_resources(rows):
    got = {(r.resource_type, r.id): r.body for r in current_resources(resource_log(rows)).collect()}
    assert got == {
        ("P", "1"): '{"s":"c","t":{"u":[5]}}',
        ("P", "2"): '{"s":"c"}',
        ("Q", "1"): '{"s":"c"}',
    }


def test_read_and_search(rows):
    log = resource_log(rows)
    assert [r.seq for r in read_resource(log, "P", "1").collect()] == [1]
    assert search_resources(log, "P").count() == 2
    assert search_resources(log, "P", {}).count() == 2
    assert search_resources(log, "P", {"s": "a"}).count() == 0
    assert [r.id for r in search_resources(log, "P", {"s": "c", "t.u[0]": "5"}).collect()] == ["1"]
    with pytest.raises(ValueError, match="bad search field"):
        search_resources(log, "P", {"a'b": "x"})


def test_deleted_messages(spark, rows, tmp_path):
    log = rows([("a", 1, "x"), ("b", 1, "y"), ("b", 5, "z"), ("c", 2, "w")],
               "name string, seq long, data string")
    path = str(tmp_path / "tombstones")
    delete_messages(rows([("a", 2), ("b", 3)], "name string, seq long"), path, 0)
    live = current_messages(log, spark.read.parquet(path).select("name", "seq"))
    assert sorted((r.name, r.data) for r in live.collect()) == [("b", "z"), ("c", "w")]


def test_ingest(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    df = rows([("n", "x", {"a": "b"}), ("m", "", {}), ("k", None, {}), ("j", "bad", {})],
              "name string, data string, labels map<string,string>")
    rejected = ingest_messages(df, path, 0, valid=F.col("data") != "bad")
    assert sorted(str(r.dataElement) for r in rejected.collect()) == ["", "None", "bad"]
    stored = spark.read.parquet(path)
    assert stored.columns == ["data", "labels", "batch_id"]
    assert [r.data for r in stored.collect()] == ["x"]
    with pytest.raises(NotImplementedError):
        ingest_messages(df, path, 1, method="BATCH_IMPORT")
