"""Slices by density, and the join of points with uneven intervals."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from clinflow.operators.intervals import interval_join
from clinflow.operators.store import density_scan, density_slices, hour_counts, with_density_slice

HOUR = 3_600_000


def messages(spark, rows):
    """Rows of (store, milliseconds or None)."""
    named = [(s, ms, f"{s}/{i}") for i, (s, ms) in enumerate(rows)]
    df = spark.createDataFrame(named, "store string, ms long, name string")
    return df.select("store", "name", F.timestamp_millis("ms").alias("send_time"), "ms")


def test_dense_days_are_cut_and_thin_days_share_a_slice(spark):
    rng = random.Random(1)
    rows = [("s", rng.randrange(30 * 24 * HOUR)) for _ in range(600)]
    rows += [("s", 10 * 24 * HOUR + rng.randrange(24 * HOUR)) for _ in range(6000)]
    rows += [("t", rng.randrange(5 * HOUR)) for _ in range(50)]
    df = messages(spark, rows)
    slices = density_slices(hour_counts(df, ["store"]), ["store"]).orderBy("store", "slice_id").collect()
    ours = [r for r in slices if r.store == "s"]
    sizes = [r.n_messages for r in ours]
    assert sum(sizes) == 6600 and max(sizes) <= 2 * statistics.median(sizes) + 1
    assert all(a.slice_to == b.slice_from for a, b in zip(ours, ours[1:]))
    assert min(r.slice_to - r.slice_from for r in ours[1:-1]) >= HOUR
    assert ours[0].slice_from == min(m for s, m in rows if s == "s")
    assert ours[-1].slice_to == max(m for s, m in rows if s == "s") + 1
    assert max(r.slice_to - r.slice_from for r in ours) > 24 * HOUR
    assert [r.slice_id for r in ours] == list(range(len(ours)))
    counted = {(r.store, r.slice_id): r["count"] for r in density_scan(df).groupBy("store", "slice_id").count().collect()}
    assert counted == {(r.store, r.slice_id): r.n_messages for r in slices}


def test_slices_are_no_longer_than_asked_for(spark):
    import datetime as dt

    df = messages(spark, [("s", day * 24 * HOUR) for day in range(20)])
    hours = hour_counts(df, ["store"])
    assert density_slices(hours, ["store"], 1000).count() == 1
    assert density_slices(hours, ["store"], 1000, longest=dt.timedelta(days=5)).count() == 4
    assert density_slices(hours, ["store"], 1).count() == 20


def test_messages_without_a_time_or_a_store(spark):
    df = messages(spark, [("s", 5), ("s", None), (None, 7), ("u", None)])
    slices = density_slices(hour_counts(df, ["store"]), ["store"])
    found = with_density_slice(df, slices, ["store"])
    assert sorted((r.store or "", r.ms or 0, r.slice_id) for r in found.collect()) == [
        ("", 7, 0), ("s", 0, 0), ("s", 5, 0), ("u", 0, 0)
    ]
    assert hour_counts(df.limit(0), ["store"]).count() == 0


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_interval_join(spark, width):
    rng = random.Random(width)
    points = [(rng.choice("ab"), rng.randrange(-50, 150)) for _ in range(300)] + [("a", None), (None, 3)]
    spans = [(rng.choice(("a", "b", None)), i, s, s + rng.choice((0, 1, 5, 60))) for i, s in enumerate(range(-40, 120, 9))]
    left = spark.createDataFrame(points, "k string, at long")
    right = spark.createDataFrame(spans, "k string, id int, start long, stop long")
    got = interval_join(left, right, F.col("at"), "start", "stop", width, ["k"])
    expected = sorted(
        (k or "", at, i) for k, at in points for k2, i, s, e in spans if at is not None and k == k2 and s <= at < e
    )
    assert sorted((r.k or "", r.at, r.id) for r in got.collect()) == expected
    assert got.columns == ["k", "at", "id", "start", "stop"]
