"""A store with a client of its own as a data source."""

import datetime as dt
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from clinflow.operators.store import read_stores, scan
from clinflow.sources.stores import micros, read_store, slices_between

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY = 86_400_000_000
START = micros(dt.datetime(2024, 1, 1))
SCHEMA = "store string, name string, data string, send_time timestamp_ntz"


class Hourly:
    """A message an hour for ten days, alternately in two stores; what is read is in its data."""

    def __init__(self, empty=False):
        self.empty = empty

    def bounds(self):
        return None if self.empty else (START, START + 239 * DAY // 24 + 1)

    def read(self, start, end, names):
        hours = [h for h in range(240) if start <= START + h * DAY // 24 < end]
        hours = [h for h in hours if names is None or "ab"[h % 2] in names]
        asked = f"{(end - start) / DAY:g} days of {names}"
        at = [START + h * DAY // 24 for h in hours]
        columns = [["ab"[h % 2] for h in hours], [str(h) for h in hours], [asked] * len(hours)]
        arrays = [pa.array(c, pa.string()) for c in columns] + [pa.array(at, pa.timestamp("us"))]
        yield pa.RecordBatch.from_arrays(arrays, names=["store", "name", "data", "send_time"])


def test_slices_cover_a_span():
    found = slices_between(START + 5, START + 2 * DAY + 7)
    assert found == [(START + 5, START + DAY), (START + DAY, START + 2 * DAY), (START + 2 * DAY, START + 2 * DAY + 7)]
    assert slices_between(3, 3) == [] and slices_between(-1, 1) == [(-1, 0), (0, 1)]


def test_a_partition_per_slice_and_filters_reach_the_source(spark):
    store = read_store(spark, "hourly", Hourly, SCHEMA)
    assert store.count() == 240 and store.rdd.getNumPartitions() == 10
    some = read_stores(scan(store, "2024-01-03T12:00:00", "2024-01-05T06:00:00"), ["a"])
    assert some.rdd.getNumPartitions() == 3
    rows = some.collect()
    assert sorted(int(r.name) for r in rows) == list(range(60, 102, 2))
    assert {r.data for r in rows} == {"0.5 days of ['a']", "1 days of ['a']", "0.25 days of ['a']"}
    odd = scan(store, where=F.col("name").cast("int") > 200)
    assert odd.count() == 39
    after = store.filter("send_time > timestamp_ntz'2024-01-10 22:00:00' AND send_time <= timestamp_ntz'2024-01-10 23:00:00'")
    assert [r.name for r in after.collect()] == ["239"]
    assert store.filter("store = 'a' AND store IN ('b')").count() == 0


def test_uneven_slices_and_an_empty_store(spark):
    uneven = [(START, START + DAY // 24), (START + DAY // 24, START + 10 * DAY)]
    store = read_store(spark, "uneven", Hourly, SCHEMA, uneven)
    assert store.rdd.getNumPartitions() == 2 and store.count() == 240
    none = read_store(spark, "empty", lambda: Hourly(True), SCHEMA)
    assert none.collect() == [] and scan(none, "2024-01-01T00:00:00").count() == 0
