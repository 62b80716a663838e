"""Repeated notifications, and the index that searches of resources use."""

import time

from pyspark.sql import functions as F

from clinflow.operators.resources import current_resources, search_resources
from clinflow.sinks.current_view import ROW, CurrentView
from clinflow.sinks.field_index import IndexedView
from clinflow.sources.notifications import delivered_once


def test_repeats_are_dropped_and_old_ids_forgotten(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def add(n, rows):
        spark.createDataFrame(rows, "id string, v int").coalesce(1).write.parquet(f"{folder}/p={n}")

    add(0, [("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1)])
    stream = spark.readStream.schema("id string, v int").option("recursiveFileLookup", "true").parquet(folder)
    once = delivered_once(stream, "id", "2 seconds").writeStream.format("parquet").option("path", out)
    query = once.option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        query.processAllAvailable()
        add(1, [("a", 2), ("c", 1)])
        query.processAllAvailable()
        time.sleep(3)
        for n in (2, 3):  # a batch moves the watermark for the next one
            add(n, [(f"later{n}", 1)])
            query.processAllAvailable()
            time.sleep(0.5)
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
        add(4, [("a", 3)])
        query.processAllAvailable()
    finally:
        query.stop()
    found = sorted((r.id or "", r.v) for r in spark.read.parquet(out).collect())
    assert found == [("", 1), ("", 1), ("a", 1), ("a", 3), ("b", 1), ("c", 1), ("later2", 1), ("later3", 1)]


def rows(spark, values):
    return spark.createDataFrame([(t, i, v, 0, b) for t, i, v, b in values], ROW)


def test_search_reads_the_buckets_with_hits(spark, tmp_path):
    path = str(tmp_path / "x")
    index = IndexedView(spark, path, ["status", "name.given"], CurrentView(spark, f"{path}/view", buckets=16), buckets=8)
    first = [("P", str(i), 1, f'{{"status":"{"off" if i else "on"}","name":{{"given":"n{i % 2}"}}}}') for i in range(60)]
    second = [("P", "0", 2, '{"status":"off"}'), ("P", "7", 2, '{"status":"on","n":7}'), ("Q", "9", 1, '{"status":"on"}')]
    second += [("P", "8", 2, "no json"), ("P", "x", 1, None), ("P", "y", 1, '{"status":null}')]
    index.append(rows(spark, first), 0)
    for _ in range(2):
        index.append(rows(spark, second), 1)
    log = rows(spark, first + second)
    for wanted in ({"status": "on"}, {"status": "off", "name.given": "n1"}, {"status": "off", "n": "7"}, {"n": "7"}, {}):
        assert sorted(index.search("P", wanted).collect()) == sorted(search_resources(log, "P", wanted).collect())
    assert index.search("P", {"status": "never"}).collect() == []
    assert [r.id for r in index.search("Q", {"status": "on"}).collect()] == ["9"]
    hit = {f.split("/bucket=")[1].split("/")[0] for f in index.search("P", {"status": "on"}).inputFiles() if "/view/" in f}
    assert len(hit) <= 2  # of "0", which had the value, and of "7"
    assert index.view.read().count() == current_resources(log).count()
    assert index.view.read().filter(F.col("id") == "0").first().version == 2
