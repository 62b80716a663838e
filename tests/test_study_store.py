"""Studies read by key from a store in buckets."""

import re

from pyspark.sql import functions as F

from clinflow.operators import lookups
from clinflow.operators.studies import read_studies, study_documents
from clinflow.sinks.study_store import INSTANCE, StudyStore

STORE = "projects/p/locations/l/datasets/d/dicomStores/s"


def instances(spark, studies):
    return spark.range(studies).select(
        F.lit(STORE).alias("dicom_store_path"),
        F.col("id").cast("string").alias("study_id"),
        F.explode(F.array(*[F.lit(str(i)) for i in range(3)])).alias("instance_id"),
        F.concat(F.lit('{"n":'), "id", F.lit("}")).alias("metadata"),
    )


def wanted(spark, ids):
    rows = [(STORE, str(i), 1) for i in ids]
    return spark.createDataFrame(rows, "dicom_store_path string, study_id string, n_notifications long")


def kept(df):
    return sorted(map(tuple, df.collect()))


def test_scattered_studies_are_read_from_their_buckets_only(spark, tmp_path):
    store = StudyStore(spark, str(tmp_path / "s"), buckets=32)
    store.append(instances(spark, 400), 0)
    ask = wanted(spark, [0, 399, 200, 1000])
    found = store.of(ask)
    files = {f for f in store.read().inputFiles()}
    opened = {f for f in found.inputFiles() if "/bucket=" in f}
    buckets = {re.search(r"bucket=(\d+)", f)[1] for f in opened}
    assert len(files) == 32 and 0 < len(buckets) <= 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert re.search(r"PushedFilters: \[[^\]]*Or\([^\]]*study_id", plan)
    assert kept(study_documents(store, ask)) == kept(study_documents(instances(spark, 400), ask))


def test_many_studies_and_none(spark, tmp_path):
    store = StudyStore(spark, str(tmp_path / "s"), buckets=8)
    assert store.of(wanted(spark, [1])).collect() == [] and store.read().collect() == []
    store.append(instances(spark, 300), 0)
    many = wanted(spark, range(0, 300, 2))
    assert kept(study_documents(store, many)) == kept(study_documents(instances(spark, 300), many))
    assert store.of(wanted(spark, [])).collect() == []


def test_a_study_that_grows_and_a_batch_that_comes_twice(spark, tmp_path):
    store = StudyStore(spark, str(tmp_path / "s"), buckets=4)
    first = spark.createDataFrame([(STORE, "7", "b", '{"b":1}')], INSTANCE)
    more = spark.createDataFrame([(STORE, "7", "a", '{"a":1}'), (STORE, None, "x", "{}")], INSTANCE)
    for batch, rows in ((0, first), (1, more), (1, more)):
        store.append(rows, batch)
    paths = spark.createDataFrame(
        [(f"{STORE}/dicomWeb/studies/7/series/1/instances/1",), (f"{STORE}/dicomWeb/studies/8/series/1/instances/1",), ("?",)],
        "path string",
    )
    studies, resolved = read_studies(paths, store, scratch=str(tmp_path / "w"))
    assert [r.study for r in studies.collect()] == ['[{"a":1},{"b":1}]']
    assert sorted(r.ok for r in resolved.collect()) == [False, False, True]


def test_runs_of_a_bucket_become_one(spark, tmp_path):
    store = StudyStore(spark, str(tmp_path / "s"), buckets=4)
    for batch in range(3):
        store.append(instances(spark, 40 if batch else 1), batch)
    before = kept(store.read())
    one = [f for f in store.log.state().folders if sum(g.split("/")[0] == f.split("/")[0] for g in store.log.state().folders) < 3]
    store.compact(3)
    folders = store.log.state().folders
    assert kept(store.read()) == before and set(one) <= set(folders)
    assert len(folders) == len(one) + 1
    store.compact(2)
    assert len(store.log.state().folders) == 4 and kept(store.read()) == before
    store.append(instances(spark, 2), 3)
    assert len(kept(store.read())) == len(before) + 6


def test_heavy_studies_are_told_by_the_counts_of_paths(spark, monkeypatch):
    def sampled(*_):
        raise AssertionError("the paths are read again")

    monkeypatch.setattr(lookups, "sampled_counts", sampled)
    store = "projects/p/locations/l/datasets/d/dicomStores/s"
    path = f"concat('{store}/dicomWeb/studies/', id % 4, '/series/1/instances/', id)"
    paths = spark.range(0, 40, 1, 3).selectExpr(f"if(id % 10 = 9, 'none', {path}) AS path")
    known = spark.range(0, 6).selectExpr(
        f"'{store}' AS dicom_store_path", "cast(id % 3 AS string) AS study_id", "cast(id AS string) AS instance_id", "'{}' AS metadata"
    )
    studies, resolved = read_studies(paths, known, broadcast_bytes=0, hot_rows=3)
    assert sorted((r.study_id, r.n_notifications, r.study) for r in studies.collect()) == [
        ("0", 10, "[{},{}]"), ("1", 8, "[{},{}]"), ("2", 10, "[{},{}]")
    ]
    causes = sorted(r.error.error_message if r.error else "" for r in resolved.collect())
    assert causes == [""] * 28 + ["Invalid DICOM web path"] * 4 + ["no metadata for study 3"] * 8
