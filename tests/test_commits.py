"""Committed batches and the current view that is kept up with them."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.operators.resources import current_resources
from clinflow.sinks import commits
from clinflow.sinks.commits import KEPT_STATES, CommitLog, append_committed, read_committed
from clinflow.sinks.current_view import ROW, CurrentView
from clinflow.sinks.files import list_files

LONG = T.StructType().add("id", "long")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_batch_is_seen_once_it_is_committed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert ids(read_committed(spark, path, LONG)) == []
    append_committed(spark.range(3), path, 0)

    def dies(*_):
        raise OSError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", dies)
        with pytest.raises(OSError):
            append_committed(spark.range(10, 12), path, 1)
    assert ids(read_committed(spark, path, LONG)) == [0, 1, 2]
    append_committed(spark.range(10, 12), path, 1)
    append_committed(spark.range(10, 12), path, 1)
    found = read_committed(spark, path, LONG)
    assert ids(found) == [0, 1, 2, 10, 11]
    assert sorted(r.batch_id for r in found.collect()) == [0, 0, 0, 1, 1]
    assert CommitLog(spark, path).clean() == 1
    assert ids(read_committed(spark, path, LONG)) == [0, 1, 2, 10, 11]


def test_a_reader_keeps_the_state_it_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    append_committed(spark.range(2), path, 0)
    early = read_committed(spark, path, LONG)
    append_committed(spark.range(5, 7), path, 1)
    assert ids(early) == [0, 1] and ids(read_committed(spark, path, LONG)) == [0, 1, 5, 6]


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    before = log.state()
    log.commit(before, {"a": 1}, 0)
    with pytest.raises(RuntimeError):
        log.commit(before, {"b": 1}, 0)


def test_the_log_is_read_from_the_last_whole_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "WHOLE_EVERY", 4)
    log = CommitLog(spark, str(tmp_path / "t"))
    state, expected = log.state(), {}
    for n in range(3 * KEPT_STATES):
        expected = {f: s for f, s in expected.items() if f != f"f{n - 3}"} | {f"f{n}": n}
        state = log.commit(state, expected, n)
        assert log.state() == state and state.batch == n
    log.clean()
    assert log.state() == state
    assert KEPT_STATES <= len(list_files(spark, f"{log.path}/log")) < KEPT_STATES + 4


def log_rows(spark, rows):
    return spark.createDataFrame([("P", i, v, s, b) for i, v, s, b in rows], ROW)


def current(df):
    return sorted(tuple(r) for r in df.select("id", "version", "seq", "body").collect())


@pytest.mark.parametrize("run_bytes", [0, 300, 10**9])
def test_view_equals_the_newest_of_the_whole_log(spark, tmp_path, run_bytes):
    """Whether runs are merged at once, now and then, or never."""
    view = CurrentView(spark, str(tmp_path / "v"), buckets=4, run_bytes=run_bytes)
    assert view.read().collect() == []
    batches = [
        [("a", 5, 0, "a5"), ("b", 1, 0, "b1"), ("a", 2, 9, "a2"), ("c", 1, 1, "c")],
        [("a", 4, 9, "late"), ("b", 1, 2, "b2"), ("d", -3, 0, "d")],
        [("a", 5, 0, "again"), ("e", 1, 0, None), ("d", -3, -1, "older")],
        [("a", 6, 0, "a6"), ("é/x=1", 1, 0, "odd")],
    ]
    seen = []
    for n, batch in enumerate(batches):
        view.append(log_rows(spark, batch), n)
        view.append(log_rows(spark, batch), n)  # repeated after a failure
        seen += [r for r in batch if r[3] != "again"]  # of equal versions the first stays
        assert current(view.read()) == current(current_resources(log_rows(spark, seen)))
    view.compact()
    assert current(view.read()) == current(current_resources(log_rows(spark, seen)))
    assert current(view.lookup("P", "a")) == [("a", 6, 0, "a6")] and current(view.lookup("P", "z")) == []
    assert view.log.clean() >= 0 and len(view.read().collect()) == 6


def bucket_files(spark, view):
    return {f: sorted(list_files(spark, f"{view.log.data}/{f}")) for f in view.log.state().folders}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    view = CurrentView(spark, str(tmp_path / "v"), buckets=8)
    rows = spark.range(200).select(
        F.lit("P").alias("resource_type"),
        F.col("id").cast("string").alias("id"),
        F.lit(1).cast("long").alias("version"),
        F.lit(0).cast("long").alias("seq"),
        F.lit("{}").alias("body"),
    )
    view.append(rows, 0)
    view.compact()
    before = bucket_files(spark, view)
    assert len(before) == 8
    view.append(rows.filter("id = '7'").withColumn("version", F.lit(2).cast("long")), 1)
    view.compact()
    after = bucket_files(spark, view)
    assert len(after) == 8 and sum(before.get(f) == files for f, files in after.items()) == 7


def test_bodies_are_not_moved_to_be_read(spark, tmp_path):
    view = CurrentView(spark, str(tmp_path / "v"), buckets=4)
    view.append(log_rows(spark, [("a", 1, 0, "x"), ("b", 1, 0, "y")]), 0)
    view.compact()
    view.append(log_rows(spark, [("a", 2, 0, "z")]), 1)
    plan = view.read()._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange" in line or "Sort" in line:
            assert "body" not in line
    one = view.lookup("P", "a")
    assert all("/bucket=" in f for f in one.inputFiles())
    assert len({f.split("/bucket=")[1].split("/")[0] for f in one.inputFiles()}) == 1
