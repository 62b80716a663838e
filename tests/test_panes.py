"""Panes that timers close, in a stream that gets its rows bit by bit."""

import time

import pandas as pd
from pyspark.sql import functions as F

from clinflow.sinks.files import write_folders
from clinflow.streaming.panes import counted_panes, counting, holding, start_pane_sink, until_panes_closed

SCHEMA = "ts timestamp, step string, value string"
FAST = {"processingTime": "200 milliseconds"}


def add(spark, folder, n, rows):
    df = spark.createDataFrame(rows, "ts string, step string, value string")
    df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"{folder}/part={n}")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(folder)


def test_each_pane_is_handed_on_once_and_forgotten(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = [("2024-01-01 00:00:01", "a", "x")] * 3 + [("2024-01-01 00:00:02", "b", "y"), ("2024-01-01 00:00:07", "a", "z")]
    add(spark, folder, 0, first)
    panes = counted_panes(stream(spark, folder), "ts", "step", delay=500)
    query = (
        panes.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(**FAST)
        .start()
    )
    deadline = time.monotonic() + 120
    while time.monotonic() < deadline and spark.read.schema("n_errors long").parquet(out).count() < 3:
        time.sleep(0.2)
    add(spark, folder, 1, [("2024-01-01 00:00:03", "a", "late")] * 2)
    while time.monotonic() < deadline and not any(p["numInputRows"] == 2 for p in query.recentProgress):
        time.sleep(0.2)
    until_panes_closed(query, 60)
    found = spark.read.parquet(out).select(F.unix_seconds("window_start").alias("w"), "step", "pane", "n_errors").collect()
    base = min(r.w for r in found)
    sizes = sorted((r.w - base, r.step, r.n_errors) for r in found)
    assert sizes == [(0, "a", 2), (0, "a", 3), (0, "b", 1), (5, "a", 1)]
    ours = sorted((r.pane, r.n_errors) for r in found if r.step == "a" and r.w == base)
    assert [n for _, n in ours] == [3, 2]


def test_lines_lie_in_folders_of_their_windows_whatever_the_zone(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [("2024-01-01 00:00:01", "a", "one"), ("2024-01-01 00:00:09", "a", "two"), ("2024-01-01 00:00:09", "a", None)]
    add(spark, folder, 0, rows)
    query = start_pane_sink(stream(spark, folder), str(tmp_path / "out"), str(tmp_path / "c"), delay=300, shards=2, trigger=FAST)
    until_panes_closed(query, 60)
    found = spark.read.option("basePath", str(tmp_path / "out")).text(str(tmp_path / "out"))
    lines = sorted((r.window, r.value) for r in found.select(F.col("window").cast("string").alias("window"), "value").collect())
    assert lines == [("2024-01-01T00-00-00", "one"), ("2024-01-01T00-00-05", ""), ("2024-01-01T00-00-05", "two")]


def test_a_window_has_one_file_and_a_repeated_batch_replaces_it(spark, tmp_path):
    lines = spark.range(0, 60, 1, 6).selectExpr("concat('window=', id % 3) AS folder", "concat('l', id) AS value")
    for _ in range(2):
        write_folders(lines, str(tmp_path / "out"), 4)
    files = sorted(p.relative_to(tmp_path / "out").parent.as_posix() for p in tmp_path.glob("out/**/*.txt"))
    assert files == [f"batch_id=4/window={i}" for i in range(3)]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == sorted(f"l{i}" for i in range(60))


class State:
    """A bucket's state with a clock of the test's own."""

    def __init__(self):
        self.now, self.kept, self.timer, self.hasTimedOut = 1000, None, None, False

    exists = property(lambda self: self.kept is not None)
    get = property(lambda self: self.kept)

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.kept = value

    def remove(self):
        self.kept = None

    def setTimeoutDuration(self, ms):
        self.timer = ms


def test_a_bucket_holds_many_panes_and_hands_them_on_beside_new_rows():
    state, run = State(), counting(500)
    rows = pd.DataFrame({"window_start": [0, 0, 5, 5], "step": ["a", "a", "a", None]})
    assert list(run((1,), iter([rows]), state)) == [] and state.timer == 500
    state.now = 1400  # another window, while the first panes are open
    assert list(run((1,), iter([pd.DataFrame({"window_start": [9, 0], "step": ["a", "a"]})]), state)) == []
    assert state.timer == 100
    state.now = 1600  # rows come when the panes' time is over: these are handed on, and a new one opens
    out = pd.concat(run((1,), iter([rows[:1]]), state))
    assert sorted(zip(out["window_start"], out["step"].fillna(""), out["n_errors"])) == [(0, "a", 3), (5, "", 1), (5, "a", 1)]
    state.now, state.hasTimedOut = 2200, True
    out = pd.concat(run((1,), iter([]), state))
    assert sorted(zip(out["window_start"], out["pane"], out["n_errors"])) == [(0, 2100, 1), (9, 1900, 1)]
    assert not state.exists


def test_lines_of_a_bucket_keep_to_their_windows():
    state, run = State(), holding(500)
    rows = pd.DataFrame({"window_start": [0, 5, 0], "value": ["x", "y", ""]})
    assert list(run((1,), iter([rows]), state)) == []
    state.now, state.hasTimedOut = 1500, True
    out = pd.concat(run((1,), iter([]), state))
    assert sorted(zip(out["window_start"], out["value"])) == [(0, ""), (0, "x"), (5, "y")]
    assert not state.exists
