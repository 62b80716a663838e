import json
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from clinflow.operators.guarded import OfRow, guarded_map
from clinflow.operators.outcomes import checked, error_entry, split_ok, to_io_error_rows
from clinflow.schemas import IO_ERROR_ROW
from clinflow.sinks.bundles import (
    check_bundles,
    checked_resources,
    execute_bundles,
    post_bundles,
    resource_rows,
)
from clinflow.sinks.errors import (
    IMAGING_FEED_SHARDS,
    MAX_BYTES_PER_SHARD,
    MAX_ROWS_PER_SHARD,
    MESSAGE_FEED_SHARDS,
    shard_count,
    write_dead_letter_table,
    write_error_entries,
    write_io_errors,
    write_text_shards,
)
from clinflow.sinks.files import list_files, remove_files, remove_listed, write_batch

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def files(path):
    return sorted(p for p in path.rglob("part-*") if p.is_file())


def test_shard_defaults_and_growth():
    assert (MESSAGE_FEED_SHARDS, IMAGING_FEED_SHARDS) == (10, 1)
    assert shard_count(0, 0, 1) == 1
    assert shard_count(5, 50, 10) == 10
    assert shard_count(3 * MAX_ROWS_PER_SHARD + 1, 0, 1) == 4
    assert shard_count(3, 7 * MAX_BYTES_PER_SHARD, 2) == 7
    with pytest.raises(ValueError, match="shard"):
        shard_count(1, 1, 0)


def test_shards_and_repeated_batches(spark, tmp_path):
    lines = spark.range(100).select(F.col("id").cast("string").alias("value"))
    for _ in range(2):
        write_text_shards(lines, str(tmp_path / "e"), 3, 4)
    assert len(files(tmp_path / "e" / "batch_id=3")) == 4
    assert spark.read.text(str(tmp_path / "e")).count() == 100


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(spark.range(3), path, 0)
    write_batch(spark.range(5), path, 0)
    write_batch(spark.range(2), path, 1)
    assert spark.read.parquet(path).count() == 7


def test_error_files_are_json_lines(spark, rows, tmp_path):
    _, bad = split_ok(checked(rows([1, 2], "v int"), F.lit(False), error_entry("m", "s")))
    write_error_entries(bad, str(tmp_path / "e"), shards=1)
    (file,) = files(tmp_path / "e")
    line = json.loads(file.read_text().splitlines()[0])
    assert line["step"] == "s"
    assert line["sources"] == []
    io = to_io_error_rows(rows(["x"], "v string"), F.col("v"), F.lit("m"))
    write_io_errors(io, str(tmp_path / "io"))
    (line,) = [json.loads(t) for f in files(tmp_path / "io") for t in f.read_text().splitlines()]
    assert set(line) == set(IO_ERROR_ROW.fieldNames())
    assert line["statusCode"] is None


def test_dead_letter_table_is_partitioned_by_day(spark, rows, tmp_path):
    io = to_io_error_rows(
        rows([("x", "2024-01-01 23:59:59"), ("y", "2024-01-02 00:00:00")], "v string, t string"),
        F.col("v"),
        F.lit("m"),
        observed=F.col("t").cast("timestamp"),
    )
    write_dead_letter_table(io, str(tmp_path / "d"))
    write_dead_letter_table(io, str(tmp_path / "d"))
    assert sorted(p.name for p in (tmp_path / "d").glob("observed_date=*")) == [
        "observed_date=2024-01-01",
        "observed_date=2024-01-02",
    ]
    assert spark.read.parquet(str(tmp_path / "d")).count() == 4


def test_only_listed_files_are_removed(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).write_text("1")
    files = list_files(spark, str(tmp_path))
    (tmp_path / "c").write_text("1")
    remove_listed(spark, [*files, str(tmp_path / "nowhere")])
    assert [p.name for p in tmp_path.iterdir()] == ["c"]


def test_remove_files(spark, tmp_path):
    (tmp_path / "x").write_text("1")
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "z").write_text("1")
    assert remove_files(spark, f"{tmp_path}//") == 2
    assert remove_files(spark, str(tmp_path)) == 0
    assert remove_files(spark, str(tmp_path / "nowhere")) == 0


BUNDLE = '{"entry":[{"resource":{"resourceType":"A","id":"1"},"request":{"method":"PUT","url":"A"}}]}'


def test_execute_bundles(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    failed = execute_bundles(rows([BUNDLE, "{", None], "output string"), path, 0).collect()
    assert sorted(str(r.dataElement) for r in failed) == ["None", "{"]
    assert all(r.statusCode is None for r in failed)
    assert [r.bundle for r in spark.read.parquet(path).collect()] == [BUNDLE]


def test_resource_rows(rows):
    without_id = '{"entry":[{"resource":{"a":1},"request":{"method":"PUT","url":"B/x"}}]}'
    other = '{"entry":[{"resource":{"a":1},"request":{"method":"DELETE","url":"B/x"}}]}'
    df = rows([(b, 1, 2) for b in (BUNDLE, without_id, other)], "b string, v long, s long")
    got = sorted((r.resource_type, r.id) for r in resource_rows(df, "b", "v", "s").collect())
    assert got == [("A", "1"), ("B", "x")]


def test_the_url_names_a_resource_first(rows):
    def entry(resource, url):
        return json.dumps({"entry": [{"resource": resource, "request": {"method": "PUT", "url": url}}]})

    bundles = [entry({"resourceType": "A", "id": "1"}, "A/2"), entry({"resourceType": "A", "id": "1"}, "A"),
               entry({"a": 1}, "B"), entry({"resourceType": "C"}, "/C/9/_history/1")]
    df = rows([(b, 1, 2) for b in bundles], "b string, v long, s long")
    got = sorted((r.resource_type, r.id) for r in resource_rows(df, "b", "v", "s").collect())
    assert [g for g in got if g[0] != "B"] == [("A", "1"), ("A", "2"), ("C", "9")]
    assert len(got[2][1]) == 64


def test_entries_that_can_not_be_written_are_rejected(rows):
    post = '{"entry":[{"resource":{"a":1},"request":{"method":"POST","url":"B"}}]}'
    bare = '{"entry":[{"resource":{"resourceType":"A"}}]}'
    empty = '{"entry":[{"request":{"method":"PUT","url":"A/1"}}]}'
    bundles = [BUNDLE, post, bare, empty, "{", "{}", '{"entry":5}', None, '{"entry":[]}']
    df = rows([(b, 1, 2) for b in bundles], "b string, v long, s long")
    good, bad = split_ok(checked_resources(df, "b", "v", "s"))
    assert good.count() == 1
    causes = sorted(r.error.error_message for r in bad.collect())
    assert causes == sorted(
        ["the entry is not a PUT"] * 2 + ["the entry has no resource"]
        + ["the bundle is not valid JSON"] * 2 + ["the bundle has no list of entries"] * 2
    )


def client():
    def send(batch):
        if (batch["output"] == "boom").any():
            raise OSError("no connection")
        status = [503 if "bad" in o else 201 for o in batch["output"]]
        return batch.assign(status=status, reply="r")

    return send


def test_post_bundles(rows):
    sent = post_bundles(rows(["a", "bad", "boom", "b"], "output string"), client)
    got = {r.output: (r.ok, r.status, r.error and r.error.error_message) for r in sent.collect()}
    assert got == {
        "a": (True, 201, None),
        "b": (True, 201, None),
        "bad": (False, 503, "r"),
        "boom": (False, None, "no connection"),
    }


def test_nothing_is_sent_twice(spark, rows, tmp_path):
    def make():
        def send(batch):
            (body,) = batch["output"]
            with open(tmp_path / "sent", "a") as file:
                file.write(f"{body}\n")
            if body.startswith("bad"):
                raise OSError("no")
            return batch.assign(status=200, reply="r")

        return send

    bodies = [f"bad{i}" if i % 5 == 0 else f"b{i}" for i in range(30)]
    sent = post_bundles(rows(bodies, "output string").coalesce(1), make)
    assert sent.filter("ok").count() == 24
    assert sorted((tmp_path / "sent").read_text().split()) == sorted(bodies)


def test_bodies_are_sent_as_plain_rows_too(rows, tmp_path):
    def make():
        def send(row):
            with open(tmp_path / "sent", "a") as file:
                file.write(f"{row['output']}\n")
            if row["output"] == "boom":
                raise OSError("no connection")
            return ("many", "r") if row["output"] == "odd" else (503 if "bad" in row["output"] else 201, "r")

        return OfRow(send)

    bodies = ["a", "bad", "boom", "odd", "b"]
    sent = post_bundles(rows(bodies, "output string").coalesce(1), make, keep=()).collect()
    got = {r.output: (r.ok, r.status, r.reply) for r in sent}
    nothing = (False, None, None)
    assert got == {"a": (True, 201, "r"), "b": (True, 201, "r"), "bad": (False, 503, "r"), "boom": nothing, "odd": nothing}
    assert {r.output: r.error and r.error.error_message for r in sent}["boom"] == "no connection"
    assert sorted((tmp_path / "sent").read_text().split()) == sorted(bodies)


def test_the_clients_of_the_queries_make_no_frame_per_body():
    from clinflow.plans.mapping import refusing_client
    from clinflow.plans.streams import _refusing_odd

    assert refusing_client().call({"output": '{"visits":4}'}) == (200, "stored")
    assert _refusing_odd().call({"output": '{"id":7}'}) == (422, "refused")


def test_check_bundles(rows):
    got = check_bundles(rows(["{}", "5", "{", None], "output string")).collect()
    assert [r.ok for r in got] == [True, True, False, False]


def halver():
    def run(batch):
        if (batch["v"] % 7 == 0).any():
            raise KeyError("seven")
        if (batch["v"] % 5 == 0).any():
            raise ValueError("five")
        return batch.assign(h=batch["v"] / 2)[["h"]]

    return run


def test_guarded_map_rejects_only_bad_rows(spark):
    out = guarded_map(
        spark.range(1, 101, 1, 3).withColumnRenamed("id", "v"),
        halver,
        spark.createDataFrame([], "h double").schema,
        "Halve",
        resource="v",
        sources="v",
        recoverable=("ValueError",),
    )
    collected = out.collect()
    assert sorted(r.v for r in collected) == list(range(1, 101))
    for r in collected:
        if r.v % 7 == 0:
            assert (r.ok, r.fatal, r.h) == (False, True, None)
            assert "KeyError" in r.error.stack_trace
        elif r.v % 5 == 0:
            assert (r.ok, r.fatal, r.error.sources) == (False, False, [str(r.v)])
            assert r.error.error_message == "five"
        else:
            assert (r.ok, r.h, r.error) == (True, r.v / 2, None)


def test_large_integers_beside_missing_ones_stay_exact(rows):
    large = 2**53 + 1

    def make():
        def run(batch):
            if (batch["k"] == 3).any():
                raise ValueError("three")
            return pd.DataFrame({"out": batch["v"].fillna(large)})

        return run

    df = rows([(1, large), (2, None), (3, large), (4, large)], "k int, v long").coalesce(1)
    out = guarded_map(df, make, df.selectExpr("v AS out").schema, "s").collect()
    assert [(r.k, r.v, r.out) for r in out] == [
        (1, large, large), (2, None, large), (3, large, None), (4, large, large)
    ]


def test_guarded_map_needs_new_columns(spark):
    with pytest.raises(ValueError, match="input columns"):
        guarded_map(spark.range(1), halver, spark.range(1).schema, "s")
