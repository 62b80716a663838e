import pytest

from clinflow.operators.feed import feed_outcomes, route_by_type, wrap_message
from clinflow.operators.mapping import Mapping, root
from clinflow.operators.tables import run_queries, to_json_rows
from clinflow.session import stream_table, work_base, work_dir, work_folder, written


def test_row_golden(rows):
    df = rows([("first street", "abc")], "address string, id string")
    assert to_json_rows(df, "Patient").first().document == (
        '{"Patient":{"address":"first street","id":"abc"}}'
    )


def test_run_queries(spark):
    out = run_queries(spark, {"A": "SELECT 1 AS x", "B": "SELECT 'y' AS `a.b`, NULL AS n"})
    assert sorted(tuple(r) for r in out.collect()) == [
        ("A", '{"A":{"x":1}}'), ("B", '{"B":{"a.b":"y"}}'),
    ]
    with pytest.raises(ValueError, match="no queries"):
        run_queries(spark, {})


def test_routing(rows):
    merged = '{"type":"ENTITIES_MERGED"'
    expected = {
        '{"type":"X"}': (True, None),
        '{"type":7}': (True, None),
        '{"type":null}': (False, None),
        "{}": (False, None),
        "[]": (False, None),
        "x": (False, None),
        merged + ',"uris":[]}': (True, None),
        merged + ',"uris":["a"]}': (True, None),
        merged + ',"uris":["a","b"]}': (True, "a"),
        merged + ',"uris":[1,"b"]}': (True, "1"),
        merged + ',"uris":[null,"b"]}': (False, None),
        merged + ',"uris":[{"x":1},"b"]}': (False, None),
        merged + ',"uris":"a"}': (False, None),
        merged + ',"uris":null}': (False, None),
        merged + "}": (False, None),
    }
    routed = route_by_type(rows(list(expected), "value string"))
    assert {r.value: (r.ok, r.uri) for r in routed.collect()} == expected


def test_outcomes_keep_every_row(rows):
    types = rows([("a", "HCP")], "uri string, entity_type string")
    values = ['{"type":"X","n":1.50}', "x", None, '{"type":"ENTITIES_MERGED","uris":["a","b"]}']
    mapping = Mapping([root("", "out")])
    got = feed_outcomes(rows(values, "value string"), types, mapping).collect()
    assert [(r.failed_stage, r.output, r.error is None) for r in got] == [
        (None, '{"out":{"n":1.5,"type":"X"}}', True),
        ("read", None, False),
        ("read", None, False),
        (None, '{"out":{"mergedEntityType":"HCP","type":"ENTITIES_MERGED","uris":["a","b"]}}',
         True),
    ]


def test_wrapped_message_has_the_constant_id(rows):
    r = wrap_message(rows([' { "a" : 1 } '], "t string"), "t").first()
    assert (r.id, r.data) == ('"input"', '{"a":1}')


def test_work_folders_are_fresh_and_shared(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert work_base(spark) == base.rstrip("/")
    assert work_dir(spark, "x") != work_dir(spark, "x")
    assert work_dir(spark, "x").startswith(f"{work_folder(spark)}/x-")
    assert work_folder(spark).startswith(f"{work_base(spark)}/")


def test_written_tables_are_read_back(spark, tmp_path):
    df = written(spark.range(3), str(tmp_path / "t"))
    assert df.count() == 3
    assert "FileScan" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts", [1, 2])
def test_tables_of_one_file_and_of_many_are_streams(spark, tmp_path, parts):
    if parts == 1:
        spark.range(4).toPandas().to_parquet(tmp_path / "t.parquet")
    else:
        spark.range(4).repartition(parts).write.parquet(str(tmp_path / "t.parquet"))
    spark.range(9).write.parquet(str(tmp_path / "other.parquet"))
    stream_table(spark, str(tmp_path), "t").writeStream.format("parquet").option(
        "path", str(tmp_path / "o")
    ).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True
    ).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 4
