"""Every registered query against its SQL in DuckDB, over whole tables."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from clinflow.operators import lookups
from clinflow.plans import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
IDS = {
    f"{letter}{n}"
    for letter, count in {
        "S": 19, "W": 11, "P": 13, "L": 4, "A": 3, "O": 3, "F": 11, "J": 12, "T": 10, "E": 8, "U": 4,
    }.items()
    for n in range(1, count + 1)
}
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def assert_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert not re.search("CartesianProduct|NestedLoopJoin", plan_of(df))
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert {n: TYPES[t] for n, t in df.dtypes} == types

    def canonical(rows, names):
        order = sorted(range(len(names)), key=names.__getitem__)
        return sorted(repr([row[i] for i in order]) for row in rows)

    got = [tuple(r) for r in df.collect()]
    assert canonical(got, df.columns) == canonical(expected, columns)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, duck, name):
    assert_equals_sql(spark, duck, name)


@pytest.mark.parametrize(
    "name",
    ["message_feed_batch", "fetched_messages", "study_rejects", "study_metadata", "imaging_batch",
     "latency_distribution", "form_payloads", "stream_imaging"],
)
def test_query_equals_sql_when_every_table_is_large(spark, duck, monkeypatch, name):
    """No table is broadcast, and keys of 20 rows count as hot."""
    spread_join = lookups.spread_join
    monkeypatch.setattr(lookups, "measured_bytes", lambda *_: None)
    monkeypatch.setattr(
        lookups, "spread_join", lambda left, right, on, how, _: spread_join(left, right, on, how, 20)
    )
    assert_equals_sql(spark, duck, name)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_all_ids_are_covered():
    covered = {i for q in REGISTRY.values() for i in q.covers}
    assert covered - IDS == set()
    assert IDS - covered == set()


def test_queries_read_whole_tables():
    """No query thins out its tables to make the check cheap."""
    for q in REGISTRY.values():
        assert not re.search(r"\b(tablesample|sample|limit \d{2,})\b", q.oracle or "", re.I), q.name


@pytest.mark.parametrize(
    ("name", "exchanges"),
    [("json_gate", 0), ("route_types", 0), ("mapping_rejects", 0), ("resource_current", 1),
     ("message_delete", 1), ("segments_nested", 1), ("error_window_counts", 1),
     ("fetched_messages", 0), ("store_read", 0)],
)
def test_plans_shuffle_no_more_than_needed(spark, name, exchanges):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == exchanges
    assert plan.count("Exchange ") - plan.count("BroadcastExchange ") == exchanges
    assert "Window" not in plan.replace("window", "")
    assert plan.count("parseJson") <= 1


def test_filters_and_columns_reach_the_reader(spark):
    df = entry.queries()["send_time_range"](spark, SF_DIR)
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(ts,2024-01-05T06:00)" in text
    assert "LessThan(ts,2024-01-20T00:00)" in text
    assert "user_id" not in text
