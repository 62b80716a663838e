import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clinflow.operators.outcomes import (
    StageFailure,
    checked,
    error_entry,
    is_success,
    raise_when,
    report_then_fail,
    split_ok,
    to_error_rows,
    to_io_error_rows,
)
from clinflow.schemas import ERROR_ROW, IO_ERROR_ROW


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=20))
def test_split_is_complete_and_disjoint(rows, values):
    df = rows(values, "v int")
    good, bad = split_ok(checked(df, F.col("v") > 0, error_entry("low", "s")))
    assert sorted(r.v for r in good.collect()) == sorted(v for v in values if v and v > 0)
    assert good.count() + bad.count() == len(values)


def test_split_needs_a_checked_stage(rows):
    with pytest.raises(ValueError, match="lacks"):
        split_ok(rows([1], "v int"))


def test_error_row_golden(rows):
    df = checked(rows([1], "v int"), F.lit(False), error_entry("message", "step1"))
    out = to_error_rows(split_ok(df)[1])
    assert out.schema.fieldNames() == ERROR_ROW.fieldNames()
    r = out.first()
    assert (r.error_message, r.step, r.sources) == ("message", "step1", [])
    assert r.timestamp.endswith("Z")


def test_missing_sources_become_empty(rows):
    entry = error_entry("m", "s").withField("sources", F.lit(None).cast("array<string>"))
    df = rows([1], "v int").withColumn("error", entry)
    assert to_error_rows(df).first().sources == []


def test_io_error_row_schema(rows):
    out = to_io_error_rows(rows(["x"], "v string"), F.col("v"), F.lit("m"), F.lit(404))
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in IO_ERROR_ROW
    ]
    assert (out.first().dataElement, out.first().statusCode) == ("x", 404)


def test_status(rows):
    df = rows([199, 200, 299, 300, None], "s int").select(is_success(F.col("s")).alias("ok"))
    assert [r.ok for r in df.collect()] == [False, True, True, False, False]


def test_raise_when(rows):
    df = rows([1, 2, None], "v int")
    assert raise_when(df, F.col("v") > 2, "too big").count() == 3
    with pytest.raises(PySparkException, match="too big"):
        raise_when(df, F.col("v") > 1, "too big").collect()


def test_report_then_fail(rows):
    reported = []
    bad = rows([("a", False), ("b", True)], "v string, fatal boolean")
    with pytest.raises(StageFailure):
        report_then_fail(bad, F.col("fatal"), lambda df: reported.extend(df.collect()))
    assert len(reported) == 2
    report_then_fail(bad.filter("NOT fatal"), F.col("fatal"), lambda df: reported.append(df))
    assert len(reported) == 3
