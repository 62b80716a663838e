"""Error rows, error windows, dead-letter tables and latencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.functions.times import iso_text
from clinflow.operators.lookups import lookup_join
from clinflow.operators.metrics import latency
from clinflow.operators.outcomes import (
    checked,
    error_entry,
    is_success,
    raise_when,
    split_ok,
    to_error_rows,
    to_io_error_rows,
)
from clinflow.plans.registry import query
from clinflow.schemas import ERROR_ROW, IO_ERROR_ROW
from clinflow.session import table, work_dir
from clinflow.sinks.errors import write_dead_letter_table, write_error_entries, write_io_errors
from clinflow.streaming.windows import error_windows

_ISO = "strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def error_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ok`` and ``error``; those of type ``error`` are rejected."""
    entry = error_entry(
        F.concat(F.lit("bad event "), F.col("event_id")),
        "step1",
        resource=F.col("props"),
        sources=F.array(F.col("user_id").cast("string"), F.col("event_id").cast("string")),
        stack_trace=F.lit(""),
        at=F.col("ts").cast("timestamp"),
    )
    return checked(table(spark, sf_dir, "events"), F.col("event_type") != "error", entry)


_ERRORS_SQL = f"""
SELECT '' AS stacktrace, 'bad event ' || event_id AS error_message, {_ISO} AS "timestamp",
       'step1' AS step, '["' || user_id || '","' || event_id || '"]' AS sources
FROM events WHERE event_type = 'error'
"""


@query("E4 E5 E1 F9", _ERRORS_SQL)
def error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_ok(error_events(spark, sf_dir))
    return to_error_rows(bad).withColumn("sources", F.to_json("sources"))


@query("W7", _ERRORS_SQL)
def written_error_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_ok(error_events(spark, sf_dir))
    path = work_dir(spark, "errors")
    write_error_entries(bad, path, shards=10)
    rows = spark.read.schema(ERROR_ROW).json(path)
    return rows.withColumn("sources", F.to_json("sources"))


_IO_SQL = """
SELECT props AS "dataElement", ts AS observed_time, 'rejected' AS message, '' AS stacktrace,
       CAST(400 + user_id % 100 AS INTEGER) AS "statusCode"
FROM events WHERE event_type = 'error'
"""


def _io_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_io_error_rows(
        table(spark, sf_dir, "events").filter("event_type = 'error'"),
        F.col("props"),
        F.lit("rejected"),
        400 + F.col("user_id") % 100,
        F.col("ts").cast("timestamp"),
        F.lit(""),
    )


def _naive(df: DataFrame) -> DataFrame:
    return df.withColumn("observed_time", F.col("observed_time").cast("timestamp_ntz"))


@query("E6", _IO_SQL)
def io_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(_io_errors(spark, sf_dir))


@query(
    "W8 E6",
    _IO_SQL.replace("ts AS observed_time", "date_trunc('milliseconds', ts) AS observed_time"),
)
def written_io_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "io-errors")
    write_io_errors(_io_errors(spark, sf_dir), path)
    return _naive(spark.read.schema(IO_ERROR_ROW).json(path))


@query(
    "W10",
    f"SELECT * FROM ({_IO_SQL}) WHERE observed_time >= TIMESTAMP '2024-01-15 00:00:00'",
)
def dead_letter_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "dead-letter")
    write_dead_letter_table(_io_errors(spark, sf_dir), path)
    recent = spark.read.parquet(path).filter(F.col("observed_date") >= F.lit("2024-01-15"))
    return _naive(recent.drop("observed_date"))


WINDOWS_SQL = """
SELECT time_bucket(INTERVAL 5 SECOND, ts) AS window_start,
       time_bucket(INTERVAL 5 SECOND, ts) + INTERVAL 5 SECOND AS window_end,
       event_type AS step, count(*) AS n_errors
FROM events GROUP BY ALL
"""


@query("T1", WINDOWS_SQL)
def error_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_windows(
        table(spark, sf_dir, "events").withColumnRenamed("event_type", "step"), "ts", "step"
    )


@query(
    "P11",
    "SELECT p_partkey, p_size * 15 AS status, (p_size * 15) // 100 = 2 AS ok FROM part",
)
def status_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("p_size") * 15
    return table(spark, sf_dir, "part").select(
        "p_partkey", status.alias("status"), is_success(status).alias("ok")
    )


@query("E2", "SELECT event_id, event_type FROM events")
def fail_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No event lacks a type, so the policy that stops the job lets all of them pass."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return raise_when(events, F.col("event_type").isNull(), "an event has no type")


@query("F9 F8", f"SELECT event_id, {_ISO} AS iso FROM events")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", iso_text(F.col("ts").cast("timestamp")).alias("iso")
    )


@query(
    "A2 F10",
    """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(ms) AS BIGINT) AS sum_ms,
       min(ms) AS min_ms, max(ms) AS max_ms
FROM (SELECT l_returnflag, l_linestatus, epoch_us(l_shipdate) // 1000 - epoch_us(o_orderdate) // 1000 AS ms
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
GROUP BY ALL
""",
)
def latency_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the order, the source, to the shipping of each line, the commit."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_returnflag", "l_linestatus"
    )
    timed = lookup_join(lines, orders, ["l_orderkey"], "inner").select(
        "l_returnflag",
        "l_linestatus",
        F.col("l_shipdate").cast("timestamp").alias("finish"),
        F.col("o_orderdate").cast("timestamp").alias("source"),
    )
    return latency(timed, "finish", "source", ["l_returnflag", "l_linestatus"])
