"""Good and rejected rows, and the two error row shapes.

A stage never raises for bad data: it adds ``ok`` and ``error`` to its rows, and the rejected ones go
to a dead letter with the step, the sources and the cause.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from clinflow.functions.jsonx import once
from clinflow.functions.times import iso_text
from clinflow.schemas import ERROR_ENTRY


class StageFailure(RuntimeError):
    """Rows of a class that must stop the job were found; they are already in the dead letter."""


def error_entry(
    message: Column | str,
    step: str,
    resource: Column | None = None,
    sources: Column | None = None,
    stack_trace: Column | None = None,
    at: Column | None = None,
) -> Column:
    """An error entry; the resource is empty text and the sources are empty by default."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.struct(
        (F.lit("") if resource is None else resource).alias("error_resource"),
        (text if stack_trace is None else stack_trace).alias("stack_trace"),
        text.alias("error_message"),
        iso_text(F.current_timestamp() if at is None else at).alias("timestamp"),
        F.lit(step).alias("step"),
        (F.array().cast("array<string>") if sources is None else sources).alias("sources"),
    ).cast(ERROR_ENTRY)


def checked(df: DataFrame, ok: Column, error: Column) -> DataFrame:
    """Add ``ok`` (never null) and ``error`` (null on good rows)."""
    return df.withColumn("ok", F.coalesce(once(ok), F.lit(False))).withColumn(
        "error", F.when(~F.col("ok"), error)
    )


def split_ok(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good rows and the rejected rows. Together they are the input, without overlap."""
    missing = {"ok", "error"} - set(df.columns)
    if missing:
        raise ValueError(f"not the result of a checked stage, it lacks {sorted(missing)}")
    return df.filter("ok").drop("ok", "error"), df.filter("not ok").drop("ok")


def to_error_rows(rejected: DataFrame, error: str = "error") -> DataFrame:
    """E5: error entries as table rows; the resource is left out, missing sources become empty."""
    e = F.col(error)
    return rejected.select(
        e["stack_trace"].alias("stacktrace"),
        e["error_message"].alias("error_message"),
        e["timestamp"].alias("timestamp"),
        e["step"].alias("step"),
        F.coalesce(e["sources"], F.array().cast("array<string>")).alias("sources"),
    )


def to_io_error_rows(
    rejected: DataFrame,
    element: Column,
    message: Column,
    status: Column | None = None,
    observed: Column | None = None,
    stack_trace: Column | None = None,
) -> DataFrame:
    """Rejected reads or writes as table rows with the status code, null where there is none."""
    return rejected.select(
        element.cast("string").alias("dataElement"),
        (F.current_timestamp() if observed is None else observed).alias("observed_time"),
        message.alias("message"),
        (message if stack_trace is None else stack_trace).alias("stacktrace"),
        (F.lit(None) if status is None else status).cast("int").alias("statusCode"),
    )


def is_success(status: Column) -> Column:
    """A 2xx status."""
    return F.coalesce(F.floor(status / 100) == 2, F.lit(False))


def raise_when(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """E2, policy *fail*: the first row of this kind ends the query."""
    return df.filter(
        F.when(F.coalesce(condition, F.lit(False)), F.raise_error(F.lit(message)).cast("boolean"))
        .otherwise(F.lit(True))
    )


def report_then_fail(
    rejected: DataFrame, fatal: Column, write: Callable[[DataFrame], None]
) -> None:
    """E2, policy *report and rethrow*: write every rejected row, then stop if one was fatal."""
    kept = rejected.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write(kept)
        if not kept.filter(fatal).isEmpty():
            raise StageFailure("rows that cannot be recovered were reported")
    finally:
        kept.unpersist()
