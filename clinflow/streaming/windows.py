"""Windows and triggers of the error streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Window and trigger of the error streams, and how late a row may be.
ERROR_WINDOW = "5 seconds"
ERROR_TRIGGER = {"processingTime": "5 seconds"}
ALLOWED_LATENESS = "0 seconds"


def error_windows(df: DataFrame, ts: str, step: str, width: str = ERROR_WINDOW) -> DataFrame:
    """Errors per tumbling window and step."""
    return (
        df.groupBy(F.window(ts, width).alias("_w"), step)
        .agg(F.count(F.lit(1)).alias("n_errors"))
        .select(
            F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), step,
            "n_errors",
        )
    )


def closed_error_windows(
    stream: DataFrame, ts: str, step: str, lateness: str = ALLOWED_LATENESS
) -> DataFrame:
    """Each window once, after the watermark has passed its end."""
    return error_windows(stream.withWatermark(ts, lateness), ts, step)


def windows_to_the_end(closed: DataFrame, rows: DataFrame, ts: str, step: str) -> DataFrame:
    """T3 once the input has ended: the windows that were closed, and those the watermark has not
    passed, counted from the rows since the last closed one."""
    last = closed.agg(F.max("window_end")).first()[0]
    still_open = rows if last is None else rows.filter(F.col(ts) >= F.lit(last))
    return closed.unionByName(error_windows(still_open, ts, step))
