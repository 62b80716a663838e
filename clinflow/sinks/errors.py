"""Dead letters as text shards and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.operators.outcomes import to_error_rows
from clinflow.sinks.files import batch_path

# Error shards of the message feed and of the imaging feed, and the step label.
MESSAGE_FEED_SHARDS = 10
IMAGING_FEED_SHARDS = 1
WRITE_STEP = "WriteErrors"

MAX_ROWS_PER_SHARD = 1_000_000
MAX_BYTES_PER_SHARD = 256 * 1024 * 1024


def shard_count(rows: int, size: int, shards: int) -> int:
    """As many shards as asked for, and more once one would hold too many rows or bytes."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    return max(shards, -(-rows // MAX_ROWS_PER_SHARD), -(-size // MAX_BYTES_PER_SHARD))


def json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_text_shards(
    lines: DataFrame, path: str, batch_id: int, shards: int, held: tuple[int, int] | None = None
) -> None:
    """One batch of error lines in ``shards`` files; a repeated batch replaces itself.

    ``held`` are their rows and about their bytes, if they are known; else both are counted.
    """
    if held is None:
        found = lines.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.octet_length(lines.columns[0])), F.lit(0)).alias("size"),
        ).first()
        held = found["rows"], found["size"]
    spread = lines.repartition(shard_count(*held, shards))
    spread.write.mode("overwrite").text(batch_path(path, batch_id))


def write_error_entries(
    rejected: DataFrame, target: str, step: str = WRITE_STEP, shards: int | None = None
) -> None:
    """A batch of error entries as JSON lines."""
    _write_lines(json_lines(to_error_rows(rejected)), target, step, shards)


def write_io_errors(
    rows: DataFrame, target: str, step: str = WRITE_STEP, shards: int | None = None
) -> None:
    """A batch of IO error rows as JSON lines."""
    _write_lines(json_lines(rows), target, step, shards)


def _write_lines(lines: DataFrame, target: str, step: str, shards: int | None) -> None:
    spread = lines if shards is None else lines.repartition(shards)
    context = lines.sparkSession.sparkContext
    context.setJobDescription(step)
    try:
        spread.write.mode("overwrite").text(target)
    finally:
        context.setJobDescription(None)


def write_dead_letter_table(
    rows: DataFrame, path: str, mode: str = "append", observed: Column | None = None
) -> None:
    """IO error rows as a table with one partition per day of observation."""
    day = F.to_date(F.col("observed_time") if observed is None else observed)
    rows.withColumn("observed_date", day).write.mode(mode).partitionBy("observed_date").parquet(
        path
    )
