"""Message store writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.functions.times import utc_day
from clinflow.operators.outcomes import checked, error_entry, split_ok, to_io_error_rows
from clinflow.schemas import MESSAGE
from clinflow.sinks.files import Writer, write_batch

INGEST = "INGEST"
BATCH_IMPORT = "BATCH_IMPORT"
INGEST_STEP = "IngestMessages"


def ingest_projection(df: DataFrame) -> DataFrame:
    """Of a message only its data and labels are sent."""
    return df.select("data", "labels")


def ingest_checked(df: DataFrame, valid: Column | None = None) -> DataFrame:
    """Messages with ``ok`` and ``error``; without data there is nothing to ingest."""
    rule = F.col("data").isNotNull() & (F.length("data") > 0)
    if valid is not None:
        rule = rule & valid
    entry = error_entry("the store rejected the message", INGEST_STEP,
                        resource=F.coalesce("data", F.lit("")))
    return checked(df, rule, entry)


def ingest_messages(
    df: DataFrame,
    store: str,
    batch_id: int,
    method: str = INGEST,
    valid: Column | None = None,
    write: Writer = write_batch,
) -> DataFrame:
    """Append the accepted messages to the store; the result is the rejected ones, as E6 rows.

    With ``append_committed`` as ``write`` readers see whole batches only.
    """
    if method == BATCH_IMPORT:
        raise NotImplementedError("batch import is not available")
    good, bad = split_ok(ingest_checked(df, valid))
    write(ingest_projection(good), store, batch_id)
    return to_io_error_rows(bad, F.col("data"), F.col("error.error_message"))


def create_messages(df: DataFrame, store: str, batch_id: int, write: Writer = write_batch) -> None:
    """Append messages with all their fields, in folders by day of sending, in UTC.

    They are written in ranges of time: each task writes to few days, a busy day is shared by
    several tasks, and files hold short spans, which readers skip by their bounds.
    """
    fields = [F.col(f.name).cast(f.dataType) for f in MESSAGE.fields]
    dated = df.select(*fields).withColumn("send_date", utc_day(F.col("send_time")))
    ranged = dated.repartitionByRange("send_date", "send_time", "name")
    ordered = ranged.sortWithinPartitions("send_date", "send_time")
    write(ordered, store, batch_id, ("send_date",))


def delete_messages(names: DataFrame, tombstones: str, batch_id: int) -> None:
    """Append tombstones; ``current_messages`` leaves their messages out."""
    write_batch(names.select("name", "seq"), tombstones, batch_id)
