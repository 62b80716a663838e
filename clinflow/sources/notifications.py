"""Notification streams. Topic, server and folder are arguments; nothing is built in."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.functions.text import utf8_text


def text_files(
    spark: SparkSession,
    path: str,
    per_trigger: int | None = None,
    done: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """One notification per line of the files that arrive in a folder.

    ``done`` says what becomes of a file once its batch is complete: ``delete``, or ``archive`` to
    move it below ``archive``.
    """
    reader = spark.readStream.format("text")
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if done is not None:
        reader = reader.option("cleanSource", done)
    if archive is not None:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.load(path).select("value")


def topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A Kafka topic as ``value BINARY, attributes MAP<STRING, STRING>``.

    Needs Spark's Kafka package on the class path.
    """
    raw = spark.readStream.format("kafka").options(includeHeaders="true", **options).load()
    return raw.select("value", attributes(F.col("headers")).alias("attributes"))


def attributes(headers: Column) -> Column:
    """Message headers, an array of key and binary value, as a map; of equal keys the last holds."""
    given = F.coalesce(headers, F.array().cast("array<struct<key:string,value:binary>>"))
    keys = F.transform(given, lambda h: h["key"])
    latest = F.transform(
        F.array_distinct(keys),
        lambda k: F.struct(
            k.alias("key"),
            utf8_text(F.element_at(F.filter(given, lambda h: h["key"] == k), -1)["value"]).alias(
                "value"
            ),
        ),
    )
    return F.map_from_entries(latest)


def payload_text(df: DataFrame, payload: str = "value", out: str = "value") -> DataFrame:
    """A binary payload as text."""
    return df.withColumn(out, utf8_text(F.col(payload)))


def parameters(spark: SparkSession, values: Iterable[str], column: str = "value") -> DataFrame:
    """A few values given by the caller, as rows."""
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


# Fixed value: how long after a message its repeats may come.
REDELIVERY = "10 minutes"


def delivered_once(stream: DataFrame, message_id: str, within: str = REDELIVERY) -> DataFrame:
    """A stream without the repeats of a message, known by its id.

    What comes with the same id at most ``within`` after the first is a repeat; the time is that of
    arrival, so that a message that was sent long ago is not late. Ids are forgotten after that, so
    that state is what came in lately. Rows without an id are all kept.
    """
    marked = stream.withColumns(
        {"_id": F.coalesce(F.col(message_id).cast("string"), F.uuid()), "_came": F.current_timestamp()}
    )
    return marked.withWatermark("_came", within).dropDuplicatesWithinWatermark(["_id"]).drop("_id", "_came")
