"""Parsed messages: a list of segments, each an id and a map of fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.functions.jsonx import once
from clinflow.operators.outcomes import checked, error_entry, split_ok
from clinflow.schemas import PARSED_MESSAGE


def parse_segments(text: Column) -> Column:
    """The JSON form as a struct; null when the text is not JSON."""
    return F.from_json(text, PARSED_MESSAGE)


def segments_text(segments: Column) -> Column:
    """The JSON form of a list of segments."""
    return F.to_json(F.struct(segments.alias("segments")))


def parsed_messages(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``segments`` of each message, with ``ok`` and ``error``; a text without a list of
    segments is rejected."""
    segments = parse_segments(F.col(text))["segments"]
    rows = df.select(*keep, F.col(text).alias("_text"), once(segments).alias("segments"))
    entry = error_entry(
        "the text is no parsed message", "ParseSegments", resource=F.coalesce("_text", F.lit(""))
    )
    return checked(rows, F.col("segments").isNotNull(), entry).drop("_text")


def flatten_segments(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per segment of the messages that can be parsed, with its position in the message."""
    good, _ = split_ok(parsed_messages(df, text, keep))
    return good.select(*keep, F.posexplode("segments").alias("position", "_s")).select(
        *keep, "position", F.col("_s.segmentId").alias("segment_id"), F.col("_s.fields")
    )


def nest_segments(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    segment_id: Column,
    fields: Column,
) -> DataFrame:
    """Segments of a message back into its JSON form, in the given order; one row per message."""
    member = F.struct(
        *[F.col(c) for c in order],
        segment_id.alias("segmentId"),
        F.map_entries(fields).alias("fields"),
    )
    grouped = df.groupBy(*keys).agg(F.sort_array(F.collect_list(member)).alias("_members"))
    segments = F.transform(
        "_members",
        lambda m: F.struct(
            m["segmentId"].alias("segmentId"), F.map_from_entries(m["fields"]).alias("fields")
        ),
    )
    return grouped.select(*keys, segments_text(segments).alias("parsed"))
