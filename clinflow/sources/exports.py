"""Exported message files and bulk resource files: one JSON document per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.functions import jsonx
from clinflow.functions.times import instant
from clinflow.operators.mapping import checked_entries
from clinflow.operators.outcomes import checked, error_entry
from clinflow.operators.store import scan

PARSE_STEP = "ParseMessage"

# How the lines of a bulk file are built.
RESOURCE_PER_LINE = "RESOURCE"
BUNDLE_PER_LINE = "BUNDLE"


def export_lines(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """The lines of every file in the export folder, or of the ``files`` listed before; the
    folder may end in slashes."""
    if files is None:
        return spark.read.text(f"{path.rstrip('/')}/*")
    return spark.read.text(files) if files else spark.createDataFrame([], "value string")


def parse_messages(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines as messages, with ``ok`` and ``error``; a rejected line is its error resource.

    A line is rejected when it is no JSON object, has no schematized data, or its schematized data
    carries a parse error.
    """
    doc = F.col("_doc")
    parsed = jsonx.with_document(lines, value, "_doc")
    unread = jsonx.not_parsed(F.col(value), doc, "the line is not a JSON object")
    fields = parsed.select(
        *lines.columns,
        jsonx.is_object(F.col(value), doc).alias("_object"),
        _object_at(doc, "$.schematizedData").alias("_schematized"),
        jsonx.parse_error_text(doc).alias("_parse_error"),
        unread.alias("_unread"),
        F.try_variant_get(doc, "$.name", "string").alias("name"),
        F.try_variant_get(doc, "$.data", "string").alias("data"),
        F.try_variant_get(doc, "$.schematizedData.data", "string").alias("schematized_data"),
        F.try_variant_get(doc, "$.labels", "map<string,string>").alias("labels"),
        instant(F.try_variant_get(doc, "$.createTime", "string")).alias("create_time"),
        instant(F.try_variant_get(doc, "$.sendTime", "string")).alias("send_time"),
    )
    message = (
        F.when(~F.col("_object"), F.col("_unread"))
        .when(~F.col("_schematized"), "the message has no schematized data")
        .otherwise("the input message is invalid")
    )
    ok = F.col("_object") & F.col("_schematized") & (F.col("_parse_error") == "")
    entry = error_entry(message, PARSE_STEP, resource=F.col(value))
    return checked(fields, ok, entry).drop("_object", "_schematized", "_parse_error", "_unread")


def _object_at(doc: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
    return F.coalesce(kind.startswith("OBJECT"), F.lit(False))


def export_range(messages: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Half-open range of send time; an empty or missing bound is open."""
    return scan(messages, start or None, end or None)


def import_resources(
    lines: DataFrame, structure: str = RESOURCE_PER_LINE, value: str = "value"
) -> DataFrame:
    """Resources of a bulk file, each with ``ok`` and ``error``.

    With a bundle per line, a line that is no bundle is one rejected row.
    """
    if structure == BUNDLE_PER_LINE:
        entries = checked_entries(lines, value, [], "ImportResources").withColumnsRenamed(
            {"ok": "_read", "error": "_unread"}
        )
        entry = error_entry("the entry has no resource type", "ImportResources",
                            resource=F.coalesce("body", F.lit("")))
        ok = F.col("_read") & F.col("resource_type").isNotNull()
        rows = checked(entries, ok, F.coalesce("_unread", entry))
        return rows.select("resource_type", "id", "body", "ok", "error")
    if structure != RESOURCE_PER_LINE:
        raise ValueError(f"unknown content structure {structure!r}")
    parsed = jsonx.with_document(lines.select(value), value, "_doc")
    rows = parsed.select(
        F.try_variant_get("_doc", "$.resourceType", "string").alias("resource_type"),
        F.try_variant_get("_doc", "$.id", "string").alias("id"),
        F.col(value).alias("body"),
    )
    entry = error_entry("the line is not a resource", "ImportResources", resource=F.col("body"))
    return checked(rows, F.col("resource_type").isNotNull(), entry)
