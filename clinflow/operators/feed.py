"""The message feed: routing by type, enrichment of merges, mapping, bundle check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.functions import jsonx
from clinflow.operators.lookups import with_entity_type
from clinflow.operators.mapping import Mapping, map_stage
from clinflow.operators.outcomes import checked, error_entry
from clinflow.schemas import ERROR_ENTRY

# The event type that is enriched, the field it gets, and the id of a wrapped message.
MERGED_TYPE = "ENTITIES_MERGED"
MERGED_FIELD = "mergedEntityType"
WRAPPED_ID = '"input"'

READ, MAPPING, WRITE = "read", "mapping", "write"


def route_by_type(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``type``, ``uri`` (null unless it has to be looked up), ``doc``, ``ok``, ``error``.

    Good rows are objects with a readable type. A merge with two or more uris is to be looked up by
    the first; with fewer it passes as it is, and without a list of uris it is rejected.
    """
    doc = F.col("doc")
    parsed = jsonx.with_document(df, value, "doc")
    typed = parsed.withColumn(
        "type",
        jsonx.once(F.when(jsonx.is_object(F.col(value), doc), jsonx.scalar_text(doc, "$.type"))),
    )
    merged = F.coalesce(F.col("type") == MERGED_TYPE, F.lit(False))
    looked = merged & jsonx.has_more_than_one(doc, "$.uris")
    routed = typed.withColumn("_merged", merged).withColumn("_looked", looked)
    routed = routed.withColumn(
        "uri", F.when(F.col("_looked"), jsonx.scalar_text(doc, "$.uris[0]"))
    )
    ok = (
        F.col("type").isNotNull()
        & (~F.col("_merged") | jsonx.field_is_array(doc, "$.uris"))
        & (~F.col("_looked") | F.col("uri").isNotNull())
    )
    entry = error_entry(
        "the notification has no readable type or list of uris", "CheckType", resource=F.col(value)
    )
    return checked(routed, ok, entry).drop("_merged", "_looked")


def enrich_merged(
    routed: DataFrame, types: DataFrame, value: str = "value", **limits: int
) -> DataFrame:
    """L1, F2: look the uris up and put the type, or JSON null, into the text."""
    found = with_entity_type(routed, types, "uri", **limits)
    looked = F.col("ok") & F.col("uri").isNotNull()
    return found.withColumn(
        "message",
        F.when(
            looked,
            jsonx.set_field(F.col(value), F.col("doc"), MERGED_FIELD, F.col("entity_type")),
        ).otherwise(F.col(value)),
    )


def wrap_message(df: DataFrame, text: str, message_id: Column | None = None) -> DataFrame:
    """The compact text as ``data`` under a constant id, or under none."""
    given = F.lit(WRAPPED_ID) if message_id is None else message_id
    return df.withColumn("id", given.cast("string")).withColumn("data", jsonx.compact(F.col(text)))


def feed_outcomes(
    notifications: DataFrame,
    types: DataFrame,
    mapping: Mapping,
    value: str = "value",
    **limits: int,
) -> DataFrame:
    """T7 for a batch: the input columns, ``output``, ``failed_stage`` and ``error`` of every row."""
    routed = route_by_type(notifications, value)
    return routed_outcomes(routed, notifications.columns, types, mapping, value, **limits)


def routed_outcomes(
    routed: DataFrame,
    keep: list[str],
    types: DataFrame,
    mapping: Mapping,
    value: str = "value",
    **limits: int,
) -> DataFrame:
    """T7 from the lookup on, for the rows of ``route_by_type``, of which ``keep`` names columns.

    Each row keeps its place through all stages: the stage that rejected it is named, and null for
    rows whose bundle can be written. A text is parsed once, and again only if it was enriched.
    """
    routed = enrich_merged(routed, types, value, **limits)
    looked = F.col("ok") & F.col("uri").isNotNull()
    # An enriched text was made here from a checked one, so it needs no gate.
    reparsed = F.when(looked, F.try_parse_json("message")).otherwise(F.col("doc"))
    current = routed.withColumn("doc", jsonx.once(reparsed)).withColumnsRenamed({"ok": "_read_ok", "error": "_read_error"})
    mapped = map_stage(wrap_message(current, "message"), mapping, doc="doc")
    staged = mapped.withColumnsRenamed({"ok": "_map_ok", "error": "_map_error"})
    stage = F.when(~F.col("_read_ok"), READ).when(~F.col("_map_ok"), MAPPING)
    return staged.select(
        *keep,
        F.when(F.col("_read_ok") & F.col("_map_ok"), F.col("output")).alias("output"),
        stage.alias("failed_stage"),
        F.coalesce("_read_error", F.when(F.col("_read_ok"), F.col("_map_error")))
        .cast(ERROR_ENTRY)
        .alias("error"),
    )
