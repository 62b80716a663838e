"""Notifications: gates, routing, enrichment and the whole feed as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.functions import jsonx
from clinflow.operators.feed import (
    MERGED_FIELD,
    enrich_merged,
    feed_outcomes,
    route_by_type,
    wrap_message,
)
from clinflow.operators.lookups import entity_types
from clinflow.operators.mapping import Mapping, const, copy, nest
from clinflow.operators.metrics import count_by_step, observe_outcomes
from clinflow.operators.outcomes import checked, error_entry, split_ok
from clinflow.plans.inputs import (
    NOTIFICATIONS_SQL,
    entity_type_table,
    notifications,
)
from clinflow.plans.registry import query
from clinflow.session import table

# JSON checks of DuckDB over the same text; ``type`` is read only where the text is an object.
ROUTED_SQL = f"""
WITH {NOTIFICATIONS_SQL},
gated AS (
  SELECT source, rid, value, CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END
    AS is_object FROM notifications),
typed AS (
  SELECT *, CASE WHEN is_object THEN json_extract_string(value, '$.type') END AS type,
    CASE WHEN is_object THEN json_array_length(value, '$.uris') END AS n_uris,
    CASE WHEN is_object THEN json_extract_string(value, '$.uris[0]') END AS first_uri
  FROM gated),
routed AS (
  SELECT *, CASE WHEN type = 'ENTITIES_MERGED' AND n_uris > 1 THEN first_uri END AS uri,
    type IS NOT NULL AND (type <> 'ENTITIES_MERGED' OR n_uris IS NOT NULL) AS ok FROM typed),
enriched AS (
  SELECT routed.*, CASE WHEN uri IS NULL THEN value ELSE substr(value, 1, length(value) - 1)
    || ',"mergedEntityType":' || coalesce('"' || entity_type || '"', 'null') || '}}' END AS message
  FROM routed LEFT JOIN types USING (uri))
"""


@query(
    "S19 P1 P4 P9 E1",
    ROUTED_SQL + "SELECT rid, '\"input\"' AS id, CAST(json(value) AS VARCHAR) AS data"
    " FROM gated WHERE is_object",
)
def json_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = jsonx.with_document(notifications(spark, sf_dir), "value", "doc")
    gated = checked(
        parsed,
        jsonx.is_object(F.col("value"), F.col("doc")),
        error_entry("not an object", "ParseMessage", resource=F.col("value")),
    )
    good, _ = split_ok(gated)
    return wrap_message(good, "value").select("rid", "id", "data")


@query("P2 P13 F1", ROUTED_SQL + "SELECT rid, ok, type FROM routed")
def route_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_by_type(notifications(spark, sf_dir))
    return routed.select("rid", "ok", "type")


@query(
    "P2 P13 E3",
    ROUTED_SQL + "SELECT rid, value, 'CheckType' AS step FROM routed WHERE NOT ok",
)
def read_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_ok(route_by_type(notifications(spark, sf_dir)))
    return bad.select("rid", F.col("error.error_resource").alias("value"), "error.step")


@query(
    "P3 F3",
    ROUTED_SQL + "SELECT rid, type, CAST(n_uris AS INTEGER) AS n_uris, uri FROM routed WHERE ok",
)
def merge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_by_type(notifications(spark, sf_dir)).filter("ok")
    return routed.select(
        "rid", "type", jsonx.array_size(F.col("doc"), "$.uris").alias("n_uris"), "uri"
    )


@query("L1 F2 P3 T7", ROUTED_SQL + "SELECT rid, uri, message FROM enriched WHERE ok")
def merged_entity_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = entity_types(entity_type_table(spark, sf_dir))
    routed = route_by_type(notifications(spark, sf_dir))
    return enrich_merged(routed, types).filter("ok").select("rid", "uri", "message")


@query(
    "F2",
    """
SELECT event_id,
       '{"k":' || json_extract_string(props, '$.k') || ',"mergedEntityType":"' || event_type || '"}'
         AS added,
       '{"k":"' || event_type || '"}' AS replaced
FROM events
""",
)
def set_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = jsonx.with_document(table(spark, sf_dir, "events"), "props", "doc")
    text, doc, kind = F.col("props"), F.col("doc"), F.col("event_type")
    return parsed.select(
        "event_id",
        jsonx.set_field(text, doc, MERGED_FIELD, kind).alias("added"),
        jsonx.set_field(text, doc, "k", kind).alias("replaced"),
    )


FEED_MAPPING = Mapping(
    [
        nest("", "Resources", "event", is_array=True),
        const("event", "resourceType", "AuditEvent"),
        copy("event", "id", "$.id"),
        copy("event", "subtype", "$.type", is_array=True),
        copy("event", "outcome", "$.mergedEntityType"),
    ],
    post="transaction",
)

FEED_SQL = (
    ROUTED_SQL
    + """,
outcomes AS (
  SELECT rid, CASE WHEN NOT ok THEN 'read' END AS failed_stage,
    CASE WHEN ok THEN '{"resourceType":"Bundle","type":"transaction","entry":[{"resource":'
      || '{"resourceType":"AuditEvent","id":' || json_extract_string(message, '$.id')
      || ',"subtype":[' || CAST(json_extract(message, '$.type') AS VARCHAR) || ']'
      || CASE WHEN uri IS NULL THEN '' ELSE ',"outcome":'
         || CAST(json_extract(message, '$.mergedEntityType') AS VARCHAR) END
      || '},"request":{"method":"PUT","url":"AuditEvent/' || json_extract_string(message, '$.id')
      || '"}}]}' END AS output
  FROM enriched)
"""
)


@query("T7 J7 J11 P8 W4", FEED_SQL + "SELECT rid, failed_stage, output FROM outcomes")
def message_feed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = entity_types(entity_type_table(spark, sf_dir))
    outcomes = feed_outcomes(notifications(spark, sf_dir), types, FEED_MAPPING)
    return outcomes.select("rid", "failed_stage", "output")


@query(
    "A1",
    ROUTED_SQL
    + """
SELECT source AS step, count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_failed
FROM routed GROUP BY source
""",
)
def stage_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_by_type(notifications(spark, sf_dir))
    return count_by_step(routed, step="source").withColumnRenamed("source", "step")


@query("A1", ROUTED_SQL + "SELECT count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_failed"
       " FROM routed")
def observed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counters, taken while another job, here a write to nowhere, reads the rows."""
    routed = route_by_type(notifications(spark, sf_dir))
    observed, observation = observe_outcomes(routed, "routed")
    observed.select("rid", "type", "ok").write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([observation.get], "n_ok long, n_failed long")
