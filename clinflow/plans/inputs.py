"""Feed inputs derived from the test tables, in Spark and in SQL.

Each ``*_SQL`` constant is a list of common table expressions that gives DuckDB the same rows as the
function beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.operators.lookups import lookup_join
from clinflow.session import spread_table, table


def text_of(*parts):
    """Concatenate literals (str) and columns into one text column."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# -- notifications: one per event, and every document text as junk ---------------------------------

NOTIFICATIONS_SQL = """
notifications AS (
  SELECT 'events' AS source, 'e' || event_id AS rid, CASE event_type
    WHEN 'signup' THEN '{"type":"ENTITIES_MERGED","id":' || event_id || ',"uris":["entities/' || user_id || '","entities/' || event_id || '"]}'
    WHEN 'view' THEN '{"type":"ENTITIES_MERGED","id":' || event_id || ',"uris":["entities/' || user_id || '"]}'
    WHEN 'click' THEN ' { "type" : "CLICK NOW" ,' || chr(10) || ' "id" : ' || event_id || ' , "props" : ' || props || ' } '
    WHEN 'purchase' THEN '{"type":5,"id":' || event_id || ',"props":' || props || '}'
    ELSE '{"type":null,"id":' || event_id || '}' END AS value
  FROM events
  UNION ALL
  SELECT 'documents', 'd' || doc_id, text FROM documents),
types AS (
  SELECT 'entities/' || c_custkey AS uri, c_mktsegment AS entity_type
  FROM customer WHERE c_acctbal >= 0)
"""


def event_notifications(events: DataFrame, *more: Column) -> DataFrame:
    """``rid`` and ``value`` for each event, and what else is asked for; works on streams as well."""
    event_id, user, props = F.col("event_id"), F.col("user_id"), F.col("props")
    kind = F.col("event_type")
    merged = '{"type":"ENTITIES_MERGED","id":'
    value = (
        F.when(
            kind == "signup",
            text_of(merged, event_id, ',"uris":["entities/', user, '","entities/', event_id, '"]}'),
        )
        .when(kind == "view", text_of(merged, event_id, ',"uris":["entities/', user, '"]}'))
        .when(
            kind == "click",
            text_of(' { "type" : "CLICK NOW" ,\n "id" : ', event_id, ' , "props" : ', props, " } "),
        )
        .when(kind == "purchase", text_of('{"type":5,"id":', event_id, ',"props":', props, "}"))
        .otherwise(text_of('{"type":null,"id":', event_id, "}"))
    )
    return events.select(text_of("e", event_id).alias("rid"), value.alias("value"), *more)


def document_notifications(documents: DataFrame) -> DataFrame:
    return documents.select(text_of("d", F.col("doc_id")).alias("rid"), F.col("text").alias("value"))


def united_notifications(events: DataFrame, documents: DataFrame) -> DataFrame:
    return (
        event_notifications(events)
        .withColumn("source", F.lit("events"))
        .unionByName(
            document_notifications(documents).withColumn("source", F.lit("documents"))
        )
    )


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return united_notifications(
        spread_table(spark, sf_dir, "events"), spread_table(spark, sf_dir, "documents")
    )


def entity_type_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as entities; those with a negative balance are unknown."""
    known = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    return known.select(
        text_of("entities/", F.col("c_custkey")).alias("uri"), F.col("c_mktsegment").alias("type")
    )


# -- patient payloads: one per customer ------------------------------------------------------------

PATIENTS_SQL = """
patients AS (
  SELECT 'c-' || c_custkey AS id,
         '{"id":"c-' || c_custkey || '","lname":"' || c_name || '","fname":"' || n_name
         || '","sex":"' || c_mktsegment || '","dob":"'
         || strftime(DATE '1930-01-01' + CAST(c_custkey % 30000 AS INTEGER), '%Y-%m-%d')
         || '","visits":' || c_nationkey || '}' AS data,
         c_name AS lname, n_name AS fname, c_mktsegment AS sex,
         strftime(DATE '1930-01-01' + CAST(c_custkey % 30000 AS INTEGER), '%Y-%m-%d') AS dob,
         c_nationkey AS visits, c_custkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id`` and ``data``, a JSON payload with a name, a sex and a date of birth."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    named = lookup_join(spread_table(spark, sf_dir, "customer"), nation, ["c_nationkey"], "inner")
    dob = F.date_add(F.lit("1930-01-01").cast("date"), (F.col("c_custkey") % 30000).cast("int"))
    payload = F.to_json(
        F.struct(
            text_of("c-", F.col("c_custkey")).alias("id"),
            F.col("c_name").alias("lname"),
            F.col("n_name").alias("fname"),
            F.col("c_mktsegment").alias("sex"),
            F.date_format(dob, "yyyy-MM-dd").alias("dob"),
            F.col("c_nationkey").alias("visits"),
        )
    )
    return named.select(text_of("c-", F.col("c_custkey")).alias("id"), payload.alias("data"))


# -- message store: one message per event ----------------------------------------------------------

MESSAGES_SQL = """
messages AS (
  SELECT event_type AS store, 'stores/' || event_type || '/messages/' || event_id AS name,
         props AS data, '{"data":' || props || '}' AS schematized_data,
         CAST(user_id AS VARCHAR) AS user_label, ts AS send_time, event_id, "value"
  FROM events)
"""


def messages(events: DataFrame) -> DataFrame:
    """Messages whose send time stays the column of the file, so that bounds reach its reader."""
    return events.select(
        F.col("event_type").alias("store"),
        text_of("stores/", F.col("event_type"), "/messages/", F.col("event_id")).alias("name"),
        F.col("props").alias("data"),
        text_of('{"data":', F.col("props"), "}").alias("schematized_data"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("labels"),
        F.col("ts").alias("create_time"),
        F.col("ts").alias("send_time"),
        "event_id",
        "value",
    )


def message_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(table(spark, sf_dir, "events"))


# -- studies: an order is a study, its lines are the instances -------------------------------------

STORE_PATH = "projects/clinic/locations/earth/datasets/main/dicomStores/scans"

INSTANCES_SQL = f"""
notified AS (
  SELECT '{STORE_PATH}/dicomWeb/studies/' || l_orderkey || '/series/' || l_suppkey
         || '/instances/' || l_linenumber AS path
  FROM lineitem
  UNION ALL
  SELECT url FROM pages),
instances AS (
  SELECT '{STORE_PATH}' AS dicom_store_path, CAST(l_orderkey AS VARCHAR) AS study_id,
         CAST(l_linenumber AS VARCHAR) AS instance_id,
         '{{"0020000D":{{"vr":"UI","Value":["' || l_orderkey || '"]}},"00200013":{{"vr":"IS","Value":["'
         || l_linenumber || '"]}},"00201208":{{"vr":"IS","Value":[' || CAST(l_quantity AS INTEGER)
         || ']}}}}' AS metadata
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P')
"""


def instance_paths(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        text_of(
            STORE_PATH,
            "/dicomWeb/studies/",
            F.col("l_orderkey"),
            "/series/",
            F.col("l_suppkey"),
            "/instances/",
            F.col("l_linenumber"),
        ).alias("path")
    )


def notified_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path per line, and every page address as a path that is none."""
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return instance_paths(spread_table(spark, sf_dir, "lineitem")).unionByName(pages)


def instance_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the instances of finished and open orders; pending ones are not stored."""
    stored = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus <> 'P'")
        .select(F.col("o_orderkey").alias("l_orderkey"))
    )
    lines = lookup_join(spread_table(spark, sf_dir, "lineitem"), stored, ["l_orderkey"], "left_semi")
    metadata = text_of(
        '{"0020000D":{"vr":"UI","Value":["',
        F.col("l_orderkey"),
        '"]},"00200013":{"vr":"IS","Value":["',
        F.col("l_linenumber"),
        '"]},"00201208":{"vr":"IS","Value":[',
        F.col("l_quantity").cast("int"),
        "]}}",
    )
    return lines.select(
        F.lit(STORE_PATH).alias("dicom_store_path"),
        F.col("l_orderkey").cast("string").alias("study_id"),
        F.col("l_linenumber").cast("string").alias("instance_id"),
        metadata.alias("metadata"),
    )


# -- resource log: one version per order, keyed by customer ----------------------------------------

RESOURCES_SQL = """
resource_log AS (
  SELECT 'Encounter' AS resource_type, CAST(o_custkey AS VARCHAR) AS id,
         epoch_us(o_orderdate) // 1000 AS version, o_orderkey AS seq,
         '{"resourceType":"Encounter","id":"' || o_custkey || '","status":"' || o_orderstatus
         || '","priority":"' || o_orderpriority || '"}' AS body
  FROM orders),
current_log AS (
  SELECT * FROM resource_log
  QUALIFY row_number() OVER (PARTITION BY resource_type, id ORDER BY version DESC, seq DESC) = 1)
"""


def resource_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit("Encounter").alias("resource_type"),
        F.col("o_custkey").cast("string").alias("id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("version"),
        F.col("o_orderkey").alias("seq"),
        text_of(
            '{"resourceType":"Encounter","id":"',
            F.col("o_custkey"),
            '","status":"',
            F.col("o_orderstatus"),
            '","priority":"',
            F.col("o_orderpriority"),
            '"}',
        ).alias("body"),
    )


# -- export lines: one JSON message per event, and every document text as junk ---------------------

EXPORTED_SQL = """
lines AS (
  SELECT 'e' || event_id AS rid,
    '{"name":"' || event_type || '/' || event_id || '","data":"' || base64(encode(props))
    || '","sendTime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","labels":{"user":"' || user_id
    || '"}' || CASE event_type
      WHEN 'signup' THEN ''
      WHEN 'error' THEN ',"schematizedData":{"data":' || to_json(props) || ',"error":"bad segment"}'
      WHEN 'view' THEN ',"schematizedData":{"data":' || to_json(props) || ',"error":""}'
      ELSE ',"schematizedData":{"data":' || to_json(props) || '}' END || '}' AS value,
    event_type, event_id, ts, user_id, props
  FROM events
  UNION ALL
  SELECT 'd' || doc_id, text, NULL, NULL, NULL, NULL, NULL FROM documents)
"""


def export_rows(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    props = F.to_json(F.array("props"))
    quoted_props = F.substring(props, F.lit(2), F.length(props) - 2)
    schematized = (
        F.when(kind == "signup", F.lit(""))
        .when(
            kind == "error",
            text_of(',"schematizedData":{"data":', quoted_props, ',"error":"bad segment"}'),
        )
        .when(kind == "view", text_of(',"schematizedData":{"data":', quoted_props, ',"error":""}'))
        .otherwise(text_of(',"schematizedData":{"data":', quoted_props, "}"))
    )
    value = text_of(
        '{"name":"',
        kind,
        "/",
        F.col("event_id"),
        '","data":"',
        F.base64(F.encode("props", "UTF-8")),
        '","sendTime":"',
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        'Z","labels":{"user":"',
        F.col("user_id"),
        '"}',
        schematized,
        "}",
    )
    return events.select(text_of("e", F.col("event_id")).alias("rid"), value.alias("value"))


def export_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_rows(spread_table(spark, sf_dir, "events")).unionByName(
        document_notifications(spread_table(spark, sf_dir, "documents"))
    )
