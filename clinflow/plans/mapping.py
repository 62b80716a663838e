"""Document mapping over patient payloads and event properties."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.operators.guarded import OfRow
from clinflow.operators.mapping import (
    Mapping,
    bundle_entries,
    bundle_stage,
    const,
    copy,
    map_stage,
    nest,
    root,
)
from clinflow.operators.outcomes import split_ok, to_error_rows
from clinflow.plans.inputs import PATIENTS_SQL, document_notifications, patients, text_of
from clinflow.plans.registry import query
from clinflow.schemas import MAPPING_RULE
from clinflow.session import table, work_dir
from clinflow.sinks.bundles import check_bundles, failed_bodies, post_bundles
from clinflow.sources.rules import load_mapping

PATIENT_RULES = [
    nest("", "Resources", "patient", is_array=True),
    const("patient", "resourceType", "Patient"),
    copy("patient", "id", "$.id"),
    nest("patient", "name", "official_name", is_array=True),
    copy("patient", "gender", "$.sex"),
    copy("patient", "birthDate", "$.dob"),
    copy("patient", "visits", "$.visits"),
    copy("patient", "nickname", "$.nickname"),
    copy("official_name", "family", "$.lname"),
    copy("official_name", "given", "$.fname", is_array=True),
    const("official_name", "use", "official"),
]

_RESOURCE = """'{"resourceType":"Patient","id":"' || id || '","name":[{"family":"' || lname
 || '","given":["' || fname || '"],"use":"official"}],"gender":"' || sex
 || '","birthDate":"' || dob || '","visits":' || visits || '}'"""


@query(
    "J1 J2 J3 J4 J5 J6 J11 P8 S16",
    f"""WITH {PATIENTS_SQL}
SELECT id, '{{"Resources":[' || {_RESOURCE} || ']}}' AS output FROM patients""",
)
def map_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([vars(r) for r in PATIENT_RULES], MAPPING_RULE)
    good, _ = split_ok(map_stage(patients(spark, sf_dir), Mapping.from_table(rules)))
    return good.select("id", "output")


@query(
    "S16 E7 J11",
    f"""WITH {PATIENTS_SQL}
SELECT id, '{{"patient":"' || id || '","seen":[' || visits || ']}}' AS output FROM patients""",
)
def mapping_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = Mapping([copy("", "patient", "$.id"), copy("", "seen", "$.visits", is_array=True)])
    path = work_dir(spark, "mapping")
    spark.createDataFrame([(definition.to_text(),)], "value string").coalesce(1).write.text(path)
    good, _ = split_ok(map_stage(patients(spark, sf_dir), load_mapping(spark, path)))
    return good.select("id", "output")


# The same patient as the result itself, not in a list.
_PATIENT = Mapping(
    [
        replace(r, output="") if r.output == "patient" else r
        for r in PATIENT_RULES
        if r.output != ""
    ]
)


@query(
    "J10 P8",
    f"""WITH {PATIENTS_SQL}
SELECT id, '{{"resourceType":"Bundle","type":"batch","entry":[{{"resource":' || {_RESOURCE}
 || ',"request":{{"method":"PUT","url":"Patient"}}}}]}}' AS bundle FROM patients""",
)
def bundle_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_ok(map_stage(patients(spark, sf_dir), _PATIENT))
    bundled, _ = split_ok(bundle_stage(good, "output", "Patient"))
    return bundled.select("id", "bundle")


def patient_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id`` and ``output``: each patient as a transaction bundle."""
    stage = map_stage(patients(spark, sf_dir), Mapping(PATIENT_RULES, post="transaction"))
    return split_ok(stage)[0].select("id", "output")


_TRANSACTION = f"""'{{"resourceType":"Bundle","type":"transaction","entry":[{{"resource":'
 || {_RESOURCE} || ',"request":{{"method":"PUT","url":"Patient/' || id || '"}}}}]}}'"""


@query("J7 J11", f"WITH {PATIENTS_SQL} SELECT id, {_TRANSACTION} AS output FROM patients")
def bundle_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patient_transactions(spark, sf_dir)


@query(
    "J10 W5",
    f"""WITH {PATIENTS_SQL}
SELECT id AS source, 0 AS position, 'PUT' AS method, 'Patient/' || id AS url,
       'Patient' AS resource_type, id,
       '{{"birthDate":"' || dob || '","gender":"' || sex || '","id":"' || id
       || '","name":[{{"family":"' || lname || '","given":["' || fname
       || '"],"use":"official"}}],"resourceType":"Patient","visits":' || visits || '}}' AS body
FROM patients""",
)
def bundle_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = patient_transactions(spark, sf_dir).withColumnRenamed("id", "source")
    return bundle_entries(bundles, "output", ["source"])


@query(
    "J8 J5",
    """
SELECT event_id, '{"testOutput":[{"k":' || json_extract_string(props, '$.k') || '}]}' AS output
FROM events
""",
)
def identity_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = Mapping([root("", "testOutput", is_array=True)])
    stage = map_stage(table(spark, sf_dir, "events"), mapping, "props", "event_id")
    return split_ok(stage)[0].select("event_id", "output")


MIXED_SQL = """
mixed AS (
  SELECT 'e' || event_id AS id, props AS data FROM events
  UNION ALL
  SELECT 'd' || doc_id, text FROM documents)
"""


def mixed_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties, which are JSON, and document texts, which are not."""
    events = table(spark, sf_dir, "events").select(
        text_of("e", F.col("event_id")).alias("id"), F.col("props").alias("data")
    )
    documents = document_notifications(table(spark, sf_dir, "documents"))
    return events.unionByName(documents.toDF("id", "data"))


@query(
    "J11 E3 E4 E5",
    f"""WITH {MIXED_SQL}
SELECT id, 'the input is not valid JSON' AS error_message, 'MapMessages' AS step,
       '["' || id || '"]' AS sources
FROM mixed WHERE NOT json_valid(data)""",
)
def mapping_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = Mapping([copy("", "foo", "$.k", is_array=True)])
    _, bad = split_ok(map_stage(mixed_data(spark, sf_dir), mapping))
    rows = to_error_rows(bad)
    return rows.select(
        F.element_at("sources", 1).alias("id"),
        "error_message",
        "step",
        F.to_json("sources").alias("sources"),
    )


@query(
    "W4 P9 E6",
    f"""WITH {MIXED_SQL}
SELECT data AS "dataElement", 'the body is not valid JSON' AS message,
       CAST(NULL AS INTEGER) AS "statusCode"
FROM mixed WHERE NOT json_valid(data)""",
)
def failed_bundle_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = mixed_data(spark, sf_dir).withColumnRenamed("data", "output")
    _, bad = split_ok(check_bundles(bodies))
    return failed_bodies(bad).select("dataElement", "message", "statusCode")


VISITS = re.compile(r'"visits":(\d+)')


def refusing_client():
    """A client that refuses patients seen in an odd-numbered nation, as a store might."""

    def send(row):
        visits = int(VISITS.search(row["output"])[1])
        return (200, "stored") if visits % 2 == 0 else (422, "refused")

    return OfRow(send)


@query(
    "W4 P11 U3",
    f"""WITH {PATIENTS_SQL}
SELECT id, CASE WHEN visits % 2 = 0 THEN 200 ELSE 422 END AS status, visits % 2 = 0 AS ok,
       CASE WHEN visits % 2 <> 0 THEN 'refused' END AS error_message
FROM patients""",
)
def posted_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = post_bundles(patient_transactions(spark, sf_dir), refusing_client, keep=("id",))
    return sent.select("id", "status", "ok", "error.error_message")
