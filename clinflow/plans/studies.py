"""Imaging studies: web paths, metadata lookup, wrapping and bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.functions import jsonx
from clinflow.functions.text import folder_glob
from clinflow.functions.webpath import with_web_path
from clinflow.operators.mapping import Mapping, const, copy
from clinflow.operators.outcomes import split_ok
from clinflow.operators.studies import read_studies
from clinflow.plans.inputs import (
    INSTANCES_SQL,
    STORE_PATH,
    instance_metadata,
    notified_paths,
    text_of,
)
from clinflow.plans.registry import query
from clinflow.session import table, work_dir
from clinflow.sinks.study_store import StudyStore
from clinflow.sources.notifications import payload_text
from clinflow.streaming.jobs import imaging_outcomes

IMAGING_MAPPING = Mapping(
    [
        const("", "resourceType", "ImagingStudy"),
        copy("", "uid", "$.study[0]['0020000D'].Value[0]"),
        copy("", "first", "$.study[0]['00200013'].Value[0]"),
        copy("", "frames", "$.study[0]['00201208'].Value[0]", is_array=True),
    ]
)

_WITH = f"WITH {INSTANCES_SQL}"
_PREFIX = f"'{STORE_PATH}/dicomWeb/studies/'"


@query(
    "P5 S2 F11",
    f"""{_WITH}
SELECT path, CASE WHEN valid THEN 'clinic' END AS project, CASE WHEN valid THEN 'earth' END AS location,
       CASE WHEN valid THEN 'main' END AS dataset, CASE WHEN valid THEN 'scans' END AS store_id,
       CASE WHEN valid THEN '{STORE_PATH}' END AS dicom_store_path,
       CASE WHEN valid THEN regexp_extract(path, 'studies/([^/]+)', 1) END AS study_id,
       CASE WHEN valid THEN regexp_extract(path, 'series/([^/]+)', 1) END AS series_id,
       CASE WHEN valid THEN regexp_extract(path, 'instances/([^/]+)', 1) END AS instance_id
FROM (SELECT path, starts_with(path, {_PREFIX}) AS valid FROM notified)""",
)
def web_path_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    binary = notified_paths(spark, sf_dir).select(F.encode("path", "UTF-8").alias("value"))
    return with_web_path(payload_text(binary).withColumnRenamed("value", "path"))


_RESOLVED_SQL = f"""{_WITH},
parsed AS (
  SELECT path, CASE WHEN starts_with(path, {_PREFIX})
    THEN regexp_extract(path, 'studies/([^/]+)', 1) END AS study_id FROM notified),
resolved AS (
  SELECT path, study_id, study_id IN (SELECT study_id FROM instances) IS TRUE AS ok FROM parsed)
"""


@query("L3 S12", _RESOLVED_SQL + "SELECT path, study_id FROM resolved WHERE ok")
def study_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, resolved = read_studies(notified_paths(spark, sf_dir), instance_metadata(spark, sf_dir))
    return split_ok(resolved)[0].select("path", "study_id")


@query(
    "E8 S12 L3",
    _RESOLVED_SQL
    + """SELECT path, CASE WHEN study_id IS NULL THEN 'Invalid DICOM web path'
ELSE 'no metadata for study ' || study_id END AS error_message FROM resolved WHERE NOT ok""",
)
def study_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, resolved = read_studies(notified_paths(spark, sf_dir), instance_metadata(spark, sf_dir))
    _, bad = split_ok(resolved)
    return bad.select(F.col("error.error_resource").alias("path"), "error.error_message")


STUDIES_SQL = _RESOLVED_SQL + """,
studies AS (
  SELECT study_id, '[' || string_agg(metadata, ',' ORDER BY instance_id, metadata) || ']' AS study,
         count(*) AS n_notifications, min(instance_id) AS first,
         arg_min(metadata, struct_pack(i := instance_id, m := metadata)) AS first_metadata
  FROM instances GROUP BY study_id)
"""


def _studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    studies, _ = read_studies(notified_paths(spark, sf_dir), instance_metadata(spark, sf_dir))
    return studies


@query(
    "S12",
    STUDIES_SQL + "SELECT study_id, study, n_notifications FROM studies",
)
def study_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _studies(spark, sf_dir).select("study_id", "study", "n_notifications")


@query(
    "F4 P4",
    STUDIES_SQL + """SELECT study_id, '{"study":' || study || '}' AS data FROM studies""",
)
def study_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _studies(spark, sf_dir).select(
        "study_id", jsonx.array_wrap(F.col("study"), "study").alias("data")
    )


@query(
    "T8 J10 J11 P8",
    STUDIES_SQL
    + """
SELECT path AS value, 'read' AS failed_stage, NULL AS output FROM resolved WHERE NOT ok
UNION ALL
SELECT study, NULL, '{"resourceType":"Bundle","type":"batch","entry":[{"resource":'
  || '{"resourceType":"ImagingStudy","uid":"' || study_id || '","first":"' || first
  || '","frames":[' || json_extract_string(first_metadata, '$."00201208".Value[0]')
  || ']},"request":{"method":"PUT","url":"ImagingStudy"}}]}'
FROM studies
""",
)
def imaging_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = imaging_outcomes(
        notified_paths(spark, sf_dir), instance_metadata(spark, sf_dir), IMAGING_MAPPING
    )
    return outcomes.select("value", "failed_stage", "output")


@query("F5", "SELECT page_id, regexp_replace(url, '/+$', '') || '/*' AS glob FROM pages")
def glob_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", folder_glob(F.col("url")).alias("glob"))


def study_store(spark: SparkSession, sf_dir: str) -> StudyStore:
    """All instances in a store by key, from two batches."""
    store = StudyStore(spark, work_dir(spark, "study-store"), buckets=64)
    instances = instance_metadata(spark, sf_dir)
    late = F.col("instance_id") > "3"
    for batch, chosen in enumerate((~late, late)):
        store.append(instances.filter(chosen), batch)
    return store


def paths_of_users(events: DataFrame) -> DataFrame:
    """A path per event: the study that has the user's number, all over the store."""
    return events.select(
        text_of(
            STORE_PATH, "/dicomWeb/studies/", F.col("user_id"), "/series/1/instances/", F.col("event_id")
        ).alias("path")
    )


@query(
    "S12 L3",
    f"""{_WITH},
wanted AS (SELECT CAST(user_id AS VARCHAR) AS study_id, count(*) AS n_notifications FROM events GROUP BY ALL)
SELECT study_id, '[' || string_agg(metadata, ',' ORDER BY instance_id, metadata) || ']' AS study,
       any_value(n_notifications) AS n_notifications
FROM instances JOIN wanted USING (study_id) GROUP BY study_id""",
)
def stored_study_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scattered studies from a store that is read by key."""
    studies, _ = read_studies(paths_of_users(table(spark, sf_dir, "events")), study_store(spark, sf_dir))
    return studies.select("study_id", "study", "n_notifications")
