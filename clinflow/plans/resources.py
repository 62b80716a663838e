"""Resource log: current view, reads and searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.operators.resources import current_resources, read_resource, search_resources
from clinflow.plans.inputs import PATIENTS_SQL, RESOURCES_SQL, resource_log
from clinflow.plans.mapping import patient_transactions
from clinflow.plans.registry import query
from clinflow.session import work_dir
from clinflow.sinks.bundles import execute_bundles, resource_rows
from clinflow.sinks.current_view import CurrentView
from clinflow.sinks.field_index import IndexedView

_WITH = f"WITH {RESOURCES_SQL}"
_SELECT = "SELECT resource_type, id, version, seq, body FROM current_log"


@query("W5", f"{_WITH} {_SELECT}")
def resource_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_resources(resource_log(spark, sf_dir))


@query("S13", f"{_WITH} {_SELECT} WHERE id = '71'")
def resource_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_resource(resource_log(spark, sf_dir), "Encounter", "71")


@query("S14", f"{_WITH} {_SELECT}")
def resource_search_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_resources(resource_log(spark, sf_dir), "Encounter")


@query(
    "S14",
    f"""{_WITH} {_SELECT} WHERE json_extract_string(body, '$.status') = 'F'
AND json_extract_string(body, '$.priority') = '1-URGENT'""",
)
def resource_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"status": "F", "priority": "1-URGENT"}
    return search_resources(resource_log(spark, sf_dir), "Encounter", wanted)


@query(
    "W4 W5",
    f"""WITH {PATIENTS_SQL}
SELECT 'Patient' AS resource_type, id, CAST(0 AS BIGINT) AS version FROM patients""",
)
def executed_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "bundles")
    execute_bundles(patient_transactions(spark, sf_dir), path, 0)
    written = spark.read.parquet(path).select(
        "bundle", F.col("batch_id").alias("version"), F.xxhash64("bundle").alias("seq")
    )
    current = current_resources(resource_rows(written, "bundle", "version", "seq"))
    return current.select("resource_type", "id", "version")


_BATCHES = 4


def _batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The resource log by a checksum of the row, so that versions come in any order."""
    log = resource_log(spark, sf_dir)
    number = F.crc32(F.col("seq").cast("string").cast("binary")) % _BATCHES
    return [log.filter(number == batch) for batch in range(_BATCHES)]


def _view_of_batches(spark: SparkSession, sf_dir: str) -> CurrentView:
    """The runs are merged after the last but one, so that a reader finds a base and a run."""
    view = CurrentView(spark, work_dir(spark, "view"), buckets=16)
    for batch, rows in enumerate(_batches(spark, sf_dir)):
        view.append(rows, batch)
        if batch == _BATCHES - 2:
            view.compact()
    return view


@query("W5", f"{_WITH} {_SELECT}")
def resource_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view_of_batches(spark, sf_dir).read()


@query("S13", f"{_WITH} {_SELECT} WHERE id = '71'")
def resource_view_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view_of_batches(spark, sf_dir).lookup("Encounter", "71")


@query(
    "S14",
    f"""{_WITH} {_SELECT} WHERE json_extract_string(body, '$.status') = 'P'
AND json_extract_string(body, '$.priority') = '2-HIGH'""",
)
def resource_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fields, one of them with an index; many resources had the value in older versions only."""
    view = IndexedView(spark, work_dir(spark, "indexed"), ["status"])
    for batch, rows in enumerate(_batches(spark, sf_dir)):
        view.append(rows, batch)
    return view.search("Encounter", {"status": "P", "priority": "2-HIGH"})
