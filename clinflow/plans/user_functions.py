"""User functions over whole tables, guarded and plain."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.operators.guarded import guarded_map, row_function
from clinflow.operators.outcomes import StageFailure, report_then_fail, split_ok
from clinflow.plans.registry import query
from clinflow.schemas import ERROR_ROW
from clinflow.session import spread_table, work_dir
from clinflow.sinks.errors import write_error_entries

_LENGTH = T.StructType([T.StructField("n_letters", T.LongType())])


def _make_counter():
    """Counts characters; French texts are refused."""

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["lang"] == "fr").any():
            raise ValueError("no French texts")
        return pd.DataFrame({"n_letters": batch["text"].str.len()})

    return count


def _counted(spark: SparkSession, sf_dir: str, recoverable: tuple[str, ...]) -> DataFrame:
    documents = spread_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return guarded_map(
        documents,
        _make_counter,
        _LENGTH,
        "CountLetters",
        resource="text",
        sources="doc_id",
        recoverable=recoverable,
    )


@query(
    "U1 E1",
    "SELECT doc_id, length(text) AS n_letters FROM documents WHERE lang <> 'fr'",
)
def guarded_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_ok(_counted(spark, sf_dir, ("ValueError",)))
    return good.select("doc_id", "n_letters")


@query(
    "U1 E1 E2 E3",
    """SELECT doc_id, text AS error_resource, 'no French texts' AS error_message,
'CountLetters' AS step, '["' || doc_id || '"]' AS sources, false AS fatal
FROM documents WHERE lang = 'fr'""",
)
def guarded_map_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_ok(_counted(spark, sf_dir, ("ValueError",)))
    return bad.select(
        "doc_id",
        "error.error_resource",
        "error.error_message",
        "error.step",
        F.to_json("error.sources").alias("sources"),
        "fatal",
    )


@query(
    "E2 E1 W7",
    """SELECT 'no French texts' AS error_message, 'CountLetters' AS step,
'["' || doc_id || '"]' AS sources FROM documents WHERE lang = 'fr'""",
)
def reported_then_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors that must stop the job are in the dead letter when it stops."""
    path = work_dir(spark, "reported")
    _, bad = split_ok(_counted(spark, sf_dir, ()))
    try:
        report_then_fail(bad, F.col("fatal"), lambda rejected: write_error_entries(rejected, path))
    except StageFailure:
        rows = spark.read.schema(ERROR_ROW).json(path)
        return rows.select("error_message", "step", F.to_json("sources").alias("sources"))
    raise AssertionError("no row stopped the job")


def _composed(values: pd.Series) -> pd.Series:
    return values.map(lambda text: unicodedata.normalize("NFC", text))


@query("U2", "SELECT doc_id, nfc_normalize(text) AS composed FROM documents")
def plain_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    compose = row_function(_composed, "string")
    return spread_table(spark, sf_dir, "documents").select("doc_id", compose("text").alias("composed"))
