"""DICOM web paths split into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.functions.jsonx import once
from clinflow.schemas import WEB_PATH_FIELDS

# The separator and the position of each part of a path.
SEPARATOR = "/dicomWeb/"
STORE_PARTS = {"project": 2, "location": 4, "dataset": 6, "store_id": 8}
SEARCH_PARTS = {"study_id": 2, "series_id": 4, "instance_id": 6}


def _pieces(text: Column) -> Column:
    """Split at slashes; empty pieces at the end do not count."""
    slash = F.lit("/")
    return F.split(F.when(F.endswith(text, slash), F.rtrim(text, slash)).otherwise(text), "/")


def with_web_path(df: DataFrame, path: str = "path") -> DataFrame:
    """P5: add the eight columns; all are null when the path does not hold them.

    The path is split at its only separator, then each half at slashes. A separator at the end
    separates nothing.
    """
    given = F.col(path)
    ended = F.when(
        given.endswith(SEPARATOR), F.regexp_replace(given, f"(?:{SEPARATOR})+$", "")
    ).otherwise(given)
    store_path = F.substring_index(ended, SEPARATOR, 1)
    # What follows the first separator; if that is the last one too, it is found without counting.
    tail = F.substring_index(ended, SEPARATOR, -1)
    only_one = F.octet_length(store_path) + F.octet_length(tail) + len(
        SEPARATOR
    ) == F.octet_length(ended)
    skipped = F.length(store_path) + F.lit(len(SEPARATOR) + 1)
    rest = F.when(only_one, tail).otherwise(F.substring(ended, skipped, F.length(ended)))
    halves = F.struct(store_path.alias("store"), rest.alias("rest"))
    found = F.contains(ended, F.lit(SEPARATOR))
    split = (
        df.withColumn("_halves", once(F.when(found, halves)))
        .withColumn("_store", once(_pieces(F.col("_halves.store"))))
        .withColumn("_search", once(_pieces(F.col("_halves.rest"))))
    )
    valid = (
        (F.size("_store") >= max(STORE_PARTS.values()))
        & (F.size("_search") >= max(SEARCH_PARTS.values()))
        & ~F.contains(F.col("_halves.rest"), F.lit(SEPARATOR))
    )
    parts = {name: F.try_element_at("_store", F.lit(i)) for name, i in STORE_PARTS.items()}
    parts["dicom_store_path"] = F.col("_halves.store")
    parts |= {name: F.try_element_at("_search", F.lit(i)) for name, i in SEARCH_PARTS.items()}
    return split.select(
        *df.columns, *[F.when(valid, parts[name]).alias(name) for name in WEB_PATH_FIELDS]
    )
