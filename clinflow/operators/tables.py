"""Table rows as JSON documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_json(table: str, columns: list[str]) -> Column:
    """``{"table":{column:value,…}}``."""
    return F.to_json(F.struct(F.struct(*[F.col(f"`{c}`") for c in columns]).alias(table)))


def to_json_rows(df: DataFrame, table: str) -> DataFrame:
    return df.select(F.lit(table).alias("table"), row_json(table, df.columns).alias("document"))


def run_queries(spark: SparkSession, queries: dict[str, str]) -> DataFrame:
    """Run each named query and unite their rows as documents."""
    if not queries:
        raise ValueError("no queries given")
    parts = [to_json_rows(spark.sql(sql), name) for name, sql in queries.items()]
    return reduce(DataFrame.unionByName, parts)
