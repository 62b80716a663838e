"""Parsed messages: an order is a message, its lines are the segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.operators.outcomes import split_ok
from clinflow.operators.segments import flatten_segments, nest_segments, parsed_messages
from clinflow.plans.registry import query
from clinflow.session import spread_table, table

_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]

_NESTED_SQL = """
WITH segments AS (
  SELECT *, '{"segmentId":"' || l_returnflag || l_linestatus || '","fields":{"1":"' || l_partkey
    || '","2":"' || l_suppkey || '","3":"' || CAST(l_quantity AS INTEGER) || '"}}' AS segment
  FROM lineitem)
"""


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.create_map(
        F.lit("1"),
        F.col("l_partkey").cast("string"),
        F.lit("2"),
        F.col("l_suppkey").cast("string"),
        F.lit("3"),
        F.col("l_quantity").cast("int").cast("string"),
    )
    segment_id = F.concat("l_returnflag", "l_linestatus")
    lines = spread_table(spark, sf_dir, "lineitem")
    return nest_segments(lines, ["l_orderkey"], _ORDER, segment_id, fields)


@query(
    "J12",
    _NESTED_SQL
    + """
SELECT l_orderkey, '{"segments":[' || string_agg(segment, ','
  ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag || l_linestatus, l_quantity) || ']}'
  AS parsed
FROM segments GROUP BY l_orderkey
""",
)
def segments_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested(spark, sf_dir)


@query(
    "J12",
    """
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
         l_suppkey, l_returnflag || l_linestatus, l_quantity) - 1 AS INTEGER) AS position,
       l_returnflag || l_linestatus AS segment_id, CAST(l_partkey AS VARCHAR) AS part_key,
       CAST(l_suppkey AS VARCHAR) AS supplier_key,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity
FROM lineitem
""",
)
def segments_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_segments(_nested(spark, sf_dir), "parsed", ["l_orderkey"])
    return flat.select(
        "l_orderkey",
        "position",
        "segment_id",
        F.col("fields")["1"].alias("part_key"),
        F.col("fields")["2"].alias("supplier_key"),
        F.col("fields")["3"].alias("quantity"),
    )


@query(
    "J12 P13",
    """
SELECT 'd' || doc_id AS rid, false AS ok, text AS error_resource FROM documents
UNION ALL SELECT 'o' || l_orderkey, true, NULL FROM lineitem GROUP BY l_orderkey
""",
)
def segments_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages, and document texts as texts that are none; what can't be parsed is rejected."""
    messages = _nested(spark, sf_dir).selectExpr("concat('o', l_orderkey) AS rid", "parsed")
    texts = table(spark, sf_dir, "documents").selectExpr("concat('d', doc_id)", "text")
    checked = parsed_messages(messages.union(texts), "parsed", ["rid"])
    return checked.select("rid", "ok", "error.error_resource")
