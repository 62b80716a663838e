"""Table rows and form answers as JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.functions.text import base64_text
from clinflow.functions.times import us_date_to_iso
from clinflow.operators.lookups import lookup_join
from clinflow.operators.tables import run_queries, to_json_rows
from clinflow.plans.registry import query
from clinflow.session import spread_table, table
from clinflow.sources.forms import QUESTIONS, form_payload


@query(
    "S15 J9",
    """
SELECT 'Region' AS "table", '{"Region":{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name
  || '"}}' AS document FROM region
UNION ALL
SELECT 'Nation', '{"Nation":{"key":' || n_nationkey || ',"name":"' || n_name || '"}}' FROM nation
UNION ALL
SELECT 'Segment', '{"Segment":{"segment":"' || c_mktsegment || '","customers":' || count(*) || '}}'
FROM customer GROUP BY c_mktsegment
""",
)
def table_rows_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("region", "nation", "customer"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"clinflow_{name}")
    return run_queries(
        spark,
        {
            "Region": "SELECT * FROM clinflow_region",
            "Nation": "SELECT n_nationkey AS key, n_name AS name FROM clinflow_nation",
            "Segment": "SELECT c_mktsegment AS segment, count(*) AS customers "
            "FROM clinflow_customer GROUP BY c_mktsegment",
        },
    )


@query(
    "J9",
    """
SELECT 'Supplier' AS "table", '{"Supplier":{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name
  || '","s_nationkey":' || s_nationkey || '}}' AS document FROM supplier
""",
)
def supplier_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").drop("s_acctbal")
    return to_json_rows(rows, "Supplier")


_FORM_SQL = """
WITH forms AS (
  SELECT o_orderkey, '{"fname":"' || c_mktsegment || '","mname":"' || o_orderpriority
    || '","lname":"' || c_name || '","sex":"' || o_orderstatus || '","dob":"'
    || strftime(o_orderdate, '%Y-%m-%d') || '","ht":"' || c_nationkey || '","wt":"' || o_custkey
    || '","cn":"' || o_orderkey || '","addruse":"home","email":"' || c_name || '@example.com"}'
    AS payload
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def _form_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filled form per order; some questions are not answered."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey"
    )
    orders = lookup_join(spread_table(spark, sf_dir, "orders"), customers, ["o_custkey"], "inner")
    answers = {
        "fname": F.col("c_mktsegment"),
        "mname": F.col("o_orderpriority"),
        "lname": F.col("c_name"),
        "sex": F.col("o_orderstatus"),
        "dob": F.date_format("o_orderdate", "M/d/yyyy"),
        "ht": F.col("c_nationkey").cast("string"),
        "wt": F.col("o_custkey").cast("string"),
        "cn": F.col("o_orderkey").cast("string"),
        "addruse": F.lit("home"),
        "email": F.concat("c_name", F.lit("@example.com")),
    }
    pairs = [x for k, v in answers.items() for x in (F.lit(QUESTIONS[k]), F.array(v))]
    return orders.select("o_orderkey", F.create_map(*pairs).alias("named_values"))


@query("S18 F6", _FORM_SQL + "SELECT o_orderkey, payload FROM forms")
def form_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return form_payload(_form_rows(spark, sf_dir)).select("o_orderkey", "payload")


@query("F7 S18", _FORM_SQL + "SELECT o_orderkey, base64(encode(payload)) AS data FROM forms")
def form_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = form_payload(_form_rows(spark, sf_dir))
    return payloads.select("o_orderkey", base64_text(F.col("payload")).alias("data"))


@query("F7", "SELECT doc_id, base64(encode(text)) AS data FROM documents")
def document_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread_table(spark, sf_dir, "documents")
    return documents.select("doc_id", base64_text(F.col("text")).alias("data"))


@query(
    "F6",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS fixed, CAST(NULL AS VARCHAR) AS broken"
    " FROM orders",
)
def date_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    written = F.date_format("o_orderdate", "M/d/yyyy")
    return orders.select(
        "o_orderkey",
        us_date_to_iso(written).alias("fixed"),
        us_date_to_iso(F.col("o_orderpriority")).alias("broken"),
    )
