"""Search of current resources by field, through an inverted index.

The index has a row per field, value and resource, dealt into buckets by value, and says in which
bucket of the view the resource is. It is added to before the view, and never taken from: a resource
that has another value by now is found and then dropped, as its current body is looked at in the end.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.functions.jsonx import once
from clinflow.operators.lookups import lookup_join
from clinflow.operators.resources import with_fields
from clinflow.sinks.commits import CommitLog
from clinflow.sinks.current_view import KEY, CurrentView

BUCKETS = 64
ENTRY = (
    T.StructType()
    .add("resource_type", "string")
    .add("value", "string")
    .add("id", "string")
    .add("view_bucket", "integer")
)
LAID_OUT = T.StructType(list(ENTRY.fields)).add("field", "integer").add("bucket", "integer").add("run", "string")


class IndexedView:
    """A view with an index of some fields (paths as in ``search_resources``) at ``path``."""

    def __init__(
        self, spark: SparkSession, path: str, fields: list[str], view: CurrentView | None = None, buckets: int = BUCKETS
    ) -> None:
        self.spark, self.fields, self.buckets = spark, list(fields), buckets
        self.view = view or CurrentView(spark, f"{path}/view")
        self.log = CommitLog(spark, f"{path}/index")

    def _bucket(self, value: Column) -> Column:
        return F.pmod(F.xxhash64("resource_type", value), F.lit(self.buckets)).cast("int")

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """The rows of a batch, into the index and then into the view."""
        before = self.log.state()
        if before.batch is None or batch_id > before.batch:
            run = f"{batch_id:012d}-{uuid.uuid4().hex}"
            self._entries(rows).withColumn("run", F.lit(run)).repartition("field", "bucket").sortWithinPartitions(
                "field", "bucket", "value"
            ).write.mode("append").partitionBy("field", "bucket", "run").parquet(self.log.data)
            written = self.spark.read.schema(LAID_OUT).parquet(f"{self.log.data}/field=*/bucket=*/run={run}")
            part = F.regexp_extract(F.col("_metadata.file_path"), r"/(field=\d+/bucket=\d+)/run=", 1)
            sizes = written.groupBy(part.alias("part")).count().collect()
            self.log.commit(before, before.folders | {f"{r.part}/run={run}": r["count"] for r in sizes}, batch_id)
        self.view.append(rows, batch_id)

    def _entries(self, rows: DataFrame) -> DataFrame:
        parsed = rows.select(*KEY, once(F.try_parse_json("body")).alias("_doc"), self.view.bucket().alias("view_bucket"))
        values = [
            F.struct(F.lit(i).alias("field"), F.try_variant_get("_doc", f"$.{f}", "string").alias("value"))
            for i, f in enumerate(self.fields)
        ]
        each = parsed.select(*KEY, "view_bucket", F.explode(F.array(*values)).alias("_f"))
        found = each.select("resource_type", "_f.value", "id", "view_bucket", "_f.field").filter("value IS NOT NULL")
        return found.withColumn("bucket", self._bucket(F.col("value"))).distinct()

    def _hits(self, resource_type: str, field: str, value: str) -> DataFrame:
        """Resources that had the value in some version: bucket of the view and id."""
        here = self.spark.range(1).select(F.lit(resource_type).alias("resource_type"), F.lit(value).alias("value"))
        number = here.select(self._bucket(F.col("value")).alias("b")).first()["b"]
        part = f"field={self.fields.index(field)}/bucket={number}/"
        entries = self.log.read([f for f in self.log.state().folders if f.startswith(part)], LAID_OUT)
        chosen = entries.filter((F.col("resource_type") == resource_type) & (F.col("value") == value))
        return chosen.select("view_bucket", "id").distinct()

    def search(self, resource_type: str, parameters: dict[str, str]) -> DataFrame:
        """Current resources of a type whose fields all have the given values.

        Of the view the buckets with hits are read. Fields without an index only narrow what the
        others find; if none has one, all of the type are looked at.
        """
        hits = [self._hits(resource_type, f, v) for f, v in parameters.items() if f in self.fields]
        if not hits:
            return with_fields(self.view.read().filter(F.col("resource_type") == resource_type), parameters)
        both = reduce(lambda a, b: a.join(b, ["view_bucket", "id"], "left_semi"), hits)
        numbers = sorted(r.view_bucket for r in both.select("view_bucket").distinct().collect())
        rows = self.view.of_buckets(numbers).filter(F.col("resource_type") == resource_type)
        found = lookup_join(rows, both.select("id"), ["id"], "left_semi")
        return with_fields(found.select(*rows.columns), parameters)
