"""The current state of resources, kept up batch by batch.

Keys are dealt into buckets by hash. Each batch adds a run to the buckets it touches: its newest row
per resource, sorted by key. A reader merges by keys alone: which run holds the newest version of a
key is worked out from the key columns of the runs and of those base rows that they name, and sent
to the tasks that scan the bodies. So bodies are neither shuffled nor sorted to be read. The runs
are kept few: when their keys, whose bytes the log knows, are no longer small, they are merged into
the base of their buckets, and the files of other buckets stay as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.operators.resources import current_resources
from clinflow.sinks.commits import CommitLog

KEY = ["resource_type", "id"]
ROW = (
    T.StructType()
    .add("resource_type", "string")
    .add("id", "string")
    .add("version", "long")
    .add("seq", "long")
    .add("body", "string")
)
LAID_OUT = T.StructType(list(ROW.fields)).add("bucket", "integer").add("run", "string")
BUCKETS = 64
#: Bytes of the keys that all runs have together at most, after a batch: readers broadcast them.
#: Runs beyond that, as after a large batch, are merged by a join that is shuffled.
RUN_BYTES = 16 * 1024 * 1024


class CurrentView:
    """The view at ``path``; ``buckets`` is fixed when it is first written."""

    def __init__(
        self, spark: SparkSession, path: str, buckets: int = BUCKETS, run_bytes: int = RUN_BYTES
    ) -> None:
        self.spark, self.buckets, self.run_bytes = spark, buckets, run_bytes
        self.log = CommitLog(spark, path)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*KEY), F.lit(self.buckets)).cast("int")

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """The rows of a batch; one that was committed before changes nothing."""
        before = self.log.state()
        if before.batch is not None and batch_id <= before.batch:
            return
        newest = current_resources(rows.select(*ROW.fieldNames()))
        folders = self._write(newest, f"r{batch_id:012d}-{uuid.uuid4().hex}")
        after = self.log.commit(before, before.folders | folders, batch_id)
        if _run_bytes(after.folders) > self.run_bytes:
            self.compact()

    def _write(self, rows: DataFrame, run: str) -> dict[str, int]:
        """Rows as one run per bucket, and the bytes of each one's keys, with some for versions."""
        dealt = rows.withColumns({"bucket": self.bucket(), "run": F.lit(run)})
        sorted_rows = dealt.repartition("bucket").sortWithinPartitions("bucket", *KEY)
        sorted_rows.write.mode("append").partitionBy("bucket", "run").parquet(self.log.data)
        written = self.spark.read.schema(LAID_OUT).parquet(f"{self.log.data}/bucket=*/run={run}")
        names = F.element_at(F.split(F.col("_metadata.file_path"), "/bucket="), -1)
        size = F.lit(64) + sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in KEY)
        named = written.select(F.regexp_extract(names, r"^(\d+)/", 1).alias("b"), size.alias("size"))
        sizes = named.groupBy("b").agg(F.sum("size").alias("size"))
        return {f"bucket={r.b}/run={run}": r["size"] for r in sizes.collect()}

    def read(self) -> DataFrame:
        """The current state of all resources."""
        return self._merged(self.log.state().folders)

    def lookup(self, resource_type: str, resource_id: str) -> DataFrame:
        """One resource, from its bucket alone."""
        here = self.spark.range(1).select(
            F.lit(resource_type).alias("resource_type"), F.lit(resource_id).alias("id")
        )
        number = here.select(self.bucket().alias("b")).first()["b"]
        return self.of_buckets([number]).filter(
            (F.col("resource_type") == resource_type) & (F.col("id") == resource_id)
        )

    def of_buckets(self, numbers: list[int]) -> DataFrame:
        """The current state of the resources in some buckets; no other file is opened."""
        wanted = {f"bucket={n}" for n in numbers}
        return self._merged({f: n for f, n in self.log.state().folders.items() if f.split("/")[0] in wanted})

    def _merged(self, folders: dict[str, int]) -> DataFrame:
        small = _run_bytes(folders) <= self.run_bytes
        sent = F.broadcast if small else lambda df: df
        runs = [f for f in folders if _is_run(f)]
        base = self.log.read([f for f in folders if not _is_run(f)], LAID_OUT)
        added = self.log.read(runs, LAID_OUT)
        columns = ROW.fieldNames()
        if not runs:
            return base.select(*columns)
        rank = [*KEY, "version", "seq", "run"]
        named = added.select(*KEY).distinct()
        rivals = base.select(*rank).join(sent(named), KEY, "left_semi")
        # The base has the name that sorts first, so that of equal versions the earlier row stays.
        newest = F.max_by("run", F.struct("version", "seq", _first(F.col("run"))))
        winners = rivals.union(added.select(*rank)).groupBy(*KEY).agg(newest.alias("run"))
        won = sent(winners.filter(F.col("run").startswith("r")))
        kept = base.join(won.select(*KEY), KEY, "left_anti").select(*columns)
        return kept.union(added.join(won, [*KEY, "run"], "left_semi").select(*columns))

    def compact(self, numbers: list[int] | None = None) -> None:
        """Merge the runs of some buckets, or of all that have any, into their bases."""
        before = self.log.state()
        chosen = {f.split("/")[0] for f in before.folders if _is_run(f)}
        if numbers is not None:
            chosen &= {f"bucket={n}" for n in numbers}
        old = {f: n for f, n in before.folders.items() if f.split("/")[0] in chosen}
        if not old:
            return
        folders = self._write(self._merged(old), f"base-{before.number:012d}-{uuid.uuid4().hex}")
        kept = {f: n for f, n in before.folders.items() if f not in old}
        self.log.commit(before, kept | folders, None)


def _is_run(folder: str) -> bool:
    return "/run=r" in folder


def _run_bytes(folders: dict[str, int]) -> int:
    return sum(n for f, n in folders.items() if _is_run(f))


def _first(run: Column) -> Column:
    """A number that is larger for an earlier run; that of a base is the largest."""
    number = F.try_to_number(F.substring(run, 2, 12), F.lit("000000000000"))
    return F.when(run.startswith("r"), -number.cast("long")).otherwise(F.lit(1).cast("long"))
