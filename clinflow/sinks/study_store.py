"""Instances of imaging studies, stored so that studies are read by key.

Rows are dealt into buckets by a hash of the study's key and sorted by it, so that one study lies in
one bucket, next to itself. A reader that wants some studies opens the files of their buckets only,
however far apart their ids are; in them the sorted ids and Bloom filters skip row groups. Each batch
adds a run to the buckets it touches, and readers see committed runs only.
"""

from __future__ import annotations

import uuid
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.operators.lookups import lookup_join
from clinflow.sinks.commits import CommitLog

STUDY_KEY = ["dicom_store_path", "study_id"]
INSTANCE = (
    T.StructType()
    .add("dicom_store_path", "string")
    .add("study_id", "string")
    .add("instance_id", "string")
    .add("metadata", "string")
)
LAID_OUT = T.StructType(list(INSTANCE.fields)).add("bucket", "integer").add("run", "string")
BUCKETS = 256
#: Ids that are handed to the file reader one by one; beyond that their buckets have to do.
PUSHED_IDS = 64
#: Studies in a row group that its Bloom filter is laid out for.
BLOOM_STUDIES = 100_000


class StudyStore:
    """The store at ``path``; ``buckets`` is fixed when it is first written."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.buckets = spark, buckets
        self.log = CommitLog(spark, path)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*STUDY_KEY), F.lit(self.buckets)).cast("int")

    def append(self, instances: DataFrame, batch_id: int) -> None:
        """Add the instances of a batch; one that was committed before changes nothing."""
        before = self.log.state()
        if before.batch is not None and batch_id <= before.batch:
            return
        folders = self._write(instances, f"{batch_id:012d}-{uuid.uuid4().hex}")
        self.log.commit(before, before.folders | folders, batch_id)

    def _write(self, instances: DataFrame, run: str) -> dict[str, int]:
        """Rows as one run per bucket, and how many each has."""
        rows = instances.select(*INSTANCE.fieldNames()).withColumns({"bucket": self.bucket(), "run": F.lit(run)})
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket", *STUDY_KEY, "instance_id")
        (
            dealt.write.mode("append")
            .option("parquet.bloom.filter.enabled#study_id", "true")
            .option("parquet.bloom.filter.expected.ndv#study_id", str(BLOOM_STUDIES))
            .partitionBy("bucket", "run")
            .parquet(self.log.data)
        )
        written = self.spark.read.schema(LAID_OUT).parquet(f"{self.log.data}/bucket=*/run={run}")
        part = F.element_at(F.split(F.col("_metadata.file_path"), "/bucket="), -1)
        sizes = written.groupBy(F.regexp_extract(part, r"^(\d+)/", 1).alias("b")).count().collect()
        return {f"bucket={r.b}/run={run}": r["count"] for r in sizes}

    def compact(self, runs: int = 8) -> None:
        """Write the buckets that have so many runs, or more, anew as one run each; the files of other
        buckets stay as they are."""
        before = self.log.state()
        held = Counter(f.split("/")[0] for f in before.folders)
        old = [f for f in before.folders if held[f.split("/")[0]] >= max(runs, 2)]
        if old:
            folders = self._write(self.log.read(old, LAID_OUT), f"merged-{before.number:012d}-{uuid.uuid4().hex}")
            kept = {f: n for f, n in before.folders.items() if f not in set(old)}
            self.log.commit(before, kept | folders, None)

    def read(self) -> DataFrame:
        """All instances."""
        return self.log.read(list(self.log.state().folders), LAID_OUT).select(*INSTANCE.fieldNames())

    def of(self, wanted: DataFrame, **limits: int) -> DataFrame:
        """The instances of the studies in ``wanted``, which has a row per study and was written;
        its other columns are joined to them."""
        numbers = sorted(r.b for r in wanted.select(self.bucket().alias("b")).distinct().collect())
        here = {f"bucket={n}" for n in numbers}
        folders = [f for f in self.log.state().folders if f.split("/")[0] in here]
        rows = self.log.read(folders, LAID_OUT).filter(F.col("bucket").isin(numbers))
        ids = wanted.select("study_id").distinct().limit(PUSHED_IDS + 1).collect()
        if 0 < len(ids) <= PUSHED_IDS:
            rows = rows.filter(reduce(Column.__or__, [F.col("study_id") == r.study_id for r in ids]))
        return lookup_join(rows.select(*INSTANCE.fieldNames()), wanted, STUDY_KEY, "inner", **limits)
