"""Session-level helpers: working folders and table access."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

MIN_SPREAD_BYTES = 1024 * 1024
#: Inputs over this size are read as they are split.
MAX_SPREAD_BYTES = 256 * 1024 * 1024

_local_bases: dict[str, tempfile.TemporaryDirectory] = {}


def work_base(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that leaves it unset
    gets a folder of its own, which goes with the process; a cluster without the setting is an
    error, because a folder on one machine is lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_bases:
        _local_bases[app] = tempfile.TemporaryDirectory(prefix="clinflow-", ignore_cleanup_errors=True)
    return _local_bases[app].name


def work_folder(spark: SparkSession) -> str:
    """The one folder below :func:`work_base` that holds all working data of this application.

    Results are read from it as long as they are used; whoever runs the application removes it at
    the end.
    """
    return f"{work_base(spark)}/clinflow-{spark.sparkContext.applicationId}"


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`work_folder`; never reused between runs."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: worked out once, with a short lineage and a known size."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, size: int | None = None) -> DataFrame:
    """Rows that come in fewer partitions than there are cores, over more of them.

    For costly row work on input from few files; with ``size`` in bytes, small input takes few
    cores. Input from many files is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = cores if size is None else min(cores, size // MIN_SPREAD_BYTES)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = table(spark, sf_dir, name)
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return spread(df, size) if size <= MAX_SPREAD_BYTES else df


def stream_table(
    spark: SparkSession, sf_dir: str, name: str, per_trigger: int | None = None
) -> DataFrame:
    """The same table as a stream, be it one file or a folder of files.

    ``per_trigger`` is how many files a micro-batch takes at most; without it, it takes all.
    """
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(hadoop_path).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
