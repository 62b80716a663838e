"""Writes that can be repeated, and removal of files that are done with."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Writes the rows of a batch to a table, given its path and the batch's number.
Writer = Callable[..., None]
#: Calls to the file system that run at a time.
_CALLS = 32


def batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def write_batch(
    df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()
) -> None:
    """The rows of one batch in a folder of their own; a repeated batch replaces itself."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(batch_path(path, batch_id))


def write_folders(lines: DataFrame, path: str, batch_id: int) -> None:
    """The lines (``value``) of one batch in folders named after their ``folder``; a repeated
    batch replaces itself.

    A folder has one file, streamed by one task. For many small folders: the tasks write with Arrow,
    under names that a retry writes again. Spark's writer has the files put in place by the driver, one
    by one, and costs some 20 ms for each on a local disk.
    """
    target = batch_path(path, batch_id)
    remove_listed(lines.sparkSession, [target])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = pafs.FileSystem.from_uri(target)
        name = f"part-{TaskContext.get().partitionId():05d}.txt"
        rows = (r for b in batches for r in zip(b.column("folder").to_pylist(), b.column("value").to_pylist()))
        n = 0
        for folder, held in groupby(rows, itemgetter(0)):
            files.create_dir(f"{top}/{folder}", recursive=True)
            with files.open_output_stream(f"{top}/{folder}/{name}") as out:
                for _, value in held:
                    out.write(value.encode() + b"\n")
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    whole = lines.select("folder", "value").repartition("folder")
    whole.sortWithinPartitions("folder").mapInArrow(run, "n long").agg(F.sum("n")).collect()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder now; nothing if there is no such folder."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*")
    fs = glob.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in fs.globStatus(glob) or []]


def remove_listed(spark: SparkSession, files: list[str]) -> None:
    """Delete files or folders, many at a time; a missing one is no error."""
    conf = spark._jsc.hadoopConfiguration()

    def remove(name: str) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)

    with ThreadPoolExecutor(_CALLS) as pool:
        for _ in pool.map(remove, files):
            pass


def remove_files(spark: SparkSession, path: str) -> int:
    """Delete what lies in a folder; a missing folder or file is no error."""
    files = list_files(spark, path)
    remove_listed(spark, files)
    return len(files)
