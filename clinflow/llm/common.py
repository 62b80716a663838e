"""What the text operators share: words, whole rows beside derived columns, measured joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import clinflow
from clinflow.session import work_dir, written
from clinflow.sinks.files import remove_listed

# Functions of this package travel to the workers by value, so it need not be installed there.
cloudpickle.register_pickle_by_value(clinflow)

#: White space between words: the code points x20 and x09 to x0D.
GAP = "[\\x20\\x09-\\x0D]+"

#: Largest table, in bytes of its rows, that is sent to every executor.
BROADCAST_BYTES = 32 * 1024 * 1024


def words_of(text: Column) -> Column:
    """Maximal runs of code points that are no white space; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def whole_row(docs: DataFrame, keep: list[str] | None = None) -> Column:
    """Struct ``row`` of the columns in ``keep``, or all: what an operator adds beside it can't clash
    with a column of the input, whatever that is called."""
    return F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")


_own: ContextVar[list[str] | None] = ContextVar("tables of the call", default=None)


@contextmanager
def own_tables() -> Iterator[list[str]]:
    """The working tables that this thread makes inside, for whoever wants to remove them after.

    Tables that nobody lists stay until the application's folder is removed.
    """
    paths: list[str] = []
    token = _own.set(paths)
    try:
        yield paths
    finally:
        _own.reset(token)


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: worked out once, survives a lost executor."""
    path = work_dir(df.sparkSession, label)
    if (paths := _own.get()) is not None:
        paths.append(path)
    return written(df, path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``build`` returns, written; the working tables that it made on the way are removed."""
    with own_tables() as paths:
        path = work_dir(spark, label)
        result = written(build(), path)
    remove_listed(spark, paths)
    if (outer := _own.get()) is not None:
        outer.append(path)
    return result


def sent(df: DataFrame, value: Any) -> Broadcast:
    """An object for every executor; a task gets it with :func:`received`. Its class goes along."""
    return df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))


def received(broadcast: Broadcast) -> Any:
    return cloudpickle.loads(broadcast.value)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: Python objects are made for few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def small_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join with a written table ``right``, unique by ``on``, that may or may not be small.

    Its rows are counted and all their fields of varying length, nested ones too, are measured first.
    Up to :data:`BROADCAST_BYTES` it is broadcast; beyond, the join is shuffled, and adaptive
    execution splits the hot keys of ``left``.
    """
    size = right.agg(F.sum(row_bytes(right))).first()[0] or 0
    return left.join(F.broadcast(right) if size <= BROADCAST_BYTES else right, on, how)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: a fixed part, and the length of what has no fixed one."""
    size = F.lit(32 + 16 * len(df.columns))
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return size.cast("long")
