"""User functions over batches of rows, with failures as rows.

The function gets one pandas batch at a time, inside tasks; Spark partitions the work. A batch that
fails is halved and tried again until the bad rows stand alone, so that each rejects only itself.
Input columns pass by as they are, and integers come in a type that has a missing value, so that
they stay exact beside one.
"""

import traceback
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

import clinflow
from clinflow.operators.outcomes import error_entry
from clinflow.schemas import ERROR_ENTRY

# Functions of this package travel to the workers by value, so it need not be installed there.
cloudpickle.register_pickle_by_value(clinflow)

_EXACT = {
    pa.int8(): pd.Int8Dtype(),
    pa.int16(): pd.Int16Dtype(),
    pa.int32(): pd.Int32Dtype(),
    pa.int64(): pd.Int64Dtype(),
    pa.bool_(): pd.BooleanDtype(),
}

_RAW_ERROR = T.StructType(
    [
        T.StructField("error_class", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("stack_trace", T.StringType()),
    ]
)


@dataclass(frozen=True)
class OfRow:
    """A function of single rows that needs no frames: it gets the values of a row by name, and returns
    those of the output columns in their order. A frame for each row costs more than most calls."""

    call: Callable[[dict[str, Any]], tuple]


def guarded_map(
    df: DataFrame,
    make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame] | OfRow],
    schema: T.StructType,
    step: str,
    resource: str | None = None,
    sources: str | None = None,
    recoverable: tuple[str, ...] = ("RuntimeError",),
    one_by_one: bool = False,
) -> DataFrame:
    """Apply a user function and keep its failures.

    ``make`` is called once per task and returns the function, so that a client is opened once for
    many batches. The function returns one row of ``schema`` per input row. The result has the input
    columns, the output columns, ``ok``, ``error`` and ``fatal`` — true when the exception is of
    none of the ``recoverable`` classes, subclasses not included. ``report_then_fail`` acts on it.
    With ``one_by_one`` the function gets single rows, each once per task: for calls that have an
    effect and must not be repeated for the sake of other rows. An ``OfRow`` always does.
    """
    names = [f.name for f in schema.fields]
    clash = set(names) & set(df.columns)
    if clash:
        raise ValueError(f"output columns {sorted(clash)} are input columns already")

    out_schema = T.StructType(df.schema.fields + schema.fields + _RAW_ERROR.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        kinds = {f.name: to_arrow_type(f.dataType) for f in schema.fields}
        for batch in batches:
            if isinstance(fn, OfRow):
                made = _guard_rows(fn, batch, kinds)
            else:
                made = _guard(fn, batch.to_pandas(types_mapper=_EXACT.get), kinds, one_by_one)
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=out_schema.names)

    mapped = df.mapInArrow(run, out_schema)
    failed = F.col("error_class").isNotNull()
    entry = error_entry(
        F.col("error_message"),
        step,
        resource=None if resource is None else F.col(resource).cast("string"),
        sources=None if sources is None else F.array(F.col(sources).cast("string")),
        stack_trace=F.col("stack_trace"),
    )
    return mapped.select(
        *df.columns,
        *names,
        (~failed).alias("ok"),
        F.when(failed, entry).cast(ERROR_ENTRY).alias("error"),
        (failed & ~F.col("error_class").isin(*recoverable)).alias("fatal"),
    )


def _guard(
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    batch: pd.DataFrame,
    kinds: dict[str, pa.DataType],
    one_by_one: bool,
) -> list[pa.Array]:
    """The output columns and those of the failures, in the order of the rows.

    What fails is halved until single rows are left.
    """
    parts: list[list[pa.Array]] = [[pa.array([], k) for k in kinds.values()]]
    failures: list[tuple[str, str, str] | None] = []
    step = 1 if one_by_one else max(1, len(batch))
    ranges = [(at, min(at + step, len(batch))) for at in range(0, len(batch), step)][::-1]
    while ranges:
        start, end = ranges.pop()
        try:
            out = fn(batch.iloc[start:end].reset_index(drop=True))
            if len(out) != end - start:
                raise RuntimeError("one output row per input row is expected")
            made = [pa.Array.from_pandas(out[name], type=kind) for name, kind in kinds.items()]
            parts.append([m.combine_chunks() if isinstance(m, pa.ChunkedArray) else m for m in made])
            failures += [None] * (end - start)
        except Exception as e:  # noqa: BLE001 - the failure becomes a row
            if end - start == 1:
                parts.append([pa.nulls(1, kind) for kind in kinds.values()])
                failures.append((type(e).__name__, str(e), traceback.format_exc()))
            else:
                middle = (start + end) // 2
                ranges += [(middle, end), (start, middle)]
    return [pa.concat_arrays(column) for column in zip(*parts)] + _causes(failures)


def _guard_rows(fn: OfRow, batch: pa.RecordBatch, kinds: dict[str, pa.DataType]) -> list[pa.Array]:
    """The same for a function of rows, each called once."""
    none = (None,) * len(kinds)
    values: list[tuple] = []
    failures: list[tuple[str, str, str] | None] = []
    for row in batch.to_pylist():
        try:
            out = fn.call(row)
            if len(out) != len(kinds):
                raise RuntimeError("one value per output column is expected")
            values.append(tuple(pa.scalar(v, k) for v, k in zip(out, kinds.values())))
            failures.append(None)
        except Exception as e:  # noqa: BLE001 - the failure becomes a row
            values.append(none)
            failures.append((type(e).__name__, str(e), traceback.format_exc()))
    columns = zip(*values) if values else [()] * len(kinds)
    return [pa.array(c, kind) for c, kind in zip(columns, kinds.values())] + _causes(failures)


def _causes(failures: list[tuple[str, str, str] | None]) -> list[pa.Array]:
    """Class, message and trace of each row's failure."""
    return [pa.array([f and f[i] for f in failures], pa.string()) for i in range(3)]


def row_function(
    fn: Callable[[pd.Series], pd.Series], returns: T.DataType | str
) -> Callable[..., Column]:
    """A plain function of one column, for what column expressions cannot say."""

    def apply(values: pd.Series) -> pd.Series:
        return fn(values)

    return F.pandas_udf(apply, returns)
