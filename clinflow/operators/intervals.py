"""Joins of points with uneven intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.operators.lookups import is_small

_BIN = "_bin"


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    at: Column,
    start: str,
    end: str,
    width: int,
    by: list[str] | None = None,
) -> DataFrame:
    """L4: each point with the intervals ``[start, end)`` that hold it, of those that agree in ``by``
    (missing values agree too).

    Time is cut into bins of ``width``. An interval has a row per bin that it touches, and a point
    looks into its own bin alone, so that the join is on equal bins and what it compares is as much
    as lies in one. Choose ``width`` about as long as the intervals are. ``by`` and the bounds are
    columns of ``intervals``, all of which are added to the point; those of ``by`` are the point's.
    Points without a place are in no interval. The intervals are broadcast if they are small.
    """
    by = by or []
    named = intervals.withColumnsRenamed({c: f"_by_{c}" for c in by})
    bins = F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))
    binned = named.filter(F.col(start) < F.col(end)).withColumn(_BIN, F.explode(bins))
    if is_small(binned):
        binned = F.broadcast(binned)
    placed = points.withColumn("_at", at).withColumn("_at_bin", F.floor(F.col("_at") / width))
    same = [F.col("_at_bin") == F.col(_BIN), F.col("_at") >= F.col(start), F.col("_at") < F.col(end)]
    same += [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    joined = placed.join(binned, reduce(Column.__and__, same))
    return joined.drop("_at", "_at_bin", _BIN, *[f"_by_{c}" for c in by])
