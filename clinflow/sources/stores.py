"""Message stores other than files, as a data source of Spark.

A store is whatever can hand out its messages by time: a function opens it, on the driver to learn its
bounds and in every task to read a slice. Spark plans one partition per slice, and bounds and store
names of a query reach the source, which reads the slices in between only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from clinflow.operators.store import DEFAULT_SLICE

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class Store(Protocol):
    """Times are microseconds since the epoch; ``end`` is exclusive."""

    def bounds(self) -> tuple[int, int] | None:
        """The span that holds every message; None if there are none."""

    def read(self, start: int, end: int, names: list[str] | None) -> Iterator[pa.RecordBatch]:
        """The messages sent in a span, of the stores named or of all, as the source's columns."""


def micros(at: dt.datetime) -> int:
    aware = at.replace(tzinfo=dt.timezone.utc) if at.tzinfo is None else at
    return (aware - EPOCH) // dt.timedelta(microseconds=1)


@dataclass
class Span(InputPartition):
    start: int
    end: int

    def __post_init__(self) -> None:
        super().__init__((self.start, self.end))


def slices_between(start: int, end: int, width: dt.timedelta = DEFAULT_SLICE) -> list[tuple[int, int]]:
    """Even slices of a span, which begin at whole widths since the epoch."""
    step = width // dt.timedelta(microseconds=1)
    cuts = [start, *range((start // step + 1) * step, end, step), end]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


class StoreReader(DataSourceReader):
    def __init__(self, open_store: Callable[[], Store], slices: list[tuple[int, int]] | None) -> None:
        self.open_store, self.slices = open_store, slices
        self.start, self.end = -(2**63), 2**63 - 1
        self.names: list[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of ``send_time`` and values of ``store`` are kept here; others go back."""
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("send_time",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.start = max(self.start, micros(f.value) + isinstance(f, GreaterThan))
            elif column == ("send_time",) and isinstance(f, (LessThan, LessThanOrEqual)):
                self.end = min(self.end, micros(f.value) + isinstance(f, LessThanOrEqual))
            elif column == ("store",) and isinstance(f, (EqualTo, In)):
                named = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.names = sorted(named if self.names is None else named & set(self.names))
            else:
                yield f

    def partitions(self) -> list[Span]:
        slices = self.slices
        if slices is None:
            bounds = self.open_store().bounds()
            slices = slices_between(*bounds) if bounds else []
        cut = [(max(a, self.start), min(b, self.end)) for a, b in slices]
        return [Span(a, b) for a, b in cut if a < b] or [Span(0, 0)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        if partition.start < partition.end:
            yield from self.open_store().read(partition.start, partition.end, self.names)


def read_store(
    spark: SparkSession,
    name: str,
    open_store: Callable[[], Store],
    schema: str,
    slices: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """The store as a table that is scanned in slices, by default one per day.

    ``schema`` has a ``send_time`` and a ``store`` among its columns; ``name`` is what the source is
    registered as. ``slices`` may come from ``density_slices``; messages outside of them are not read.
    Filters are handed to sources only where the session has ``spark.sql.python.filterPushdown.enabled``,
    which is set here.
    """

    class StoreSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> StoreReader:  # noqa: ANN001
            return StoreReader(open_store, slices)

    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(StoreSource)
    return spark.read.format(name).load()
