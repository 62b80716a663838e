"""Scans of message stores: by store, by send time, in slices."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.functions.times import utc_day
from clinflow.operators.intervals import interval_join
from clinflow.operators.lookups import is_small
from clinflow.session import work_dir, written

# The default slice, and the shortest slice there may be.
DEFAULT_SLICE = dt.timedelta(days=1)
MIN_SLICE = dt.timedelta(hours=1)


def _literal(df: DataFrame, column: str, at: dt.datetime | str) -> Column:
    """The instant in the column's own type, so that the comparison reaches the file reader."""
    value = at if isinstance(at, str) else at.isoformat()
    return F.lit(value).cast(df.schema[column].dataType)


def _day(df: DataFrame, column: str, at: dt.datetime | str) -> Column:
    """The folder of an instant; of a column without a time zone, simply its day."""
    value = _literal(df, column, at)
    zoned = isinstance(df.schema[column].dataType, T.TimestampType)
    return utc_day(value) if zoned else value.cast("date")


def read_stores(df: DataFrame, stores: str | Iterable[str], column: str = "store") -> DataFrame:
    """All messages of one store or of several, from one table."""
    wanted = [stores] if isinstance(stores, str) else list(stores)
    return df.filter(F.col(column).isin(*wanted))


def unite_stores(stores: dict[str, DataFrame]) -> DataFrame:
    """Stores kept apart, as one table with a ``store`` column."""
    parts = [df.withColumn("store", F.lit(name)) for name, df in stores.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan(
    df: DataFrame,
    start: dt.datetime | str | None = None,
    end: dt.datetime | str | None = None,
    where: str | Column | None = None,
    send_time: str = "send_time",
    send_date: str = "send_date",
) -> DataFrame:
    """``start <= send_time < end`` and a predicate; each may be left out.

    The predicate holds whether or not bounds are given. Where the table is partitioned by
    ``send_date`` its folders, of days in UTC, are pruned too.
    """
    dated = send_date in df.columns
    if start is not None:
        df = df.filter(F.col(send_time) >= _literal(df, send_time, start))
        if dated:
            df = df.filter(F.col(send_date) >= _day(df, send_time, start))
    if end is not None:
        df = df.filter(F.col(send_time) < _literal(df, send_time, end))
        if dated:
            df = df.filter(F.col(send_date) <= _day(df, send_time, end))
    if where is not None:
        df = df.filter(F.expr(where) if isinstance(where, str) else where)
    return df


def ordered(df: DataFrame, order_by: list[Column | str] | None = None) -> DataFrame:
    """O2: the rows in the order asked for, or as they are."""
    return df if order_by is None else df.orderBy(*order_by)


def sorted_ranges(
    df: DataFrame, send_time: str = "send_time", tie: str = "name", partitions: int | None = None
) -> DataFrame:
    """Rows by ranges of send time, each sorted; no total order across the output.

    The tie column is part of the range, so rows of one instant need not share a task.
    """
    by = [F.col(send_time), F.col(tie)]
    ranged = (
        df.repartitionByRange(*by)
        if partitions is None
        else df.repartitionByRange(partitions, *by)
    )
    return ranged.sortWithinPartitions(*by)


def first_by_time(
    df: DataFrame, send_time: str = "send_time", tie: str = "name", latest: bool = False
) -> DataFrame:
    """O1: the first or last message."""
    keys = [F.col(send_time), F.col(tie)]
    return df.orderBy(*[k.desc() if latest else k.asc() for k in keys]).limit(1)


def send_bounds(df: DataFrame, by: list[str], send_time: str = "send_time") -> DataFrame:
    """A3: the span ``[from_ms, to_ms)`` that holds every message, per store.

    A missing send time counts as the epoch at the lower end and as now at the upper one.
    """
    if isinstance(df.schema[send_time].dataType, T.StringType):
        sent = F.try_to_timestamp(F.nullif(F.col(send_time), F.lit("")))
    else:
        sent = F.col(send_time).cast("timestamp")
    millis = F.unix_millis(sent)
    # Where nothing is missing the defaults are not looked at, so the reader sees plain columns.
    missing = F.count_if(sent.isNull())
    return df.groupBy(*by).agg(
        F.when(missing > 0, F.least(F.min(millis), F.lit(0).cast("long")))
        .otherwise(F.min(millis))
        .alias("from_ms"),
        (
            F.when(
                missing > 0, F.greatest(F.max(millis), F.unix_millis(F.current_timestamp()))
            ).otherwise(F.max(millis))
            + 1
        ).alias("to_ms"),
    )


def pinned_bounds(df: DataFrame, by: list[str], send_time: str = "send_time") -> DataFrame:
    """The span ``[from_ms, to_ms)`` that is cut into slices, per store; written, as it is used to
    plan the scan and to carry it out.

    Messages without a send time do not stretch it. A store that has no other has ``[0, 1)``.
    """
    millis = F.unix_millis(F.col(send_time).cast("timestamp"))
    spans = df.groupBy(*by).agg(
        F.coalesce(F.min(millis), F.lit(0).cast("long")).alias("from_ms"),
        (F.coalesce(F.max(millis), F.lit(0).cast("long")) + 1).alias("to_ms"),
    )
    return written(spans, work_dir(df.sparkSession, "bounds"))


def required_bounds(df: DataFrame, send_time: str = "send_time") -> DataFrame:
    """A3 over a whole scan; a scan without messages is an error."""
    return send_bounds(df, [], send_time).select(
        F.when(F.col("from_ms").isNull(), _no_messages()).otherwise(F.col("from_ms")).alias(
            "from_ms"
        ),
        F.when(F.col("to_ms").isNull(), _no_messages()).otherwise(F.col("to_ms")).alias("to_ms"),
    )


def _no_messages() -> Column:
    return F.raise_error(F.lit("no message matches, so there is no send time")).cast("long")


def _millis(span: dt.timedelta) -> int:
    return int(span / dt.timedelta(milliseconds=1))


def _slice_count(width: dt.timedelta, shortest: dt.timedelta) -> Column:
    """How many slices a span has; a last one under the minimum joins the one before it."""
    span = F.col("to_ms") - F.col("from_ms")
    full = F.floor(span / _millis(width))
    rest = F.pmod(span, F.lit(_millis(width)))
    return F.greatest(
        full + F.when(rest >= _millis(shortest), 1).otherwise(0), F.lit(1).cast("long")
    )


def time_slices(
    bounds: DataFrame,
    by: list[str],
    width: dt.timedelta = DEFAULT_SLICE,
    shortest: dt.timedelta = MIN_SLICE,
) -> DataFrame:
    """The slices ``[slice_from, slice_to)`` of each span, in milliseconds."""
    counted = bounds.withColumn("_n", _slice_count(width, shortest))
    sliced = counted.withColumn("slice_id", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    start = F.col("from_ms") + F.col("slice_id") * _millis(width)
    last = F.col("slice_id") == F.col("_n") - 1
    return sliced.select(
        *by,
        "slice_id",
        start.alias("slice_from"),
        F.when(last, F.col("to_ms")).otherwise(start + _millis(width)).alias("slice_to"),
    )


def with_slice(
    df: DataFrame,
    bounds: DataFrame,
    by: list[str],
    send_time: str = "send_time",
    width: dt.timedelta = DEFAULT_SLICE,
    shortest: dt.timedelta = MIN_SLICE,
) -> DataFrame:
    """L4: the slice of each message, by arithmetic on ``pinned_bounds``.

    Messages without a send time are in the first slice of their store; those without a store are a
    store of their own. The bounds are broadcast if they are small.
    """
    named = [f"_{c}" for c in by]
    numbered = bounds.withColumn("_n", _slice_count(width, shortest)).withColumnsRenamed(
        dict(zip(by, named))
    )
    if is_small(numbered):
        numbered = F.broadcast(numbered)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, named)])
    millis = F.unix_millis(F.col(send_time).cast("timestamp"))
    slot = F.least(F.floor((millis - F.col("from_ms")) / _millis(width)), F.col("_n") - 1)
    first = F.lit(0).cast("long")
    return (
        df.join(numbered, same)
        .withColumn("slice_id", F.when(millis.isNull(), first).otherwise(slot))
        .drop("_n", "from_ms", "to_ms", *named)
    )


def store_scan(
    df: DataFrame,
    by: str = "store",
    where: str | Column | None = None,
    send_time: str = "send_time",
    tie: str = "name",
    width: dt.timedelta = DEFAULT_SLICE,
    partitions: int | None = None,
) -> DataFrame:
    """Bounds, slices and an ordered, evenly spread scan of the chosen stores."""
    chosen = scan(df, where=where, send_time=send_time)
    bounds = pinned_bounds(chosen, [by], send_time)
    return sorted_ranges(
        with_slice(chosen, bounds, [by], send_time, width), send_time, tie, partitions
    )


# -- slices by density -----------------------------------------------------------------------------


def hour_counts(
    df: DataFrame,
    by: list[str],
    send_time: str = "send_time",
    shortest: dt.timedelta = MIN_SLICE,
) -> DataFrame:
    """Messages per store and ``hour``, a whole number of shortest slices since the epoch.

    Counts of several parts of a store can be added up. Messages without a send time are not counted.
    """
    millis = F.unix_millis(F.col(send_time).cast("timestamp"))
    counted = df.select(*by, F.floor(millis / _millis(shortest)).alias("hour"), millis.alias("_ms"))
    return (
        counted.filter("hour IS NOT NULL")
        .groupBy(*by, "hour")
        .agg(F.count(F.lit(1)).alias("n"), F.min("_ms").alias("first_ms"), F.max("_ms").alias("last_ms"))
    )


def density_slices(
    hours: DataFrame,
    by: list[str],
    messages: int | None = None,
    longest: dt.timedelta | None = None,
    shortest: dt.timedelta = MIN_SLICE,
) -> DataFrame:
    """Uneven slices ``[slice_from, slice_to)`` in milliseconds, from ``hour_counts``, each with
    ``n_messages``.

    A slice ends with the hour in which it gets to ``messages``; the default is what a default slice
    would have if the store were even. So a dense day is cut down, to the shortest slice at the
    least, and thin days share one. With ``longest``, a slice also ends where a span of that length
    since the epoch does. Slices cover a store from its first message to its last without gaps. A
    store's hours are one task's work, however many messages they have.
    """
    order = Window.partitionBy(*by).orderBy("hour")
    whole = Window.partitionBy(*by)
    width = _millis(shortest)
    even = F.sum("n").over(whole) / F.greatest(
        F.ceil((F.max("hour").over(whole) - F.min("hour").over(whole) + 1) * width / _millis(DEFAULT_SLICE)),
        F.lit(1),
    )
    limit = even if messages is None else F.lit(messages)
    before = F.sum("n").over(order) - F.col("n")
    cut = [F.floor(before / limit)]
    if longest is not None:
        cut.append(F.floor(F.col("hour") * width / _millis(longest)))
    part = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cut)])
    grouped = hours.withColumn("_part", part).groupBy(*by, "_part")
    sized = grouped.agg(
        F.min("hour").alias("_hour"),
        F.min("first_ms").alias("_first"),
        F.max("last_ms").alias("_last"),
        F.sum("n").alias("n_messages"),
    )
    by_hour = Window.partitionBy(*by).orderBy("_hour")
    place = F.row_number().over(by_hour) - 1
    start = F.when(place == 0, F.col("_first")).otherwise(F.col("_hour") * width)
    return sized.select(
        *by,
        place.cast("long").alias("slice_id"),
        start.alias("slice_from"),
        F.coalesce(F.lead("_hour").over(by_hour) * width, F.col("_last") + 1).alias("slice_to"),
        "n_messages",
    )


def with_density_slice(
    df: DataFrame, slices: DataFrame, by: list[str], send_time: str = "send_time"
) -> DataFrame:
    """L4: the slice of each message, by a join with ``density_slices``.

    Messages without a send time are in the first slice of their store, if it has any.
    """
    millis = F.unix_millis(F.col(send_time).cast("timestamp"))
    timed = interval_join(
        df.filter(F.col(send_time).isNotNull()),
        slices.select(*by, "slice_id", "slice_from", "slice_to"),
        millis,
        "slice_from",
        "slice_to",
        _millis(DEFAULT_SLICE),
        by,
    )
    untimed = df.filter(F.col(send_time).isNull()).withColumn("slice_id", F.lit(0).cast("long"))
    return timed.drop("slice_from", "slice_to").unionByName(untimed)


def density_scan(
    df: DataFrame,
    by: str = "store",
    where: str | Column | None = None,
    send_time: str = "send_time",
    tie: str = "name",
    messages: int | None = None,
) -> DataFrame:
    """A scan in slices by density: rows by ranges of store, slice and send time, each sorted, so
    that a dense hour, too, can be spread."""
    chosen = scan(df, where=where, send_time=send_time)
    slices = density_slices(hour_counts(chosen, [by], send_time), [by], messages)
    pinned = written(slices, work_dir(df.sparkSession, "slices"))
    sliced = with_density_slice(chosen, pinned, [by], send_time)
    order = [by, "slice_id", send_time, tie]
    return sliced.repartitionByRange(*order).sortWithinPartitions(*order)
