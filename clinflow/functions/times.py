"""Instants, their text forms and defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


def instant(text: Column) -> Column:
    """F8: RFC 3339 text as a timestamp; null when it is not one."""
    return F.try_to_timestamp(text)


def iso_text(ts: Column) -> Column:
    """an instant as ISO text with milliseconds and offset, in the session zone."""
    return F.date_format(ts, ISO_PATTERN)


def millis_between(later: Column, earlier: Column) -> Column:
    """whole milliseconds from ``earlier`` to ``later``; null if either is missing."""
    return F.unix_millis(later) - F.unix_millis(earlier)


def earliest_default(text: Column) -> Column:
    """A missing or empty lower bound means the epoch."""
    return F.coalesce(instant(F.nullif(text, F.lit(""))), F.timestamp_millis(F.lit(0)))


def latest_default(text: Column) -> Column:
    """A missing or empty upper bound means now."""
    return F.coalesce(instant(F.nullif(text, F.lit(""))), F.current_timestamp())


def us_date_to_iso(text: Column) -> Column:
    """``MM/DD/YYYY`` as ``YYYY-MM-DD``, zero padded; null when it is no such date."""
    return F.date_format(F.try_to_timestamp(text, F.lit("M/d/yyyy")), "yyyy-MM-dd")


def utc_day(at: Column) -> Column:
    """The day of an instant in UTC, whatever the session's time zone."""
    days = F.floor(F.unix_seconds(at) / 86_400).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)
