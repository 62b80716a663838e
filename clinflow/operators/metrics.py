"""Counters and distributions, as reports and as observations of a running query."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clinflow.functions.times import millis_between

R = TypeVar("R")


def counters(ok: Column) -> list[Column]:
    """A1: rows that passed and rows that failed."""
    return [F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed")]


def distribution(millis: Column) -> list[Column]:
    """A2: count, sum, min and max of a latency; rows without one are no samples."""
    return [
        F.count(millis).alias("n"),
        F.sum(millis).alias("sum_ms"),
        F.min(millis).alias("min_ms"),
        F.max(millis).alias("max_ms"),
    ]


def count_by_step(df: DataFrame, ok: str = "ok", step: str = "step") -> DataFrame:
    return df.groupBy(step).agg(*counters(F.col(ok)))


def latency(df: DataFrame, finish: str, source: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*distribution(millis_between(F.col(finish), F.col(source))))


def observe_outcomes(
    df: DataFrame, name: str, ok: str = "ok", millis: Column | None = None
) -> tuple[DataFrame, Observation]:
    """Counters, and a distribution if asked for, taken while the rows pass. No extra job."""
    observation = Observation(name)
    metrics = counters(F.col(ok)) + ([] if millis is None else distribution(millis))
    return df.observe(observation, *metrics), observation


def timed(fn: Callable[[], R], record: Callable[[int], None]) -> R:
    """U4: run ``fn`` and record how many milliseconds it took; failures are not recorded."""
    start = time.monotonic_ns()
    result = fn()
    record((time.monotonic_ns() - start) // 1_000_000)
    return result


# -- latencies that can be added up ------------------------------------------------------------------

#: Bins of a histogram: that of 0 ms, and one per number of binary digits.
BINS = 64


def latency_bins(millis: Column) -> Column:
    """A2: how many latencies have 0, 1, 2 … binary digits, as an array. Those of several tasks or
    batches are added up; negative ones count as 0, rows without one are no samples."""
    digits = F.when(millis > 0, F.length(F.bin(millis))).otherwise(0)
    held = F.when(millis.isNotNull(), digits)
    return F.array(*[F.count_if(held == i) for i in range(BINS)])


def sum_bins(bins: Column) -> Column:
    """Histograms of several rows as one, as an aggregate."""
    return F.array(*[F.sum(F.get(bins, F.lit(i))) for i in range(BINS)])


def quantile(bins: Column, share: float) -> Column:
    """The latency that a share of the samples does not exceed, at most twice too large; null without
    samples."""
    total = F.aggregate(bins, F.lit(0).cast("long"), lambda a, n: a + n)
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("bin"), F.lit(-1).cast("long").alias("at"))

    def step(acc: Column, n: Column) -> Column:
        seen = acc["seen"] + n
        reached = (acc["at"] < 0) & (seen >= F.ceil(total * share)) & (n > 0)
        return F.struct(
            seen.alias("seen"), (acc["bin"] + 1).alias("bin"), F.when(reached, acc["bin"]).otherwise(acc["at"]).alias("at")
        )

    found = F.aggregate(bins, start, step)["at"]
    return F.when(total > 0, F.pow(F.lit(2.0), found).cast("long") - 1)


def observed_stream(stream: DataFrame, name: str, ok: Column, millis: Column | None = None) -> DataFrame:
    """A1, A2, U4: counters, and a distribution with its histogram if asked for, observed for each
    batch while its rows pass. A ``MetricsLog`` keeps them."""
    found = counters(ok)
    if millis is not None:
        found += [*distribution(millis), latency_bins(millis).alias("bins")]
    return stream.observe(name, *found)
