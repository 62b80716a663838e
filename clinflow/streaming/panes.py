"""Panes of windows that the stream closes itself.

The first row of a window opens a pane, which is handed on a while later and then forgotten; rows that
come for the window after that open another one. What is open when the input ends is handed on by
timers as well, so nothing has to be counted again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clinflow.sinks.errors import MESSAGE_FEED_SHARDS
from clinflow.sinks.files import write_folders
from clinflow.streaming.windows import ERROR_WINDOW

# Fixed value: how long after its first row a pane is handed on, in milliseconds.
PANE_DELAY = 5000
#: How often a query looks for panes to close.
PANE_TRIGGER = {"processingTime": "1 second"}
#: Keys of the state; the open panes are dealt to them by a hash.
PANE_BUCKETS = 1024

Rows = Iterator[pd.DataFrame]


def _wait(state: GroupState, deadlines: Iterable[int]) -> None:
    """The timer has to be set after every call, or there is none."""
    state.setTimeoutDuration(max(1, min(deadlines) - state.getCurrentProcessingTimeMs()))


def counting(delay: int) -> Callable[[tuple, Rows, GroupState], Rows]:
    """Numbers of rows of a bucket's panes. Rows that come for a pane whose time is over open another
    one, so a bucket that gets rows all the time hands its panes on as well."""

    def run(key: tuple, batches: Rows, state: GroupState) -> Rows:
        now = state.getCurrentProcessingTimeMs()
        held = list(zip(*state.get)) if state.exists else []
        due = [p for p in held if p[2] <= now]
        if due:
            yield pd.DataFrame(due, columns=["window_start", "step", "pane", "n_errors"])
        panes = {(w, s): (deadline, n) for w, s, deadline, n in held if deadline > now}
        for batch in batches:
            sizes = batch.groupby(["window_start", "step"], dropna=False, sort=False).size()
            for (w, s), n in sizes.items():
                at = int(w), None if pd.isna(s) else s
                deadline, before = panes.get(at, (now + delay, 0))
                panes[at] = deadline, before + int(n)
        if panes:
            rows = [(w, s, deadline, n) for (w, s), (deadline, n) in panes.items()]
            state.update(tuple(map(list, zip(*rows))))
            _wait(state, (deadline for deadline, _ in panes.values()))
        elif state.exists:
            state.remove()

    return run


def holding(delay: int) -> Callable[[tuple, Rows, GroupState], Rows]:
    """The lines of a bucket's panes themselves."""

    def run(key: tuple, batches: Rows, state: GroupState) -> Rows:
        now = state.getCurrentProcessingTimeMs()
        held = list(zip(*state.get)) if state.exists else []
        for w, deadline, lines in held:
            if deadline <= now:
                yield pd.DataFrame({"window_start": w, "pane": deadline, "value": list(lines)})
        panes = {w: (deadline, list(lines)) for w, deadline, lines in held if deadline > now}
        for batch in batches:
            for w, value in zip(batch["window_start"].tolist(), batch["value"].tolist()):
                if w not in panes:
                    panes[w] = now + delay, []
                panes[w][1].append(value)
        if panes:
            rows = [(w, deadline, lines) for w, (deadline, lines) in panes.items()]
            state.update(tuple(map(list, zip(*rows))))
            _wait(state, (deadline for deadline, _ in panes.values()))
        elif state.exists:
            state.remove()

    return run


def _window(ts: str, width: str) -> Column:
    """Start of a row's window, in microseconds; a row without a time has that of its arrival."""
    at = F.coalesce(F.col(ts).cast("timestamp"), F.current_timestamp())
    return F.unix_micros(F.window(at, width)["start"])


def _bucket(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PANE_BUCKETS)).cast("int")


def _panes(rows: DataFrame, run: Callable, schema: str, state: str) -> DataFrame:
    """Panes by bucket, with the start of their window as a time again."""
    closed = rows.groupBy("bucket").applyInPandasWithState(
        run, f"window_start long, {schema}", state, "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    return closed.withColumn("window_start", F.timestamp_micros("window_start"))


def counted_panes(
    stream: DataFrame, ts: str, step: str, width: str = ERROR_WINDOW, delay: int = PANE_DELAY
) -> DataFrame:
    """``n_errors`` of each pane of a window and step. Panes of one window add up to it.

    State is a number per open pane, whatever the rows. The panes are dealt into buckets, as a call
    and a timer for each would cost more than their rows.
    """
    keyed = stream.select(_window(ts, width).alias("window_start"), F.col(step).alias("step"))
    return _panes(
        keyed.withColumn("bucket", _bucket("window_start", "step")),
        counting(delay),
        "step string, pane long, n_errors long",
        "windows array<long>, steps array<string>, deadlines array<long>, n array<long>",
    )


def held_panes(
    lines: DataFrame,
    ts: str,
    width: str = ERROR_WINDOW,
    delay: int = PANE_DELAY,
    shards: int = MESSAGE_FEED_SHARDS,
) -> DataFrame:
    """The lines (``value``) of each pane, when it is handed on.

    The lines of a window are dealt to ``shards`` panes, and the panes into buckets, so that state is
    a bucket's share of the few seconds that a pane is open.
    """
    shard = F.pmod(F.xxhash64("value", ts), F.lit(shards)).alias("shard")
    keyed = lines.select(_window(ts, width).alias("window_start"), shard, F.coalesce("value", F.lit("")).alias("value"))
    return _panes(
        keyed.withColumn("bucket", _bucket("window_start", "shard")).drop("shard"),
        holding(delay),
        "pane long, value string",
        "windows array<long>, deadlines array<long>, lines array<array<string>>",
    )


def start_pane_sink(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "ts",
    width: str = ERROR_WINDOW,
    delay: int = PANE_DELAY,
    shards: int = MESSAGE_FEED_SHARDS,
    trigger: dict = PANE_TRIGGER,
) -> StreamingQuery:
    """Error lines as text, in folders named after the start of their window in UTC, below the
    folder of the batch that closed the pane; a repeated batch replaces its own."""

    def run(batch: DataFrame, batch_id: int) -> None:
        utc = F.to_utc_timestamp("window_start", F.current_timezone())
        window = F.concat(F.lit("window="), F.date_format(utc, "yyyy-MM-dd'T'HH-mm-ss"))
        write_folders(batch.select(window.alias("folder"), "value"), path, batch_id)

    panes = held_panes(lines, ts, width, delay, shards)
    started = panes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return started.trigger(**trigger).start()


def until_panes_closed(query: StreamingQuery, seconds: float = 600) -> None:
    """Wait until all input is read and no pane is open, then stop the query.

    For input that ends; a feed simply goes on. A batch may take as long as it needs; it is an error
    if batches do nothing for ``seconds`` while panes are open.
    """
    end, seen, open_before = time.monotonic() + seconds, None, None
    try:
        while True:
            if query.exception() is not None:
                raise query.exception()
            done = query.lastProgress
            if done is not None and (done["batchId"], done["timestamp"]) != seen:
                seen = done["batchId"], done["timestamp"]
                states = done["stateOperators"]
                still_open = states[0]["numRowsTotal"] if states else None
                if done["numInputRows"] == 0 and done["batchId"] > 0 and still_open == 0:
                    return
                if done["numInputRows"] or still_open != open_before:
                    end, open_before = time.monotonic() + seconds, still_open
                elif time.monotonic() > end:
                    raise TimeoutError("panes are still open")
            time.sleep(0.2)
    finally:
        query.stop()
