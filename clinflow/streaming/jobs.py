"""The feeds as streaming queries.

Every micro-batch is worked out once and kept while its outputs are written: by the message feed, which
takes a large table in batches, in the executors, by the imaging feed in files. Each output goes to a
folder named after the run — a checkpoint has one, for good — and the batch, and replaces what an
earlier attempt left there. So a batch that is repeated after a failure has no double effect, and a
feed that starts anew with another checkpoint leaves the old output alone.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from clinflow.functions import jsonx
from clinflow.operators.feed import (
    MAPPING,
    READ,
    WRITE,
    route_by_type,
    routed_outcomes,
    wrap_message,
)
from clinflow.operators.lookups import is_small
from clinflow.operators.mapping import Mapping, bundle_stage, map_stage
from clinflow.operators.metrics import observe_outcomes, timed
from clinflow.operators.outcomes import split_ok, to_error_rows
from clinflow.operators.studies import read_studies
from clinflow.session import spread, work_dir, written
from clinflow.sinks.bundles import Client, checked_resources, failed_bodies, post_bundles
from clinflow.sinks.errors import (
    IMAGING_FEED_SHARDS,
    MESSAGE_FEED_SHARDS,
    json_lines,
    write_text_shards,
)
from clinflow.sinks.files import Writer, list_files, remove_listed, write_batch
from clinflow.sinks.messages import ingest_messages
from clinflow.sinks.study_store import StudyStore
from clinflow.sources.exports import export_lines, export_range, parse_messages
from clinflow.sources.notifications import payload_text
from clinflow.streaming.windows import ERROR_TRIGGER

IMAGING_URL = "ImagingStudy"
#: Where a row came in, in its batch.
PLACE = "_place"

Table = DataFrame | Callable[[], DataFrame]
Studies = Table | StudyStore


@dataclass(frozen=True)
class Reports:
    """What a feed tells and whom it calls, after each batch.

    ``on_counts`` gets the batch and the number of good rows (``ok``) and of rows per stage that
    rejected them. ``on_metrics`` gets how long mapping and writing took, and the latency since the
    source time. ``client`` opens a client that sends bundles elsewhere; see ``post_bundles``.
    """

    on_counts: Callable[[int, dict[str, int]], None] | None = None
    on_metrics: Callable[[int, dict[str, int | None]], None] | None = None
    client: Client | None = None


@dataclass(frozen=True)
class FeedPaths:
    """Where a feed writes; all folders have to be reachable by every executor."""

    bundles: str
    resources: str
    read_errors: str
    mapping_errors: str
    write_errors: str
    scratch: str
    checkpoint: str

    @classmethod
    def below(cls, base: str) -> FeedPaths:
        return cls(**{f: f"{base}/{f}" for f in cls.__dataclass_fields__})

    def of_run(self, spark: SparkSession) -> FeedPaths:
        outputs = [f for f in self.__dataclass_fields__ if f != "checkpoint"]
        run = run_folder(spark, self.checkpoint)
        return replace(self, **{f: f"{getattr(self, f)}/{run}" for f in outputs})


def run_folder(spark: SparkSession, checkpoint: str) -> str:
    """A folder name for what the query with this checkpoint writes, the same after a restart."""
    kept = spark.read.text(f"{checkpoint}/metadata").first()
    return f"run={json.loads(kept['value'])['id']}"


def _now(table: Table) -> DataFrame:
    return table() if callable(table) else table


def _start(
    stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


STAGES = (READ, MAPPING, WRITE)


def _measures(outcomes: DataFrame) -> list[Column]:
    """Rows per stage and the bytes of what failed there, and source times of good rows,
    to be observed while the rows pass."""
    stage = F.col("failed_stage")
    value = F.octet_length(F.coalesce("value", F.lit(""))) + F.octet_length(F.coalesce("output", F.lit("")))
    found = [F.count_if(stage.isNull()).alias("ok")]
    for s in STAGES:
        found.append(F.count_if(stage == s).alias(s))
        found.append(F.coalesce(F.sum(F.when(stage == s, value)), F.lit(0)).alias(f"{s}_bytes"))
    if "source_time" in outcomes.columns:
        sent = F.when(stage.isNull(), F.unix_millis("source_time"))
        found += [f(sent).alias(name) for f, name in ((F.count, "n"), (F.sum, "sum"), (F.min, "min"), (F.max, "max"))]
    return found


def _counts(seen: dict[str, int]) -> dict[str, int]:
    return {s: seen[s] for s in ("ok", *STAGES) if seen[s]}


def _commit_latency(seen: dict[str, int], finished: int) -> dict[str, int | None]:
    """A2: milliseconds from each row's source time until its batch was written."""
    n = seen["n"]
    return {
        "n": n,
        "sum_ms": n * finished - seen["sum"] if n else None,
        "min_ms": finished - seen["max"] if n else None,
        "max_ms": finished - seen["min"] if n else None,
    }


def _posted(outcomes: DataFrame, client: Client, scratch: str) -> DataFrame:
    """Good rows are sent; those the client refuses move to the write stage.

    The replies are written before they are used, and a repeated batch uses them again, so that
    nothing is sent twice once they are there.
    """
    spark = outcomes.sparkSession
    good = outcomes.filter(F.col("failed_stage").isNull()).drop("error", "failed_stage")
    rest = outcomes.filter(F.col("failed_stage").isNotNull())
    sent = post_bundles(good, client, "output", tuple(c for c in good.columns if c != "output"))
    moved = sent.withColumn("failed_stage", F.when(~F.col("ok"), WRITE))
    kept = rest.withColumn("status", F.lit(None).cast("int")).unionByName(
        moved.drop("ok", "reply")
    )
    if any(name.endswith("/_SUCCESS") for name in list_files(spark, scratch)):
        return spark.read.schema(kept.schema).parquet(scratch)
    return written(kept, scratch)


def _write_outcomes(
    outcomes: DataFrame,
    paths: FeedPaths,
    batch_id: int,
    shards: int,
    report: Reports,
    scratch: str | None = None,
) -> None:
    """Bundles, resources and the three dead letters of one batch.

    With ``scratch``, for batches of any size, the outcomes are kept in files there.
    """
    replies = f"{paths.scratch}/replies-{batch_id}"
    metrics: dict[str, int | None] = {}
    mapping = partial(metrics.__setitem__, "transform_ms")
    if scratch is None:
        mapped = outcomes.persist(StorageLevel.MEMORY_AND_DISK)
    else:
        mapped = timed(lambda: written(outcomes, f"{scratch}/outcomes"), mapping)
    kept = mapped
    try:
        if scratch is None and report.on_metrics is not None:  # else they are mapped while written
            timed(mapped.count, mapping)
        if report.client is not None:
            kept = _posted(mapped, report.client, replies)
        seen = timed(
            lambda: _write_all(kept, paths, batch_id, shards),
            partial(metrics.__setitem__, "write_ms"),
        )
        if report.on_metrics is not None:
            if "source_time" in kept.columns:
                metrics |= _commit_latency(seen, int(time.time() * 1000))
            report.on_metrics(batch_id, metrics)
        if report.on_counts is not None:
            report.on_counts(batch_id, _counts(seen))
        if report.client is not None:
            remove_listed(mapped.sparkSession, [replies])
    finally:
        mapped.unpersist()


def _write_all(kept: DataFrame, paths: FeedPaths, batch_id: int, shards: int) -> dict[str, int]:
    """All outputs of a batch, and what was observed while the first one was written."""
    observation = Observation("outcomes")
    observed = kept.observe(observation, *_measures(kept))
    bundles = observed.filter(F.col("failed_stage").isNull()).select(F.col("output").alias("bundle"))
    write_batch(bundles, paths.bundles, batch_id)
    seen = observation.get
    good = kept.filter(F.col("failed_stage").isNull())
    # A later source time is a newer version; without one, a later batch is, and in a batch what
    # came in later.
    now = F.lit(int(time.time() * 1000)).cast("long")
    given = F.unix_millis("source_time") if "source_time" in kept.columns else F.lit(None)
    place = F.col(PLACE) if PLACE in kept.columns else F.lit(0)
    versioned = good.select(
        F.col("output").alias("bundle"),
        F.coalesce(given, now).alias("version"),
        place.cast("long").alias("seq"),
    )
    entries = checked_resources(versioned, "bundle", "version", "seq")
    counted, written_entries = observe_outcomes(entries, "resources")
    accepted, _ = split_ok(counted)
    write_batch(accepted.sortWithinPartitions("resource_type", "id"), paths.resources, batch_id)
    n_refused = written_entries.get["n_failed"] if seen["ok"] else 0
    failed = {s: kept.filter(F.col("failed_stage") == s) for s in STAGES}
    status = F.col("status") if "status" in kept.columns else None
    unwritten = failed_bodies(failed[WRITE], status=status)
    if n_refused:
        unwritten = unwritten.unionByName(failed_bodies(split_ok(entries)[1], "body"))
    dead_letters = (
        (READ, paths.read_errors, failed[READ].select(F.coalesce("value", F.lit("")))),
        (MAPPING, paths.mapping_errors, json_lines(to_error_rows(failed[MAPPING]))),
        (WRITE, paths.write_errors, json_lines(unwritten)),
    )
    for stage, path, lines in dead_letters:
        rows, size = seen[stage], seen[f"{stage}_bytes"]
        if stage == WRITE and n_refused:
            write_text_shards(lines, path, batch_id, shards)  # how large the refused are is unknown
        elif rows:
            write_text_shards(lines, path, batch_id, shards, (rows, size))
    return seen


def start_message_feed(
    notifications: DataFrame,
    types: Table,
    mapping: Mapping,
    paths: FeedPaths,
    shards: int = MESSAGE_FEED_SHARDS,
    trigger: dict = ERROR_TRIGGER,
    report: Reports = Reports(),
) -> StreamingQuery:
    """Text notifications to bundles and resources.

    ``types`` is the entity type table, or a function that reads it anew for each batch. Rows with a
    ``source_time`` are samples of the latency until their batch is written; a missing time is none.
    """
    kept = [c for c in ("value", "source_time") if c in notifications.columns]
    fixed_small = None if callable(types) else is_small(types)

    def run(batch: DataFrame, batch_id: int) -> None:
        table = _now(types)
        small = is_small(table) if fixed_small is None else fixed_small
        rows = batch.select(*kept, F.monotonically_increasing_id().alias(PLACE))
        routed = route_by_type(spread(rows))
        if not small:  # the lookup then looks at the keys first
            routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            outcomes = routed_outcomes(routed, rows.columns, table, mapping, small=small)
            _write_outcomes(outcomes, paths.of_run(batch.sparkSession), batch_id, shards, report)
        finally:
            routed.unpersist()

    return _start(notifications, run, paths.checkpoint, trigger)


def imaging_outcomes(
    paths: DataFrame,
    instances: DataFrame | StudyStore,
    mapping: Mapping,
    url: str = IMAGING_URL,
    scratch: str | None = None,
    **limits: int,
) -> DataFrame:
    """T8 for a batch of web paths: one row per rejected path and per study, with its outcome."""
    studies, resolved = read_studies(paths, instances, scratch=scratch, **limits)
    _, unread = split_ok(resolved)
    rejected = unread.select(
        F.col("path").alias("value"),
        F.lit(None).cast("string").alias("output"),
        F.lit(READ).alias("failed_stage"),
        "error",
    )
    wrapped = studies.select(
        F.col("study").alias("value"),
        jsonx.array_wrap(F.col("study"), "study").alias("message"),
    )
    mapped = map_stage(wrap_message(wrapped, "message", F.lit(None)), mapping)
    staged = mapped.withColumnsRenamed({"ok": "_map_ok", "error": "_map_error"})
    bundled = bundle_stage(staged, "output", url)
    stage = F.when(~F.col("_map_ok"), MAPPING).when(~F.col("ok"), WRITE)
    return rejected.unionByName(
        bundled.select(
            "value",
            F.coalesce("bundle", "output").alias("output"),
            stage.alias("failed_stage"),
            F.coalesce("_map_error", "error").alias("error"),
        )
    )


def start_imaging_feed(
    notifications: DataFrame,
    instances: Studies,
    mapping: Mapping,
    paths: FeedPaths,
    shards: int = IMAGING_FEED_SHARDS,
    trigger: dict = ERROR_TRIGGER,
    report: Reports = Reports(),
) -> StreamingQuery:
    """Binary notifications with a web path to one bundle per study.

    ``instances`` is a table, a function that reads it anew for each batch, or a ``StudyStore``, of
    which a batch reads the buckets that its studies are in. As each batch searches them, a batch may
    be large: its paths and outcomes are kept in files below ``paths.scratch`` while it lasts. Kept by
    the executors they would fill the memory that the joins and sorts beside them need.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        text = payload_text(batch, "value").select(F.col("value").alias("path"))
        here = paths.of_run(batch.sparkSession)
        scratch = f"{here.scratch}/batch_id={batch_id}"
        try:
            notified = written(spread(text), f"{scratch}/notified")
            outcomes = imaging_outcomes(notified, _now(instances), mapping, scratch=scratch)
            _write_outcomes(outcomes, here, batch_id, shards, report, scratch)
        finally:
            remove_listed(batch.sparkSession, [scratch])

    return _start(notifications, run, paths.checkpoint, trigger)


def start_error_sink(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    shards: int = MESSAGE_FEED_SHARDS,
    trigger: dict = ERROR_TRIGGER,
) -> StreamingQuery:
    """A stream of error lines (``value``) as text shards, new rows only."""

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.select("value").persist(StorageLevel.MEMORY_AND_DISK)
        folder = f"{path}/{run_folder(batch.sparkSession, checkpoint)}"
        try:
            write_text_shards(kept, folder, batch_id, shards)
        finally:
            kept.unpersist()

    return _start(lines, run, checkpoint, trigger)


def start_ingest(
    messages: DataFrame,
    store: str,
    rejects: str,
    checkpoint: str,
    trigger: dict = ERROR_TRIGGER,
    write: Writer = write_batch,
) -> StreamingQuery:
    """A stream of messages into a store, the rejected ones beside it.

    With ``append_committed`` as ``write``, one run's store and rejects are tables of whole batches,
    to be read with ``read_committed``.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        folder = run_folder(batch.sparkSession, checkpoint)
        try:
            rejected = ingest_messages(kept, f"{store}/{folder}", batch_id, write=write)
            write(rejected, f"{rejects}/{folder}", batch_id)
        finally:
            kept.unpersist()

    return _start(messages, run, checkpoint, trigger)


def start_export_feed(
    lines: DataFrame, messages: str, rejects: str, checkpoint: str, trigger: dict = ERROR_TRIGGER
) -> StreamingQuery:
    """T10 as a stream: exported lines to messages and error rows, both written before a source that
    removes its files takes the batch for done."""

    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_messages(batch.select("value")).persist(StorageLevel.MEMORY_AND_DISK)
        folder = run_folder(batch.sparkSession, checkpoint)
        try:
            good, bad = split_ok(parsed)
            write_batch(good.drop("value"), f"{messages}/{folder}", batch_id)
            write_batch(to_error_rows(bad), f"{rejects}/{folder}", batch_id)
        finally:
            parsed.unpersist()

    return _start(lines, run, checkpoint, trigger)


def read_export(
    spark: SparkSession,
    lines_path: str,
    messages: str,
    rejects: str,
    start: str | None = None,
    end: str | None = None,
) -> None:
    """Parse exported files, write both outputs, and only then remove the files.

    The files are listed once: those are read, by one pass, and those are removed.
    """
    files = list_files(spark, lines_path)
    scratch = work_dir(spark, "export")
    good, bad = split_ok(written(parse_messages(export_lines(spark, lines_path, files)), scratch))
    export_range(good.drop("value"), start, end).write.mode("overwrite").parquet(messages)
    json_lines(to_error_rows(bad)).write.mode("overwrite").text(rejects)
    remove_listed(spark, [*files, scratch])
