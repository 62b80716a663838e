"""The streaming jobs, run to the end of a table and read back."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.operators.guarded import OfRow
from clinflow.operators.lookups import entity_types
from clinflow.operators.metrics import BINS, observed_stream, quantile, sum_bins
from clinflow.operators.resources import current_resources
from clinflow.plans.errors import WINDOWS_SQL
from clinflow.plans.feed import FEED_MAPPING, FEED_SQL
from clinflow.plans.inputs import (
    EXPORTED_SQL,
    INSTANCES_SQL,
    MESSAGES_SQL,
    entity_type_table,
    event_notifications,
    export_rows,
    instance_metadata,
    instance_paths,
    messages,
    united_notifications,
)
from clinflow.plans.registry import query
from clinflow.plans.studies import IMAGING_MAPPING, STUDIES_SQL, paths_of_users, study_store
from clinflow.schemas import ERROR_ROW, IO_ERROR_ROW
from clinflow.session import stream_table, table, work_dir
from clinflow.sinks.commits import append_committed, read_committed
from clinflow.sources.notifications import delivered_once, text_files
from clinflow.streaming.jobs import (
    FeedPaths,
    Reports,
    read_export,
    run_folder,
    start_error_sink,
    start_export_feed,
    start_imaging_feed,
    start_ingest,
    start_message_feed,
)
from clinflow.streaming.metrics_log import MetricsLog
from clinflow.streaming.panes import PANE_TRIGGER, counted_panes, start_pane_sink, until_panes_closed
from clinflow.streaming.windows import closed_error_windows, windows_to_the_end

_TO_END = {"availableNow": True}
# A feed takes a large table in batches of this many files, so that what it keeps stays small.
_FILES = 1000


def _run_message_feed(spark: SparkSession, sf_dir: str) -> FeedPaths:
    paths = FeedPaths.below(work_dir(spark, "message-feed"))
    events, documents = (stream_table(spark, sf_dir, t, _FILES) for t in ("events", "documents"))
    start_message_feed(
        united_notifications(events, documents).select("value"),
        entity_types(entity_type_table(spark, sf_dir)),
        FEED_MAPPING,
        paths,
        trigger=_TO_END,
    ).awaitTermination()
    return paths


@query(
    "T7 S1 W4 W5 T2 T4 T6",
    FEED_SQL + "SELECT output AS bundle FROM outcomes WHERE failed_stage IS NULL",
)
def stream_message_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _run_message_feed(spark, sf_dir)
    return spark.read.parquet(paths.bundles).select("bundle")


@query(
    "T7 W6 W9 T4",
    FEED_SQL + "SELECT unnest(string_split(value, chr(10))) AS value FROM routed WHERE NOT ok",
)
def stream_read_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw texts, line by line, as a text that has several lines fills several in the file."""
    paths = _run_message_feed(spark, sf_dir)
    return spark.read.option("lineSep", "\n").text(paths.read_errors).select("value")


@query(
    "T8 S2 S12 W4 W5 W9",
    STUDIES_SQL
    + """
SELECT 'ImagingStudy' AS resource_type, '{"first":"' || first || '","frames":['
  || json_extract_string(first_metadata, '$."00201208".Value[0]')
  || '],"resourceType":"ImagingStudy","uid":"' || study_id || '"}' AS body
FROM studies
""",
)
def stream_imaging(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = FeedPaths.below(work_dir(spark, "imaging-feed"))
    # Every batch searches the store, so the table is taken in one.
    notified = instance_paths(stream_table(spark, sf_dir, "lineitem"))
    start_imaging_feed(
        notified.select(F.encode("path", "UTF-8").alias("value")),
        instance_metadata(spark, sf_dir),
        IMAGING_MAPPING,
        paths,
        trigger=_TO_END,
    ).awaitTermination()
    log = spark.read.parquet(paths.resources)
    return current_resources(log).select("resource_type", "body")


@query(
    "T8 S12 L3 W4 W5",
    f"""WITH {INSTANCES_SQL},
wanted AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS study_id FROM events),
studies AS (
  SELECT study_id, min(instance_id) AS first,
         arg_min(metadata, struct_pack(i := instance_id, m := metadata)) AS first_metadata
  FROM instances JOIN wanted USING (study_id) GROUP BY study_id)
SELECT 'ImagingStudy' AS resource_type, '{{"first":"' || first || '","frames":['
  || json_extract_string(first_metadata, '$."00201208".Value[0]')
  || '],"resourceType":"ImagingStudy","uid":"' || study_id || '"}}' AS body
FROM studies
""",
)
def stream_imaging_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed over a store by key: a notification per event, of studies far apart."""
    paths = FeedPaths.below(work_dir(spark, "imaging-stored"))
    notified = paths_of_users(stream_table(spark, sf_dir, "events"))
    start_imaging_feed(
        notified.select(F.encode("path", "UTF-8").alias("value")),
        study_store(spark, sf_dir),
        IMAGING_MAPPING,
        paths,
        trigger=_TO_END,
    ).awaitTermination()
    log = spark.read.parquet(paths.resources)
    return current_resources(log).select("resource_type", "body")


@query("W6 W9 T2 T4", "SELECT props AS value FROM events WHERE event_type = 'error'")
def stream_error_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "error-sink")
    errors = stream_table(spark, sf_dir, "events").filter("event_type = 'error'")
    start_error_sink(
        errors.select(F.col("props").alias("value")),
        f"{base}/errors",
        f"{base}/checkpoint",
        trigger=_TO_END,
    ).awaitTermination()
    return spark.read.text(f"{base}/errors").select("value")


@query(
    "T1 T3 T4",
    WINDOWS_SQL,
)
def stream_error_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "error-windows")
    steps = (F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("step"))
    events = stream_table(spark, sf_dir, "events").select(*steps)
    closed_error_windows(events, "ts", "step").writeStream.format("parquet").outputMode(
        "append"
    ).option("path", f"{base}/windows").option("checkpointLocation", f"{base}/checkpoint").trigger(
        **_TO_END
    ).start().awaitTermination()
    rows = table(spark, sf_dir, "events").select(*steps)
    counted = windows_to_the_end(spark.read.parquet(f"{base}/windows"), rows, "ts", "step")
    return counted.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "step",
        "n_errors",
    )


@query("T1 T2 T3 T4", WINDOWS_SQL)
def stream_error_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows from the panes that timers close, to the last one."""
    base = work_dir(spark, "error-panes")
    events = stream_table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("step"))
    panes = counted_panes(events, "ts", "step").writeStream.format("parquet").outputMode("append")
    until_panes_closed(
        panes.option("path", f"{base}/panes")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(**PANE_TRIGGER)
        .start()
    )
    closed = spark.read.parquet(f"{base}/panes").groupBy("window_start", "step")
    start = F.col("window_start").cast("timestamp_ntz")
    return closed.agg(F.sum("n_errors").alias("n_errors")).select(
        start.alias("window_start"),
        (start + F.expr("INTERVAL 5 SECONDS")).alias("window_end"),
        "step",
        "n_errors",
    )


@query(
    "W6 T2 T4",
    """SELECT strftime(to_timestamp(epoch_us(ts) // 5000000 * 5) AT TIME ZONE 'UTC', '%Y-%m-%dT%H-%M-%S') AS "window",
       props AS value FROM events WHERE event_type = 'error'""",
)
def stream_pane_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error lines in folders of their windows."""
    base = work_dir(spark, "pane-sink")
    errors = stream_table(spark, sf_dir, "events").filter("event_type = 'error'")
    lines = errors.select("ts", F.col("props").alias("value"))
    until_panes_closed(start_pane_sink(lines, f"{base}/errors", f"{base}/checkpoint"))
    # The folders are not taken for partitions: the driver would hold and compare a value for each.
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{base}/errors")
    window = F.regexp_extract(F.col("_metadata.file_path"), "/window=([^/]+)/", 1)
    return lines.select(window.alias("window"), "value")


@query(
    "W1 P7 S1",
    f"""WITH {MESSAGES_SQL}
SELECT data, '{{"user":"' || user_label || '"}}' AS labels FROM messages""",
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "ingest-feed")
    start_ingest(
        messages(stream_table(spark, sf_dir, "events", _FILES)),
        f"{base}/store",
        f"{base}/rejects",
        f"{base}/checkpoint",
        trigger=_TO_END,
    ).awaitTermination()
    stored = spark.read.parquet(f"{base}/store")
    return stored.select("data", F.to_json("labels").alias("labels"))


@query(
    "W1 W2 T6 T4",
    f"""WITH {MESSAGES_SQL}
SELECT data, '{{"user":"' || user_label || '"}}' AS labels FROM messages""",
)
def stream_ingest_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a table whose readers see committed batches only."""
    base = work_dir(spark, "committed-feed")
    stream = messages(stream_table(spark, sf_dir, "events", _FILES))
    start_ingest(
        stream, f"{base}/store", f"{base}/rejects", f"{base}/checkpoint", _TO_END, append_committed
    ).awaitTermination()
    store = f"{base}/store/{run_folder(spark, f'{base}/checkpoint')}"
    stored = read_committed(spark, store, stream.select("data", "labels").schema)
    return stored.select("data", F.to_json("labels").alias("labels"))


def _run_export_feed(spark: SparkSession, sf_dir: str) -> str:
    """Exported lines as a stream of text files, which are removed once they are read."""
    base = work_dir(spark, "cleanup")
    export_rows(table(spark, sf_dir, "events")).select("value").write.text(f"{base}/files")
    start_export_feed(
        text_files(spark, f"{base}/files", done="delete"),
        f"{base}/messages",
        f"{base}/rejects",
        f"{base}/checkpoint",
        trigger=_TO_END,
    ).awaitTermination()
    return base


@query(
    "S1 S11 W11 T10",
    f"""WITH {EXPORTED_SQL}
SELECT event_type || '/' || event_id AS name, epoch_us(ts) // 1000 AS send_ms FROM lines
WHERE event_type IN ('click', 'view', 'purchase')""",
)
def stream_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = spark.read.parquet(f"{_run_export_feed(spark, sf_dir)}/messages")
    return parsed.select("name", F.unix_millis("send_time").alias("send_ms"))


@query(
    "S11 W11 T10 E5",
    f"""WITH {EXPORTED_SQL}
SELECT CASE event_type WHEN 'signup' THEN 'the message has no schematized data'
  ELSE 'the input message is invalid' END AS error_message, 'ParseMessage' AS step
FROM lines WHERE event_type IN ('signup', 'error')""",
)
def stream_cleanup_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{_run_export_feed(spark, sf_dir)}/rejects")
    return rows.select("error_message", "step")


def _json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


_ID = re.compile(r'"id":(\d+)')


def _refusing_odd():
    """A client that refuses events with an odd number, as a store might."""

    def send(row):
        odd = int(_ID.search(row["output"])[1]) % 2 == 1
        return (422, "refused") if odd else (200, "stored")

    return OfRow(send)


@query(
    "T7 W4 W8 W9 E6 P11",
    FEED_SQL
    + """SELECT output AS "dataElement", 'refused' AS message, 422 AS "statusCode" FROM outcomes
WHERE failed_stage IS NULL
  AND CAST(json_extract_string(output, '$.entry[0].resource.id') AS BIGINT) % 2 = 1""",
)
def stream_write_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The write branch of the message feed: bundles that a client refuses."""
    paths = FeedPaths.below(work_dir(spark, "write-errors"))
    start_message_feed(
        event_notifications(stream_table(spark, sf_dir, "events", _FILES)).select("value"),
        entity_types(entity_type_table(spark, sf_dir)),
        FEED_MAPPING,
        paths,
        trigger=_TO_END,
        report=Reports(client=_refusing_odd),
    ).awaitTermination()
    rows = _json_rows(spark, paths.write_errors, IO_ERROR_ROW)
    return rows.select("dataElement", "message", "statusCode")


@query(
    "T8 W6 W9 E5",
    STUDIES_SQL
    + """
SELECT 'the input is not valid JSON' AS error_message, 'MapMessages' AS step FROM studies
WHERE CAST(study_id AS BIGINT) % 7 = 0""",
)
def stream_imaging_mapping_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping branch of the imaging feed: every seventh study has metadata that is no JSON."""
    paths = FeedPaths.below(work_dir(spark, "mapping-errors"))
    broken = F.when(F.col("study_id").cast("long") % 7 == 0, "{").otherwise(F.col("metadata"))
    start_imaging_feed(
        instance_paths(stream_table(spark, sf_dir, "lineitem")).select(
            F.encode("path", "UTF-8").alias("value")
        ),
        instance_metadata(spark, sf_dir).withColumn("metadata", broken),
        IMAGING_MAPPING,
        paths,
        trigger=_TO_END,
    ).awaitTermination()
    return _json_rows(spark, paths.mapping_errors, ERROR_ROW).select("error_message", "step")


@query(
    "T10 S10 S11 W11 T6 F5",
    f"""WITH {EXPORTED_SQL}
SELECT event_type || '/' || event_id AS name, epoch_us(ts) // 1000 AS send_ms FROM lines
WHERE event_type IN ('click', 'view', 'purchase')
  AND ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-28 00:00:00'""",
)
def export_read_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "export")
    export_rows(table(spark, sf_dir, "events")).select("value").write.text(f"{base}/files")
    read_export(
        spark,
        f"{base}/files/",
        f"{base}/messages",
        f"{base}/rejects",
        "2024-01-03T00:00:00Z",
        "2024-01-28T00:00:00Z",
    )
    parsed = spark.read.parquet(f"{base}/messages")
    return parsed.select("name", F.unix_millis("send_time").alias("send_ms"))


@query(
    "U4 A2 T7",
    """SELECT count(*) AS n, epoch_us(max(ts)) // 1000 - epoch_us(min(ts)) // 1000 AS spread_ms,
true AS timed FROM events WHERE event_type IN ('signup', 'view', 'click', 'purchase')""",
)
def stream_feed_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the source time of the events until their batch is written; the latency itself depends
    on when this runs, the difference between the slowest and the fastest event does not."""
    seen: dict[int, dict[str, int | None]] = {}
    events = stream_table(spark, sf_dir, "events")
    start_message_feed(
        event_notifications(events, F.col("ts").cast("timestamp").alias("source_time")),
        entity_types(entity_type_table(spark, sf_dir)),
        FEED_MAPPING,
        FeedPaths.below(work_dir(spark, "latency")),
        trigger=_TO_END,
        report=Reports(on_metrics=seen.__setitem__),
    ).awaitTermination()
    (m,) = seen.values()
    timed = m["transform_ms"] > 0 and m["write_ms"] > 0 and m["sum_ms"] >= m["n"] * m["min_ms"]
    rows = [(m["n"], m["max_ms"] - m["min_ms"], timed)]
    return spark.createDataFrame(rows, "n long, spread_ms long, timed boolean")


@query(
    "S1 S2 T7",
    f"""WITH {MESSAGES_SQL} SELECT name, data FROM messages""",
)
def stream_delivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message comes three times, twice in the same batch."""
    base = work_dir(spark, "once")
    sent = messages(table(spark, sf_dir, "events")).select("name", "data")
    for folder, times in (("a", 2), ("b", 1)):
        sent.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_n").coalesce(1).write.parquet(
            f"{base}/in/{folder}"
        )
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1)
    given = stream.option("recursiveFileLookup", "true").parquet(f"{base}/in")
    once = delivered_once(given, "name").writeStream.format("parquet").option("path", f"{base}/out")
    once.option("checkpointLocation", f"{base}/checkpoint").trigger(**_TO_END).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


_BIN = "CASE WHEN ms > 0 THEN length(bin(ms)) ELSE 0 END"


@query(
    "A1 A2 U4",
    f"""WITH sent AS (SELECT event_type, epoch_us(ts) // 1000 - epoch_us(TIMESTAMP '2024-01-01') // 1000 AS ms FROM events),
binned AS (SELECT {_BIN} AS bin, count(*) AS n FROM sent GROUP BY ALL),
ranked AS (SELECT bin, sum(n) OVER (ORDER BY bin) AS seen, sum(n) OVER () AS total FROM binned)
SELECT count(*) FILTER (event_type <> 'error') AS n_ok, count(*) FILTER (event_type = 'error') AS n_failed,
       count(ms) AS n, CAST(sum(ms) AS BIGINT) AS sum_ms, min(ms) AS min_ms, max(ms) AS max_ms,
       (SELECT array_to_string(list_transform(range({BINS}), lambda i: coalesce(m[i], 0)), ',')
        FROM (SELECT map_from_entries(list((bin, n))) AS m FROM binned)) AS bins,
       (SELECT CAST(pow(2, min(bin)) AS BIGINT) - 1 FROM ranked WHERE seen >= ceil(total * 0.5)) AS median_ms
FROM sent""",
)
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters and latencies of a stream's batches, added up from the log of what was observed."""
    base = work_dir(spark, "metrics")
    log = MetricsLog(spark, f"{base}/log")
    millis = F.unix_millis(F.col("ts").cast("timestamp")) - F.unix_millis(F.lit("2024-01-01").cast("timestamp"))
    events = stream_table(spark, sf_dir, "events", _FILES)
    stream = observed_stream(events, "events", F.col("event_type") != "error", millis)
    spark.streams.addListener(log)
    try:
        sink = stream.writeStream.format("noop").option("checkpointLocation", f"{base}/checkpoint")
        sink.trigger(**_TO_END).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    sums = [F.sum(c).alias(c) for c in ("n_ok", "n_failed", "n", "sum_ms")]
    total = log.read().agg(*sums, F.min("min_ms").alias("min_ms"), F.max("max_ms").alias("max_ms"), sum_bins(F.col("bins")).alias("b"))
    text = F.array_join(F.col("b").cast("array<string>"), ",").alias("bins")
    return total.select("n_ok", "n_failed", "n", "sum_ms", "min_ms", "max_ms", text, quantile(F.col("b"), 0.5).alias("median_ms"))
