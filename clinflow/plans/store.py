"""Message store scans, lookups by id, exports and store writes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.functions.times import earliest_default, latest_default
from clinflow.operators.lookups import fetch_by_id
from clinflow.operators.mapping import Mapping, const, copy, map_stage, mappable
from clinflow.operators.metrics import count_by_step
from clinflow.operators.outcomes import split_ok, to_io_error_rows
from clinflow.operators.resources import current_messages
from clinflow.operators.store import (
    density_scan,
    density_slices,
    first_by_time,
    hour_counts,
    ordered,
    pinned_bounds,
    read_stores,
    required_bounds,
    scan,
    send_bounds,
    sorted_ranges,
    store_scan,
    time_slices,
    unite_stores,
    with_slice,
)
from clinflow.plans.inputs import (
    EXPORTED_SQL,
    MESSAGES_SQL,
    PATIENTS_SQL,
    export_values,
    message_store,
    patients,
)
from clinflow.plans.mapping import patient_transactions
from clinflow.plans.registry import query
from clinflow.session import table, work_dir
from clinflow.sinks.messages import (
    create_messages,
    delete_messages,
    ingest_checked,
    ingest_messages,
    ingest_projection,
)
from clinflow.sources.exports import (
    BUNDLE_PER_LINE,
    export_range,
    import_resources,
    parse_messages,
)
from clinflow.sources.notifications import parameters
from clinflow.sources.stores import micros, read_store

_WITH = f"WITH {MESSAGES_SQL}"
_COLUMNS = ["store", "name", "data", "send_time"]
_SELECT = "SELECT store, name, data, send_time FROM messages"


@query("S4", f"{_WITH} {_SELECT} WHERE store = 'click'")
def store_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_stores(message_store(spark, sf_dir), "click").select(_COLUMNS)


@query("S5", f"{_WITH} {_SELECT} WHERE store IN ('click', 'view', 'error')")
def multi_store_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["click", "view", "error"]
    return read_stores(message_store(spark, sf_dir), wanted).select(_COLUMNS)


@query(
    "S5 O3",
    """
SELECT 'events' AS store, 'e' || event_id AS name, props AS data FROM events
UNION ALL SELECT 'chat', 'c' || conv_id || '/' || turn, text FROM conversations
UNION ALL SELECT 'notes', 'd' || doc_id, text FROM documents
""",
)
def united_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = {
        "events": table(spark, sf_dir, "events").selectExpr(
            "concat('e', event_id) AS name", "props AS data"
        ),
        "chat": table(spark, sf_dir, "conversations").selectExpr(
            "concat('c', conv_id, '/', turn) AS name", "text AS data"
        ),
        "notes": table(spark, sf_dir, "documents").selectExpr(
            "concat('d', doc_id) AS name", "text AS data"
        ),
    }
    return unite_stores(stores).select("store", "name", "data")


@query("S6", f"""{_WITH} {_SELECT} WHERE store = 'purchase' AND "value" > 10""")
def store_read_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = scan(read_stores(message_store(spark, sf_dir), "purchase"), where="value > 10")
    return chosen.select(_COLUMNS)


@query("S6 S5", f"""{_WITH} {_SELECT} WHERE store IN ('click', 'signup') AND "value" <= 10""")
def multi_store_read_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = read_stores(message_store(spark, sf_dir), ["click", "signup"])
    return scan(chosen, where=F.col("value") <= 10).select(_COLUMNS)


@query(
    "S7",
    f"""{_WITH} {_SELECT} WHERE send_time >= TIMESTAMP '2024-01-05 06:00:00'
AND send_time < TIMESTAMP '2024-01-20 00:00:00' AND store <> 'error'""",
)
def send_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded = scan(
        message_store(spark, sf_dir), "2024-01-05T06:00:00", "2024-01-20T00:00:00",
        "store <> 'error'",
    )
    return bounded.select(_COLUMNS)


class EventStore:
    """The events' files as a store with a client of its own, as a remote one has."""

    def __init__(self, path: str) -> None:
        self.path = path

    def bounds(self):
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        ends = [pc.min_max(b.column("ts")) for b in ds.dataset(self.path).to_batches(columns=["ts"]) if b.num_rows]
        times = [micros(e[side].as_py()) for e in ends for side in ("min", "max") if e[side].is_valid]
        return (min(times), max(times) + 1) if times else None

    def read(self, start, end, names):
        import pyarrow as pa
        import pyarrow.dataset as ds

        at = ds.field("ts")
        wanted = (at >= pa.scalar(start, pa.timestamp("us"))) & (at < pa.scalar(end, pa.timestamp("us")))
        if names is not None:
            wanted &= ds.field("event_type").isin(names)
        columns = ["event_type", "event_id", "props", "ts"]
        for batch in ds.dataset(self.path).to_batches(columns=columns, filter=wanted):
            kind, number = batch.column("event_type"), batch.column("event_id")
            named = [f"stores/{k}/messages/{n}" for k, n in zip(kind.to_pylist(), number.to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [kind, pa.array(named, pa.string()), batch.column("props"), batch.column("ts").cast(pa.timestamp("us"))],
                names=_COLUMNS,
            )


@query(
    "S7 S5 S9 U3",
    f"""{_WITH} {_SELECT} WHERE send_time >= TIMESTAMP '2024-01-05 06:00:00'
AND send_time < TIMESTAMP '2024-01-20 00:00:00' AND store IN ('click', 'view')""",
)
def client_store_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A span of a store that only its own client reads, a partition per day."""
    path = f"{sf_dir}/events.parquet"
    schema = "store string, name string, data string, send_time timestamp_ntz"
    store = read_store(spark, "event_store", lambda: EventStore(path), schema)
    chosen = read_stores(scan(store, "2024-01-05T06:00:00", "2024-01-20T00:00:00"), ["click", "view"])
    return chosen.select(_COLUMNS)


@query("S7", f"""{_WITH} {_SELECT} WHERE "value" > 20""")
def send_time_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(message_store(spark, sf_dir), where="value > 20").select(_COLUMNS)


@query("S8 T5", f"{_WITH} {_SELECT}")
def sorted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_ranges(message_store(spark, sf_dir)).select(_COLUMNS)


@query("O2 S8", f"{_WITH} {_SELECT} WHERE store = 'view' ORDER BY send_time DESC, name")
def ordered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = read_stores(message_store(spark, sf_dir), "view")
    return ordered(chosen, [F.col("send_time").desc(), "name"]).select(_COLUMNS)


_BOUNDS_SQL = """
bounds AS (
  SELECT store, min(epoch_us(send_time) // 1000) AS from_ms, max(epoch_us(send_time) // 1000) + 1 AS to_ms
  FROM messages GROUP BY store)
"""


@query("A3", f"{_WITH}, {_BOUNDS_SQL} SELECT * FROM bounds")
def send_time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return send_bounds(message_store(spark, sf_dir), ["store"])


@query(
    "A3",
    f"{_WITH}, {_BOUNDS_SQL} SELECT min(from_ms) AS from_ms, max(to_ms) AS to_ms FROM bounds",
)
def send_time_bounds_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return required_bounds(message_store(spark, sf_dir))


@query(
    "O1",
    f"""{_WITH}
(SELECT 'first' AS which, name, send_time FROM messages ORDER BY send_time, name LIMIT 1)
UNION ALL
(SELECT 'last', name, send_time FROM messages ORDER BY send_time DESC, name DESC LIMIT 1)""",
)
def first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = message_store(spark, sf_dir)
    ends = {"first": first_by_time(store), "last": first_by_time(store, latest=True)}
    one, other = [
        df.select(F.lit(which).alias("which"), "name", "send_time") for which, df in ends.items()
    ]
    return one.unionByName(other)


_DAY, _HOUR = 86_400_000, 3_600_000
_SLICES_SQL = f"""
sized AS (
  SELECT *, greatest((to_ms - from_ms) // {_DAY}
    + CASE WHEN (to_ms - from_ms) % {_DAY} >= {_HOUR} THEN 1 ELSE 0 END, 1) AS n FROM bounds),
slices AS (
  SELECT store, slice_id, from_ms + slice_id * {_DAY} AS slice_from,
         CASE WHEN slice_id = n - 1 THEN to_ms ELSE from_ms + (slice_id + 1) * {_DAY} END AS slice_to
  FROM (SELECT *, unnest(range(n)) AS slice_id FROM sized))
"""


@query(
    "S9",
    f"{_WITH}, {_BOUNDS_SQL}, {_SLICES_SQL} SELECT store, slice_id, slice_from, slice_to FROM slices",
)
def scan_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_slices(pinned_bounds(message_store(spark, sf_dir), ["store"]), ["store"])


_SLICED_SQL = f"""{_WITH}, {_BOUNDS_SQL}, {_SLICES_SQL},
sliced AS (
  SELECT m.store, m.name, m.data, m.send_time, s.slice_id FROM messages m JOIN slices s
    ON m.store = s.store AND epoch_us(m.send_time) // 1000 >= s.slice_from
   AND epoch_us(m.send_time) // 1000 < s.slice_to)
"""


@query(
    "L4 S9",
    _SLICED_SQL + "SELECT store, slice_id, count(*) AS n_messages FROM sliced GROUP BY ALL",
)
def slice_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = message_store(spark, sf_dir)
    sliced = with_slice(store, pinned_bounds(store, ["store"]), ["store"])
    return sliced.groupBy("store", "slice_id").agg(F.count(F.lit(1)).alias("n_messages"))


@query("T9 S8 S9 L4 T5", _SLICED_SQL + "SELECT * FROM sliced")
def store_scan_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_scan(message_store(spark, sf_dir)).select(*_COLUMNS, "slice_id")


_DENSITY_SQL = f"""
hours AS (
  SELECT store, epoch_us(send_time) // 1000 // {_HOUR} AS hour, count(*) AS n,
         min(epoch_us(send_time) // 1000) AS first_ms, max(epoch_us(send_time) // 1000) AS last_ms
  FROM messages GROUP BY ALL),
parted AS (
  SELECT *, floor((sum(n) OVER (PARTITION BY store ORDER BY hour) - n)
    / (sum(n) OVER (PARTITION BY store) / ceil((max(hour) OVER (PARTITION BY store)
       - min(hour) OVER (PARTITION BY store) + 1) * {_HOUR} / {_DAY}))) AS part
  FROM hours),
grouped AS (
  SELECT store, part, min(hour) AS hour, min(first_ms) AS first_ms, max(last_ms) AS last_ms,
         CAST(sum(n) AS BIGINT) AS n_messages
  FROM parted GROUP BY store, part),
density AS (
  SELECT store, row_number() OVER w - 1 AS slice_id, n_messages,
         CASE WHEN row_number() OVER w = 1 THEN first_ms ELSE hour * {_HOUR} END AS slice_from,
         coalesce(lead(hour) OVER w * {_HOUR}, last_ms + 1) AS slice_to
  FROM grouped WINDOW w AS (PARTITION BY store ORDER BY hour))
"""


@query(
    "S9",
    f"{_WITH}, {_DENSITY_SQL} SELECT store, slice_id, slice_from, slice_to, n_messages FROM density",
)
def dense_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices by density: about as many messages in each, none shorter than an hour."""
    return density_slices(hour_counts(message_store(spark, sf_dir), ["store"]), ["store"])


@query(
    "T9 S8 S9 L4",
    f"""{_WITH}, {_DENSITY_SQL}
SELECT m.store, m.name, m.data, m.send_time, d.slice_id FROM messages m JOIN density d
  ON m.store = d.store AND epoch_us(m.send_time) // 1000 >= d.slice_from
 AND epoch_us(m.send_time) // 1000 < d.slice_to""",
)
def dense_scan_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density_scan(message_store(spark, sf_dir)).select(*_COLUMNS, "slice_id")


@query(
    "P12 F8",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE epoch_us(ts) // 1000 END AS earliest_ms,
       event_type <> 'error' AS latest_is_given
FROM events
""",
)
def bound_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    sent = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_type") == "error", "").otherwise(text).alias("sent")
    )
    return sent.select(
        "event_id",
        F.unix_millis(earliest_default(F.col("sent"))).alias("earliest_ms"),
        (latest_default(F.col("sent")) == F.col("ts").cast("timestamp")).alias("latest_is_given"),
    )


@query(
    "P6 J11",
    f"""{_WITH} SELECT name AS id, '{{"kind":"Message","body":' || replace(data, ' ', '') || '}}' AS output,
epoch_us(send_time) // 1000 AS created_ms FROM messages""",
)
def mappable_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored messages, with their create times, through a mapping."""
    mapping = Mapping([const("", "kind", "Message"), copy("", "body", "$.data")])
    given = mappable(message_store(spark, sf_dir))
    good, _ = split_ok(map_stage(given, mapping, source_time="create_time"))
    created = F.unix_millis(F.col("source_time").cast("timestamp"))
    return good.select("id", "output", created.alias("created_ms"))


@query(
    "S19 S5",
    f"""{_WITH} SELECT store, count(*) AS n_messages FROM messages
WHERE store IN ('click', 'purchase', 'view') GROUP BY store""",
)
def parameter_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = parameters(spark, ["click", "purchase", "view", "unknown"], "store")
    sizes = message_store(spark, sf_dir).groupBy("store").agg(F.count(F.lit(1)).alias("n_messages"))
    return sizes.join(wanted, "store", "left_semi")


# -- lookups by id ---------------------------------------------------------------------------------


def _parts_by_line(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    """Each line asks for its part; parts of the largest sizes are not in the store."""
    ids = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_shipdate", "concat('parts/', l_partkey) AS name"
    )
    store = (
        table(spark, sf_dir, "part")
        .filter("p_size <= 40")
        .selectExpr("concat('parts/', p_partkey) AS name", "p_name AS data")
    )
    return fetch_by_id(ids, store, **limits)


_FETCH_SQL = """
WITH fetched AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, 'parts/' || l_partkey AS name,
         p_partkey IS NOT NULL AS found, p_name AS data
  FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 40) ON l_partkey = p_partkey)
"""


@query(
    "S3 L2",
    _FETCH_SQL + "SELECT l_orderkey, l_linenumber, name, data FROM fetched WHERE found",
)
def fetched_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _parts_by_line(spark, sf_dir).filter("found")
    return found.select("l_orderkey", "l_linenumber", "name", "data")


@query(
    "S3 L2",
    _FETCH_SQL + "SELECT l_orderkey, l_linenumber, name, data FROM fetched WHERE found",
)
def fetched_messages_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a filter of the wanted names before the join."""
    found = _parts_by_line(spark, sf_dir, broadcast_bytes=0, filter_bits=1 << 18).filter("found")
    return found.select("l_orderkey", "l_linenumber", "name", "data")


@query(
    "S3 L2 E6",
    _FETCH_SQL
    + """SELECT name AS "dataElement", l_shipdate AS observed_time,
'no message of this name' AS message, 404 AS "statusCode" FROM fetched WHERE NOT found""",
)
def fetch_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    missed = _parts_by_line(spark, sf_dir).filter("NOT found")
    rows = to_io_error_rows(
        missed,
        F.col("name"),
        F.lit("no message of this name"),
        F.lit(404),
        F.col("l_shipdate"),
    )
    return rows.select("dataElement", "observed_time", "message", "statusCode")


# -- exports and bulk files ------------------------------------------------------------------------

_PARSED_SQL = f"WITH {EXPORTED_SQL}"


@query(
    "S11 P10 F8",
    _PARSED_SQL
    + """
SELECT rid, event_type || '/' || event_id AS name, base64(encode(props)) AS data,
       props AS schematized_data, '{"user":"' || user_id || '"}' AS labels,
       epoch_us(ts) // 1000 AS send_ms
FROM lines WHERE event_type IN ('click', 'view', 'purchase')
""",
)
def export_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_ok(parse_messages(export_values(spark, sf_dir)))
    return good.select(
        "rid",
        "name",
        "data",
        "schematized_data",
        F.to_json("labels").alias("labels"),
        F.unix_millis("send_time").alias("send_ms"),
    )


@query(
    "S11 P10 P13",
    _PARSED_SQL
    + """
SELECT rid, value, CASE event_type WHEN 'signup' THEN 'the message has no schematized data'
  WHEN 'error' THEN 'the input message is invalid' ELSE 'the line is not a JSON object' END
  AS error_message
FROM lines WHERE event_type IS NULL OR event_type IN ('signup', 'error')
""",
)
def export_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_ok(parse_messages(export_values(spark, sf_dir)))
    return bad.select(
        "rid", F.col("error.error_resource").alias("value"), "error.error_message"
    )


@query(
    "S10",
    _PARSED_SQL
    + """
SELECT rid, event_type || '/' || event_id AS name FROM lines
WHERE event_type IN ('click', 'view', 'purchase') AND ts >= TIMESTAMP '2024-01-10 00:00:00'
""",
)
def export_send_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_ok(parse_messages(export_values(spark, sf_dir)))
    return export_range(good, "2024-01-10T00:00:00Z", "").select("rid", "name")


@query(
    "S17",
    f"""WITH {PATIENTS_SQL}
SELECT 'Patient' AS resource_type, id, true AS ok FROM patients
UNION ALL SELECT NULL, NULL, false FROM documents""",
)
def bulk_import_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    typed = F.concat(F.lit('{"resourceType":"Patient",'), F.substr("data", F.lit(2)))
    lines = patients(spark, sf_dir).select(typed.alias("value")).unionByName(documents)
    return import_resources(lines).select("resource_type", "id", "ok")


@query(
    "S17 J10",
    f"""WITH {PATIENTS_SQL} SELECT 'Patient' AS resource_type, id, true AS ok FROM patients
UNION ALL SELECT NULL, NULL, false FROM documents""",
)
def bulk_import_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles, and document texts as lines that are none."""
    bundles = patient_transactions(spark, sf_dir).select(F.col("output").alias("value"))
    lines = bundles.unionByName(table(spark, sf_dir, "documents").select(F.col("text").alias("value")))
    return import_resources(lines, BUNDLE_PER_LINE).select("resource_type", "id", "ok")


# -- store writes ----------------------------------------------------------------------------------

_INGEST_SQL = """
WITH sent AS (
  SELECT CASE WHEN event_type = 'error' THEN '' ELSE props END AS data,
         '{"user":"' || user_id || '"}' AS labels FROM events
  UNION ALL SELECT text, '{"lang":"' || lang || '"}' FROM documents)
"""


def _sent_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to ingest; those of error events have no data."""
    events = message_store(spark, sf_dir).select(
        F.when(F.col("store") == "error", "").otherwise(F.col("data")).alias("data"), "labels"
    )
    documents = table(spark, sf_dir, "documents").select(
        F.col("text").alias("data"), F.create_map(F.lit("lang"), F.col("lang")).alias("labels")
    )
    return events.unionByName(documents)


@query("P7 W1", _INGEST_SQL + "SELECT data, labels FROM sent WHERE data <> ''")
def ingest_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_ok(ingest_checked(_sent_messages(spark, sf_dir)))
    return ingest_projection(good).select("data", F.to_json("labels").alias("labels"))


@query(
    "W1 E6",
    _INGEST_SQL
    + """SELECT data AS "dataElement", 'the store rejected the message' AS message,
CAST(NULL AS INTEGER) AS "statusCode" FROM sent WHERE data = ''""",
)
def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = ingest_messages(_sent_messages(spark, sf_dir), work_dir(spark, "ingest"), 0)
    return rejected.select("dataElement", "message", "statusCode")


@query(
    "A1 P13",
    f"""{_PARSED_SQL},
{_FETCH_SQL.strip().removeprefix("WITH ")},
{_INGEST_SQL.strip().removeprefix("WITH ")}
SELECT 'ParseMessage' AS step, count(*) FILTER (event_type IN ('click', 'view', 'purchase')) AS n_ok,
       count(*) FILTER (event_type IS NULL OR event_type IN ('signup', 'error')) AS n_failed FROM lines
UNION ALL
SELECT 'FetchMessage', count(*) FILTER (found), count(*) FILTER (NOT found) FROM fetched
UNION ALL
SELECT 'IngestMessages', count(*) FILTER (data <> ''), count(*) FILTER (data = '') FROM sent""",
)
def feed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that passed and failed, for each stage that reads or writes them."""
    stages = {
        "ParseMessage": parse_messages(export_values(spark, sf_dir)),
        "FetchMessage": _parts_by_line(spark, sf_dir).withColumnRenamed("found", "ok"),
        "IngestMessages": ingest_checked(_sent_messages(spark, sf_dir)),
    }
    named = [df.select("ok", F.lit(step).alias("step")) for step, df in stages.items()]
    return count_by_step(reduce(DataFrame.unionByName, named))


@query(
    "W2 S7",
    f"""{_WITH} SELECT store, name, data, schematized_data, '{{"user":"' || user_label || '"}}' AS labels
FROM messages WHERE send_time >= TIMESTAMP '2024-01-12 00:00:00'
AND send_time < TIMESTAMP '2024-01-15 12:00:00'""",
)
def created_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "store")
    create_messages(message_store(spark, sf_dir), path, 0)
    stored = scan(spark.read.parquet(path), "2024-01-12T00:00:00", "2024-01-15T12:00:00")
    return stored.select("store", "name", "data", "schematized_data",
                         F.to_json("labels").alias("labels"))


@query(
    "W3",
    f"{_WITH} SELECT name, data, event_id AS seq FROM messages WHERE store <> 'error'",
)
def message_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error messages are deleted; tombstones older than their message remove nothing."""
    return _undeleted(spark, sf_dir).select("name", "data", "seq")


def _undeleted(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    store = message_store(spark, sf_dir)
    later = store.filter("store = 'error'").selectExpr("name", "event_id + 1 AS seq")
    earlier = store.filter("store = 'view'").selectExpr("name", "event_id - 1 AS seq")
    path = work_dir(spark, "tombstones")
    delete_messages(later, path, 0)
    delete_messages(earlier, path, 1)
    return current_messages(
        store.selectExpr("name", "data", "event_id AS seq"),
        spark.read.parquet(path).select("name", "seq"),
        **limits,
    )


@query(
    "W3",
    f"{_WITH} SELECT name, data, event_id AS seq FROM messages WHERE store <> 'error'",
)
def message_delete_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As if the tombstones were too many to be broadcast: a filter of them is."""
    live = _undeleted(spark, sf_dir, broadcast_bytes=0, filter_bits=1 << 18)
    return live.select("name", "data", "seq")
