"""Bundle execution and resource writes."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.functions import jsonx
from clinflow.operators.guarded import OfRow, guarded_map
from clinflow.operators.mapping import checked_entries
from clinflow.operators.outcomes import (
    checked,
    error_entry,
    is_success,
    split_ok,
    to_io_error_rows,
)
from clinflow.sinks.files import write_batch

EXECUTE_STEP = "ExecuteBundles"
Client = Callable[[], Callable[[pd.DataFrame], pd.DataFrame] | OfRow]
_REPLY = T.StructType(
    [T.StructField("status", T.IntegerType()), T.StructField("reply", T.StringType())]
)


def check_bundles(df: DataFrame, body: str = "output") -> DataFrame:
    """A body has to be valid JSON before it is executed."""
    parsed = jsonx.with_document(df, body, "_doc")
    message = jsonx.not_parsed(F.col(body), F.col("_doc"), "the body is not valid JSON")
    entry = error_entry(message, EXECUTE_STEP, resource=F.coalesce(body, F.lit("")))
    return checked(parsed, jsonx.is_json(F.col("_doc")), entry).drop("_doc")


def failed_bodies(
    bad: DataFrame, body: str = "output", status: Column | None = None
) -> DataFrame:
    """Rejected bodies as E6 rows; a body that was never sent has no status."""
    return to_io_error_rows(bad, F.col(body), F.col("error.error_message"), status)


def post_bundles(
    df: DataFrame, client: Client, body: str = "output", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Send bodies with a client of the caller's.

    ``client`` is called once per task; what it returns gets one body at a time, as a batch of one
    row, and answers with ``status`` and ``reply``; an ``OfRow`` gets it as a dict, which is far
    cheaper, and answers with a pair. A status other than 2xx, and an exception, reject the row. No body is sent again because another one failed.
    """
    sent = guarded_map(
        df.select(*keep, body), client, _REPLY, EXECUTE_STEP, resource=body, one_by_one=True
    )
    refused = error_entry(F.coalesce("reply", F.lit("")), EXECUTE_STEP, resource=F.col(body))
    ok = F.col("ok") & is_success(F.col("status"))
    return sent.select(
        *keep,
        body,
        "status",
        "reply",
        ok.alias("ok"),
        F.when(~ok, F.coalesce("error", refused)).alias("error"),
    )


def checked_resources(bundles: DataFrame, body: str, version: str, seq: str) -> DataFrame:
    """The entries of bundles as rows of the resource log, with ``ok`` and ``error``.

    The url of an entry names type and id; without an id there, the resource's own counts, and a
    resource without either gets one from its content, so a repeated write is the same resource.
    Entries that are no PUT of a resource, and texts that are no bundle, are rejected.
    """
    entries = checked_entries(bundles, body, [version, seq], EXECUTE_STEP).withColumnsRenamed(
        {"ok": "_read", "error": "_unread"}
    )
    path = F.split(F.regexp_replace(F.coalesce("url", F.lit("")), "^/+", ""), "/")
    named = lambda i: F.nullif(F.get(path, i), F.lit(""))
    rows = entries.select(
        F.coalesce(named(0), "resource_type").alias("resource_type"),
        F.coalesce(named(1), "id", F.sha2("body", 256)).alias("id"),
        F.col(version).cast("long").alias("version"),
        F.col(seq).cast("long").alias("seq"),
        "body",
        "method",
        "_read",
        "_unread",
    )
    ok = F.col("_read") & (F.col("method") == "PUT") & F.col("body").isNotNull()
    message = F.when(
        F.coalesce(F.col("method") == "PUT", F.lit(False)), F.lit("the entry has no resource")
    ).otherwise(F.lit("the entry is not a PUT"))
    entry = error_entry(message, EXECUTE_STEP, resource=F.coalesce("body", F.lit("")))
    return checked(rows, ok, F.coalesce("_unread", entry)).drop("method", "_read", "_unread")


def resource_rows(bundles: DataFrame, body: str, version: str, seq: str) -> DataFrame:
    """The accepted entries."""
    return split_ok(checked_resources(bundles, body, version, seq))[0]


def execute_bundles(
    df: DataFrame,
    log: str,
    batch_id: int,
    body: str = "output",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Append valid bodies to the bundle log; the result is the failed ones, as E6 rows."""
    good, bad = split_ok(check_bundles(df, body))
    write_batch(good.select(*keep, F.col(body).alias("bundle")), log, batch_id)
    return failed_bodies(bad, body)
