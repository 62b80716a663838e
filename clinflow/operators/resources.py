"""Resource log and current view.

Writes only append. The current state of a resource is its newest version, picked by an aggregate
that combines on the map side, so a resource with very many versions is no hot spot. The aggregate
sorts bodies; where the state is read often, ``CurrentView`` keeps it up without that.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.functions.jsonx import once
from clinflow.operators.key_filter import FILTER_BITS, key_filter, with_possible
from clinflow.operators.lookups import BROADCAST_BYTES, is_small, lookup_join
from clinflow.session import work_dir, written

_FIELD = re.compile(r"[A-Za-z_][\w-]*(\.[A-Za-z_][\w-]*|\[\d+\])*")


def current_resources(log: DataFrame) -> DataFrame:
    """The newest version of each resource; equal ones are decided by ``seq``, then by text."""
    newest = F.max(F.struct("version", "seq", "body"))
    return (
        log.groupBy("resource_type", "id")
        .agg(newest.alias("_r"))
        .select("resource_type", "id", "_r.version", "_r.seq", "_r.body")
    )


def read_resource(log: DataFrame, resource_type: str, resource_id: str) -> DataFrame:
    """One resource; the key reaches the file reader, before versions are compared."""
    return current_resources(
        log.filter((F.col("resource_type") == resource_type) & (F.col("id") == resource_id))
    )


def search_resources(
    log: DataFrame, resource_type: str, parameters: dict[str, str] | None = None
) -> DataFrame:
    """Current resources of a type whose fields all have the given values.

    Without parameters every resource of the type is returned.
    """
    found = current_resources(log.filter(F.col("resource_type") == resource_type))
    return with_fields(found, parameters or {})


def with_fields(resources: DataFrame, parameters: dict[str, str]) -> DataFrame:
    """Resources whose bodies have all the given values, compared as text."""
    for field in parameters:
        if not _FIELD.fullmatch(field):
            raise ValueError(f"bad search field {field!r}")
    if not parameters:
        return resources
    parsed = resources.withColumn("_doc", once(F.try_parse_json("body")))
    for field, value in parameters.items():
        parsed = parsed.filter(F.try_variant_get("_doc", f"$.{field}", "string") == value)
    return parsed.drop("_doc")


def current_messages(
    messages: DataFrame,
    tombstones: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Messages by name without the deleted ones.

    ``messages`` has one row per name and write; ``tombstones`` carry ``name`` and ``seq``, and one
    removes what was written before it. Few tombstones are broadcast, so that the store is not
    shuffled for them. Of many a filter of fixed size is broadcast, and only messages that may have
    one are shuffled. The store is read twice then, once for each kind.
    """
    newest = tombstones.groupBy("name").agg(F.max("seq").alias("_gone"))
    if is_small(newest, broadcast_bytes):
        found = messages.join(F.broadcast(newest), ["name"], "left")
        return found.filter("_gone IS NULL OR seq > _gone").drop("_gone").select(*messages.columns)
    words = written(key_filter(tombstones, ["name"], filter_bits), work_dir(messages.sparkSession, "filter"))
    marked = with_possible(messages, words, ["name"], "_possible", filter_bits)
    named = marked.filter("_possible").drop("_possible")
    left = lookup_join(named, newest, ["name"], small=False).filter("_gone IS NULL OR seq > _gone")
    return left.select(*messages.columns).union(marked.filter("NOT _possible").select(*messages.columns))
