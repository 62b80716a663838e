"""Mapping definitions from text or from any file system Spark can read."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

from clinflow.operators.mapping import Mapping, MappingError

_loaded: WeakKeyDictionary[SparkSession, dict[str, Mapping]] = WeakKeyDictionary()


def load_mapping(
    spark: SparkSession, path: str | None = None, text: str | None = None, force: bool = False
) -> Mapping:
    """The definition given as text, or else the one at ``path``.

    A path is read once per session; ``force`` reads it again. Whatever cannot be used as a
    definition raises before a query starts.
    """
    if text:
        return Mapping.from_text(text)
    if not path:
        raise MappingError("neither a text nor a path is given")
    known = _loaded.setdefault(spark, {})
    if force or path not in known:
        rows = spark.read.text(path, wholetext=True).limit(2).collect()
        if len(rows) != 1:
            raise MappingError(f"{len(rows) or 'no'} definitions at the path, one is needed")
        known[path] = Mapping.from_text(rows[0]["value"])
    return known[path]
