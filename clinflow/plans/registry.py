"""Named queries over the test tables, each with the blueprint IDs it covers and its SQL check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Build
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, oracle: str | None = None) -> Callable[[Build], Build]:
    """Register a function under its own name; ``covers`` lists IDs, separated by spaces."""

    def register(build: Build) -> Build:
        name = build.__name__
        if name in REGISTRY:
            raise ValueError(f"two queries named {name}")

        @wraps(build)
        def build_in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            """The times of the tables have no zone; they are taken as UTC."""
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf_dir)

        REGISTRY[name] = Query(name, tuple(covers.split()), build_in_utc, oracle)
        return build

    return register
