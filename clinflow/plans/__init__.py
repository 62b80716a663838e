"""Queries that run every operator over the test tables."""

from clinflow.plans import (  # noqa: F401 - importing registers the queries
    errors,
    feed,
    mapping,
    resources,
    segments,
    store,
    streams,
    studies,
    tables,
    user_functions,
)
from clinflow.plans.registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
