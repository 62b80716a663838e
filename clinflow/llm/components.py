"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours become neighbours of the smallest one of all."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("m").alias("u"), "v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours become neighbours of the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u"))
    least = down.groupBy("v").agg(F.min("u").alias("m"))
    moved = down.join(least, "v").filter("u <> m").select("m", "u")
    return moved.union(least.select("m", "v")).toDF("u", "v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected with, for nodes in ``edges``.

    ``edges`` has the two nodes of an edge as its first columns, in either order, loops and repeats
    allowed. Stars are formed until nothing moves, a number of rounds that grows with the logarithm
    of the nodes. A node's neighbours are only aggregated, never gathered, and every round is
    written to the shared folder.
    """
    a, b = edges.columns[:2]
    edges = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).filter("u <> v").distinct()
    state = None
    while True:
        edges = scratch(edges, "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state or now[0] == 0:
            break
        state, edges = now, _small_star(_large_star(edges))
    stars = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.union(edges.select("u", "u")).distinct()
