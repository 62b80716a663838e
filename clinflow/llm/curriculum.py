"""Mix sources to target weights along a training run whose mixture changes with time.

Each source has a schedule: its weight as a piecewise linear function of the time, from 0 to 1. Its
integral is the source's share of all words demanded. A document's place in the run is where the
cumulative demand for its source reaches it; documents are then sorted by place, as ranges. Only
built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflow.llm.common import scratch, small_join, whole_row, words_of

Knots = Sequence[tuple[float, float]]


@dataclass(frozen=True)
class Mix:
    """``weights`` and ``shapes`` repeat over the sources, sorted by code point, null last.

    A shape is a list of (time, height) from time 0 to 1, heights positive; the weight of a source
    at some time is its weight times the height, over the shape's integral. ``max_repeats``: no
    source, and so no document, is taken more often. ``bucket_docs``: about so many documents are
    put in order by one task at a time.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    shapes: tuple[Knots, ...] = (
        ((0.0, 1.5), (1.0, 0.5)),
        ((0.0, 1.0), (1.0, 1.0)),
        ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
    )
    max_repeats: int = 3
    bucket_docs: int = 50_000


def source_targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """Per source: rank, documents, size, weight, and the words to take from it.

    With the sources in order of the demand level at which they reach their limit, the level of the
    others follows from sums over those before and behind; no iteration is needed. The windows run
    over one row per source.
    """
    sources = sized.groupBy("source").agg(
        F.count("*").alias("source_docs"), F.sum("size").alias("source_size")
    )
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w).cast("long") for w in mix.weights]), rank % len(mix.weights))
    limits = sources.withColumns(
        {"rank": rank, "weight": weight, "limit": mix.max_repeats * F.col("source_size")}
    )
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    full = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (total - F.coalesce(F.sum("limit").over(full), F.lit(0))) / F.sum("weight").over(rest)
    reach = F.col("limit") / F.col("weight")
    levels = limits.withColumn("level", level).withColumn("reach", reach)
    # The first source that stays under its limit sets the level for itself and all behind it.
    under = F.col("limit") > F.col("weight") * F.col("level")
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    common = F.min_by("level", F.when(under, F.struct("reach", "rank"))).over(whole)
    free = F.coalesce(F.col("limit") > F.col("weight") * F.col("common"), F.lit(False))
    return levels.withColumn("common", common).select(
        "source",
        "rank",
        "source_docs",
        "source_size",
        F.when(free, F.col("weight") * F.col("common"))
        .otherwise(F.col("limit").cast("double"))
        .alias("target"),
    )


def segments(shape: Knots) -> Column:
    """The pieces of a schedule: start, length, heights, and the area before, all over its integral."""
    area = sum((t1 - t0) * (h0 + h1) / 2 for (t0, h0), (t1, h1) in zip(shape, shape[1:]))
    if shape[0][0] != 0 or shape[-1][0] != 1 or min(h for _, h in shape) <= 0:
        raise ValueError("a shape runs from time 0 to 1 with positive heights")
    pieces, before = [], 0.0
    for (t0, h0), (t1, h1) in zip(shape, shape[1:]):
        named = {"t0": t0, "dt": t1 - t0, "h0": h0 / area, "h1": h1 / area, "before": before}
        pieces.append(F.struct(*[F.lit(float(v)).alias(k) for k, v in named.items()]))
        before += (t1 - t0) * (h0 + h1) / 2 / area
    return F.array(*pieces)


def time_of(share: Column, rank: Column, mix: Mix) -> Column:
    """When a source's cumulative demand reaches ``share`` of its target: the inverse integral."""
    shapes = F.array(*[segments(s) for s in mix.shapes])
    shape = F.get(shapes, (rank % len(mix.shapes)).cast("int"))
    piece = F.element_at(F.filter(shape, lambda p: (p["before"] <= share) | (p["before"] == 0)), -1)
    inverse = lambda p: p["t0"] + p["dt"] * (2 * (share - p["before"]) / p["dt"]) / (
        p["h0"]
        + F.sqrt(
            F.greatest(
                F.lit(0.0),
                p["h0"] * p["h0"] + 2 * (p["h1"] - p["h0"]) * (share - p["before"]) / p["dt"],
            )
        )
    )
    return F.get(F.transform(F.array(piece), inverse), 0)


def prefix_sums(sized: DataFrame, buckets: int) -> DataFrame:
    """Add ``before``: the size of all earlier documents of the source, in order of ``key``.

    The key's range is cut into buckets, whose sizes are summed first; no task orders more than a
    bucket of a source, however large the source.
    """
    width = (1 << 62) // buckets
    cut = sized.withColumn("bucket", F.expr(f"key div {width}"))
    sums = cut.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "source", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    both = ["source", "bucket"]
    named = starts.select(*[F.col(c).alias(f"_{c}") for c in both], "start")
    match = F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    return placed.join(named, match).withColumn("before", F.col("start") + F.col("inside")).drop(
        "_source", "_bucket", "start", "inside", "bucket"
    )


def by_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """The rows with the figures of their source, which may be null."""
    name = F.struct(F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none"))
    figures = sources.withColumn("at", name).drop("source")
    return small_join(rows.withColumn("at", name), figures, ["at"], "inner").drop("at")


def assign(docs: DataFrame, mix: Mix = Mix(), keep: list[str] | None = None) -> DataFrame:
    """Every row with how often it is taken, and when.

    Returns struct ``row`` (the columns in ``keep``, or all), ``size`` (words; null text: 0), the
    source's ``source_size`` and ``target``, ``copies``, ``taken`` (words), and ``times``: the place
    of each copy in the run, in [0, 1).

    A source is gone through in the order of a hash of document and text: whole as often as its
    target holds it, then as far as the rest goes, and of the documents beyond, the one whose size
    comes nearest to what is still missing is taken if that helps. Documents without words are taken
    as often as their neighbours. Rows that are equal in id and text are taken one by one; reruns
    agree, for equal rows can stand for each other. An empty table gives an empty one. A null source
    is a source.
    """
    rows = docs.select(
        whole_row(docs, keep),
        F.col("source").cast("string").alias("source"),
        F.size(words_of(F.col("text"))).cast("long").alias("size"),
        F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).alias("key"),
        F.struct(F.col("doc_id").cast("string"), F.xxhash64(F.lit(1), "text")).alias("tie"),
        F.monotonically_increasing_id().alias("rid"),
    )
    sized = scratch(rows, "sized")
    targets = scratch(source_targets(sized.select("source", "size"), mix), "targets")
    largest = targets.agg(F.max("source_docs")).first()[0] or 0
    slim = sized.select("rid", "source", "size", "key", "tie")
    placed = by_source(prefix_sums(slim, max(256, -(-largest // mix.bucket_docs))), targets)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    placed = placed.withColumn("whole", whole.cast("long")).withColumn(
        "part", F.col("target") - F.col("whole") * F.col("source_size")
    )
    end = F.col("before") + F.col("size")
    inside = (F.col("part") > 0) & (end <= F.col("part"))
    placed = scratch(placed.withColumn("inside", inside), "placed")

    reached = placed.groupBy("source").agg(F.coalesce(F.max(F.when(F.col("inside"), end)), F.lit(0)).alias("reached"))
    missing = F.col("part") - F.col("reached")
    beyond = by_source(placed.filter("NOT inside"), scratch(reached, "reached")).withColumn(
        "off", F.abs(missing - F.col("size"))
    )
    nearest = F.min_by(F.struct("rid", "reached"), F.struct("off", "key", "tie")).alias("best")
    extra = beyond.filter(F.col("off") < missing).groupBy("source").agg(nearest)
    extra = scratch(extra.select("best.rid", F.col("best.reached").alias("instead")), "extra")

    decided = small_join(placed, extra, ["rid"])
    copies = F.col("whole") + (F.col("inside") | F.col("instead").isNotNull()).cast("long")
    at = lambda i: F.when(
        i < F.col("whole"), i * F.col("source_size") + F.col("before")
    ).otherwise(F.col("whole") * F.col("source_size") + F.coalesce("instead", "before"))
    share = lambda i: F.when(
        F.col("target") > 0,
        F.least(F.lit(1.0 - 1e-12), (at(i) + F.col("size") / 2) / F.col("target")),
    ).otherwise(0.0)
    turns = F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    decisions = decided.withColumn("copies", copies).select(
        "rid",
        "source_size",
        "target",
        "copies",
        F.transform(turns, lambda i: time_of(share(i), F.col("rank"), mix)).alias("times"),
    )
    # Every row has a decision, so that this side is never a small one: the same plan at every size.
    return sized.join(scratch(decisions, "decisions").hint("merge"), "rid").select(
        "row",
        "size",
        "source",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
        "times",
    )


def training_order(assigned: DataFrame) -> DataFrame:
    """One row per copy taken, sorted by its place in the run: ranges over the partitions."""
    copies = assigned.select("row", F.explode("times").alias("position"))
    return copies.repartitionByRange("position").sortWithinPartitions("position").select(
        "row.*"
    )
