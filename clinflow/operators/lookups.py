"""Lookups as equi joins.

A reference table is broadcast only after its size was measured. Beyond that the join is shuffled,
and keys that hold many rows are spread over several tasks: every part of a hot key is sent to the
tasks that hold a copy of its one reference row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.operators.key_filter import key_filter, with_possible
from clinflow.session import work_dir, written

BROADCAST_BYTES = 32 * 1024 * 1024
MEASURE_BYTES = 1024 * 1024 * 1024
HOT_ROWS = 500_000
MAX_HOT_KEYS = 1000
SAMPLE_ROWS = 5_000
MAX_WANTED_KEYS = 50_000
# Spark gives inputs of unknown size, such as a micro-batch, one far beyond any real size.
UNKNOWN_BYTES = 2**60


def measured_bytes(df: DataFrame, limit: int = BROADCAST_BYTES) -> int | None:
    """Rough in-memory size of ``df``, or None when it is over ``limit`` or costly to find out.

    The size is measured, as an estimate from compressed files may be far too low, and one across
    joins far too high. Measuring reads the inputs once, so only inputs up to ``MEASURE_BYTES`` are
    measured.
    """
    if sum(_leaf_bytes(df)) > MEASURE_BYTES:
        return None
    row = df.agg(F.sum(_row_bytes(df)).alias("n")).first()
    size = int(row["n"] or 0)
    return size if size <= limit else None


def _leaf_bytes(df: DataFrame) -> list[int]:
    """The sizes of the inputs of a plan, as far as Spark knows them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return [leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size())]


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(16 + 8 * len(df.columns))
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return size.cast("long")


def sampled_counts(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Rows per key, ``_n``, from a sample in which a key of ``size`` rows still shows clearly.

    For finding out which keys are heavy, not for results: only a share of the keys is shuffled.
    """
    share = min(1.0, SAMPLE_ROWS / size)
    sample = df.select(*keys) if share == 1.0 else df.select(*keys).sample(share, seed=7)
    return sample.groupBy(*keys).agg((F.count(F.lit(1)) / share).alias("_n"))


def hot_keys(
    df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS, counts: DataFrame | None = None
) -> list[Row]:
    """The heaviest keys, of ``hot_rows`` rows or more, and into how many parts to spread each.

    They are found now, as both sides of a join have to see the same list. It is bounded; keys
    beyond it are joined unspread, none is lost. A missing key can be among them.
    """
    heavy = (
        (sampled_counts(df, on, hot_rows) if counts is None else counts)
        .filter(F.col("_n") >= hot_rows)
        .orderBy(F.col("_n").desc())
        .limit(MAX_HOT_KEYS)
    )
    return heavy.select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_hot_parts")).collect()


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    hot_rows: int | list[Row] = HOT_ROWS,
) -> DataFrame:
    """Shuffled join with hot left keys spread; ``right`` holds one row per key. ``hot_rows`` tells from
    how many rows on a key is hot, or which keys are, if :func:`hot_keys` found them already.

    Without hot keys it is a plain join, so tables that are bucketed by the key need no shuffle.
    Else the part of a row is that of its input task: the same on a retry, and different for equal
    rows. Rows without a key match nothing, so they are spread as well.
    """
    rows = hot_keys(left, on, hot_rows) if isinstance(hot_rows, int) else hot_rows
    if not rows:
        return left.join(right, on, how)
    schema = T.StructType(
        [T.StructField(c, left.schema[c].dataType) for c in on]
        + [T.StructField("_hot_parts", T.IntegerType())]
    )
    given = [r for r in rows if None not in tuple(r)]
    hot = F.broadcast(left.sparkSession.createDataFrame(given, schema))
    no_key = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    part = F.when(no_key, F.spark_partition_id()).when(
        F.col("_hot_parts").isNotNull(), F.pmod(F.spark_partition_id(), F.col("_hot_parts"))
    )
    parted_left = left.join(hot, on, "left").withColumn("_part", F.coalesce(part, F.lit(0)))
    parts = F.sequence(F.lit(0), F.coalesce(F.col("_hot_parts"), F.lit(1)) - 1)
    parted_right = (
        right.join(hot, on, "left").withColumn("_part", F.explode(parts)).drop("_hot_parts")
    )
    return parted_left.drop("_hot_parts").join(parted_right, [*on, "_part"], how).drop("_part")


def wanted_keys(left: DataFrame, on: list[str]) -> DataFrame | None:
    """The distinct keys of ``left``, pinned, if they are few; None otherwise.

    Inputs that are known to be large are not looked at.
    """
    sizes = _leaf_bytes(left)
    if any(MEASURE_BYTES < size < UNKNOWN_BYTES for size in sizes):
        return None
    keys = left.select(*on).dropna()
    seen = keys.agg(
        F.approx_count_distinct(F.struct(*on)).alias("n"), F.max(_row_bytes(keys)).alias("widest")
    ).first()
    if seen["n"] > MAX_WANTED_KEYS or seen["n"] * (seen["widest"] or 0) > BROADCAST_BYTES:
        return None
    rows = keys.distinct().limit(2 * MAX_WANTED_KEYS).collect()
    if len(rows) == 2 * MAX_WANTED_KEYS:
        return None
    return left.sparkSession.createDataFrame(rows, keys.schema)


def within_span(right: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``right`` between the least and the largest of the wanted keys. The bounds reach
    the file reader, which skips what lies outside of them if the table is sorted by key."""
    ends = [f(c).alias(f"{i}{c}") for c in on for i, f in enumerate((F.min, F.max))]
    span = wanted.agg(*ends).first()
    for c in on:
        low, high = span[f"0{c}"], span[f"1{c}"]
        right = right.filter(F.lit(False) if low is None else F.col(c).between(low, high))
    return right


def only_wanted(right: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``right`` whose keys are wanted."""
    return within_span(right, wanted, on).join(F.broadcast(wanted), on, "left_semi")


def is_small(df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df, broadcast_bytes) is not None


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = HOT_ROWS,
    small: bool | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Equi join on a reference table with one row per key.

    A small reference table is broadcast. Of a large one only the wanted rows are shuffled, if the
    wanted keys are few — as those of a micro-batch are — and the heavy keys of ``left`` are spread.
    ``small`` tells what is known already about the size of ``right``. Finding out about the keys of
    ``left`` reads them, now, or ``counts``, a written table of their rows ``_n`` per key, missing ones
    too; with ``hot_rows=None``, and on streams outside of a ``foreachBatch``, the join is left to Spark.
    """
    if is_small(right, broadcast_bytes) if small is None else small:
        return left.join(F.broadcast(right), on, how)
    if hot_rows is None or left.isStreaming:
        return left.join(right, on, how)
    wanted = wanted_keys(left if counts is None else counts, on)
    if wanted is not None:
        right = only_wanted(right, wanted, on)
    hot = hot_rows if counts is None else hot_keys(left, on, hot_rows, counts)
    return spread_join(left, right, on, how, hot)


def fetch_by_id(
    ids: DataFrame,
    store: DataFrame,
    key: str = "name",
    filter_bits: int | None = None,
    **limits: int,
) -> DataFrame:
    """S3, L2: every id with its message. Misses are kept, with ``found`` false.

    ``store`` holds one row per id. With ``filter_bits``, for many ids against a store that is far
    larger than they are, a filter of that many bits is made of the ids first, and only messages that
    may be wanted take part in the join.
    """
    marked = store.withColumn("found", F.lit(True))
    if filter_bits is not None:
        words = written(key_filter(ids, [key], filter_bits), work_dir(ids.sparkSession, "filter"))
        marked = with_possible(marked, words, [key], "_possible", filter_bits).filter("_possible")
        marked = marked.drop("_possible")
    return lookup_join(ids, marked, [key], **limits).withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def entity_types(df: DataFrame) -> DataFrame:
    """The lookup table of L1 with one type per uri."""
    return df.groupBy("uri").agg(F.min("type").alias("entity_type"))


def with_entity_type(df: DataFrame, types: DataFrame, uri: str = "uri", **limits: int) -> DataFrame:
    """L1: the type behind ``uri``; unknown uris keep their row with a null type."""
    return lookup_join(df, types.withColumnRenamed("uri", uri), [uri], **limits)
