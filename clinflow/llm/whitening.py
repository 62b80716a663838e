"""Whitening of embeddings: principal components of the distinct vectors, scaled to unit variance.

Embeddings are put on a grid, so that equal ones can be grouped exactly. The covariance is fitted on
the distinct vectors, each weighing one or as often as it occurs, centred first and multiplied per
task; the tasks' sums are added up by dimension. Each distinct vector is whitened once, and the rows
are joined with the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import scratch, whole_row

#: Steps of the grid per unit, and the number that is added to each step.
STEPS, SHIFT = 64, 1_000_000
#: Entries of this size and more have no place on the grid, like infinite ones.
LARGEST = 2.0**40
#: A vector that more rows than this have, or more than a thousandth of all, is dealt to several tasks.
HOT = 1000


def on_grid(vectors: DataFrame, column: str, keep: list[str] | None = None) -> DataFrame:
    """Rows with a whole vector as struct ``row`` and ``x``, its entries in steps of the grid."""
    entry = lambda c: F.floor(c.cast("double") * STEPS) + SHIFT
    sound = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)
    v = F.col(f"`{column}`")
    whole = F.coalesce(F.forall(v, lambda c: F.coalesce(sound(c), F.lit(False))), F.lit(False))
    return vectors.filter(whole).select(whole_row(vectors, keep), F.transform(v, entry).alias("x"))


def matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def weights(batch: pa.RecordBatch, weighted: bool) -> np.ndarray:
    return batch.column("copies").to_numpy() if weighted else np.ones(batch.num_rows, np.int64)


@dataclass(frozen=True)
class Centre:
    """The mean of the fit list: ``n`` and the exact sums give a whole number near it and the rest."""

    n: int
    sums: list[int]

    @property
    def near(self) -> list[int]:
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    def rest(self) -> list[int]:
        """Of each sum, what the whole numbers leave over."""
        return [s - self.n * r for s, r in zip(self.sums, self.near)]

    def from_near(self, x: np.ndarray) -> np.ndarray:
        return x - np.array(self.near, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Distances from the mean, exact to the last bits of a double."""
        return self.from_near(x) - np.array([r / self.n for r in self.rest()])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of (n x - sum)^2; null where it is no long any more."""
        y, rest = self.from_near(x), self.rest()
        most = [self.n * int(m) + abs(r) for m, r in zip(np.abs(y).max(0, initial=0), rest)]
        if sum(m * m for m in most) < 2**63:
            return ((self.n * y - np.array(rest, np.int64)) ** 2).sum(1).tolist()
        exact = (sum((self.n * a - r) ** 2 for a, r in zip(row, rest)) for row in y.tolist())
        return [v if v < 2**63 else None for v in exact]


def totals(fit: DataFrame, weighted: bool) -> Centre:
    """Number and sums of the fit list, exact; each task adds up its rows first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                x, w = matrix(batch, "x"), weights(batch, weighted)
                x = x.astype(object) if float(np.abs(x).max(initial=0)) * float(w.sum()) >= 2.0**62 else x
                each = (x * w[:, None]).sum(0)
                n += int(w.sum())
                sums = [int(a) + b for a, b in zip(each, sums or [0] * len(each))]
        if sums is not None:
            yield pa.RecordBatch.from_pydict(
                {
                    "dimension": pa.array([-1, *range(len(sums))], pa.int32()),
                    "total": pa.array([str(v) for v in (n, *sums)], pa.string()),
                }
            )

    parts = fit.mapInArrow(add, "dimension int, total string")
    found = parts.groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    by_dimension = {r.dimension: int(r.total) for r in found.collect()}
    return Centre(by_dimension.pop(-1), [v for _, v in sorted(by_dimension.items())])


def covariance(fit: DataFrame, column: str, centre: Centre | np.ndarray, n: int, weighted: bool) -> np.ndarray:
    """Covariance of a column of vectors about ``centre``, divisor ``n``: a product per task, whose
    rows are added up by dimension. As many numbers as the square of the dimensions come back."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch, column)
                y = centre.centred(x) if isinstance(centre, Centre) else x - centre
                part = (y * weights(batch, weighted)[:, None]).T @ y
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict(
                {"dimension": pa.array(range(len(total)), pa.int32()), "products": pa.array(total.tolist())}
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for i, products in zip(batch.column("dimension").to_pylist(), matrix(batch, "products")):
                    sums[i] = sums.get(i, 0) + products
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"dimension": pa.array(sums, pa.int32()), "products": pa.array([s.tolist() for s in sums.values()])}
            )

    schema = "dimension int, products array<double>"
    parts = fit.mapInArrow(multiply, schema)
    found = parts.repartition("dimension").mapInArrow(add, schema).collect()
    return np.array([r.products for r in sorted(found, key=lambda r: r.dimension)]) / n


def means(fit: DataFrame, column: str, n: int, weighted: bool) -> np.ndarray:
    """Mean of a column of vectors of doubles."""
    weight = F.col("copies") if weighted else F.lit(1)
    each = fit.select(F.posexplode(column).alias("i", "v"), weight.alias("w"))
    found = each.groupBy("i").agg(F.sum(F.col("v") * F.col("w")).alias("total")).collect()
    return np.array([r.total for r in sorted(found, key=lambda r: r.i)]) / n


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors (columns) by falling eigenvalue, and each one's part of the whole variance."""

    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @property
    def flat(self) -> np.ndarray:
        """Components without variance beyond rounding."""
        tiny = 8 * len(self.vectors) * np.finfo(float).eps * max(float(self.values.max(initial=0)), 0.0)
        return self.values <= tiny


def principal(v: np.ndarray, most: int) -> Components:
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    vectors, top = vectors[:, order], np.maximum(values[order], 0.0)
    largest = vectors[np.abs(vectors).argmax(0), np.arange(len(order))]
    trace = float(np.trace(v))
    return Components(vectors * np.where(largest < 0, -1.0, 1.0), top, top / trace if trace > 0 else top * 0)


def whitened_distinct(fit: DataFrame, centre: Centre, found: Components) -> DataFrame:
    """Each distinct vector once: its two hashes, ``copies``, ``deviation`` and ``whitened``."""
    scale = np.where(found.flat, 0.0, 1 / np.sqrt(np.where(found.flat, 1.0, found.values)))

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch, "x")
                z = centre.centred(x) @ found.vectors * scale
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in ("h1", "h2", "copies")),
                        pa.array(centre.deviations(x), pa.int64()),
                        pa.array(z.tolist(), pa.list_(pa.float64())),
                    ],
                    names=["h1", "h2", "copies", "deviation", "whitened"],
                )

    return fit.mapInArrow(whiten, "h1 long, h2 long, copies long, deviation long, whitened array<double>")


def hashed(df: DataFrame) -> DataFrame:
    """With 128 bits that stand for ``x``."""
    return df.withColumns({f"h{i}": F.xxhash64(F.lit(i), "x") for i in (1, 2)})


COLUMNS = "n long, deviation long, whitened array<double>, explained array<double>, identity_error double"


def whiten(
    vectors: DataFrame, column: str = "embedding", components: int = 16, weighted: bool = False, keep: list[str] | None = None
) -> DataFrame:
    """Each row with a whole vector, as struct ``row``, with ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``; arrays have an entry per component.

    A whole vector is not null and has only finite entries, none null or of 2^40 and more; rows
    without one go. So do rows whose vector has another number of entries than most rows' vectors
    (of as frequent numbers, the largest counts). An entry c becomes x = floor(64 c) + 1000000.

    ``weighted`` lets each distinct x vector count as often as it occurs, else once; ``n`` is the sum
    of the weights. ``deviation`` is the sum over dimensions of (n x - sum)^2, exact, null beyond
    the range of a long. Components without variance, as all are where n = 1, have ``whitened`` null
    and are no part of ``identity_error``, the largest entry of the covariance of ``whitened`` less
    the identity. Repeated rows and ids are rows like others; empty vectors and tables give no rows.
    Only ``column`` and ``keep`` are read.
    """
    rows = on_grid(vectors, column, keep)
    grouped = rows.groupBy("x").agg(F.count("*").alias("copies"))
    distinct = scratch(hashed(grouped), "distinct")
    sizes = distinct.groupBy(F.size("x").alias("size")).agg(F.sum("copies").alias("rows"))
    first = sizes.filter("size > 0").orderBy(F.desc("rows"), F.desc("size")).first()
    if first is None:
        none = rows.limit(0).select("row", *[F.lit(None).cast(t).alias(c) for c, t in (p.split() for p in COLUMNS.split(", "))])
        return none
    fit = distinct.filter(F.size("x") == first["size"])
    centre = totals(fit, weighted)
    found = principal(covariance(fit, "x", centre, centre.n, weighted), components)
    done = scratch(whitened_distinct(fit, centre, found), "whitened")
    about = means(done, "whitened", centre.n, weighted)
    off = np.abs(covariance(done, "whitened", about, centre.n, weighted) - np.eye(len(found.values)))
    error = float(off[~found.flat][:, ~found.flat].max(initial=0.0))
    return joined(hashed(rows).drop("x"), done, first["rows"]).select(
        "row",
        F.lit(centre.n).cast("long").alias("n"),
        "deviation",
        F.array(
            *[F.lit(None).cast("double") if flat else F.get("whitened", F.lit(i)) for i, flat in enumerate(found.flat)]
        ).alias("whitened"),
        F.array(*[F.lit(float(v)) for v in found.explained]).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def joined(rows: DataFrame, done: DataFrame, n: int) -> DataFrame:
    """Rows with what their vector became. The hot vectors, a thousand at most, are copied to several
    tasks, and their rows dealt to these."""
    limit = max(HOT, n // 1000)
    parts = F.ceil(F.col("copies") / limit)
    hot = done.filter(F.col("copies") > limit).select("h1", "h2", parts.cast("int").alias("parts"))
    spread = (
        rows.join(F.broadcast(hot), ["h1", "h2"], "left")
        .withColumn("part", F.floor(F.rand(0) * F.coalesce("parts", F.lit(1))).cast("int"))
        .drop("parts")
    )
    copied = done.withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)).cast("int") - 1)))
    return spread.join(copied.drop("copies"), ["h1", "h2", "part"])
