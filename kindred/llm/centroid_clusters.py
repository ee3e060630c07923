"""Exact K-Means on integer vectors with PCA-rotated filtering.

Vectors become integers ``floor(scale * x)``.  They are rotated once onto the principal axes of
all of them; the index stores the leading rotated coordinates ``p`` of each vector and the norm ``r``
of the rest.  A rotation keeps distances, and the rests of two vectors differ by at least the
difference of their norms, so for a centroid with ``(q, s)``

    |x - c|^2  >=  |p - q|^2 + (r - s)^2.

In each assignment the centroid of the least bound is measured in integers first; of the others only
those whose bound (less the rounding error of doubles) does not exceed that distance are measured too.
So the assignment is exact, whatever the axes: they decide the cost.

Centroids (k x width numbers), their sums and the moments of the axes are all that reaches the driver.

Left out: vectors that are null, have another width, or a component that is null, NaN, infinite or
at least ``LARGEST`` in absolute value (its squared distances would not fit a long).  Vectors that
repeat an id are separate rows.  Null ids come last in the order of the first centroids.  Fewer vectors
than k: fewer centroids.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.sources.staging import cut, spread

WIDTH = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
LARGEST = float(1 << 19)
# Leading coordinates: the fewest that hold this share of the variance, and at most this share of the width.
VARIANCE = 0.8
MOST_LEADING = 0.5
# Vectors whose bounds are held at once.
ROWS_AT_ONCE = 1024


@dataclass
class Rotation:
    mean: np.ndarray
    axes: np.ndarray
    leading: int

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Leading coordinates and, as the last column, the norm of the rest."""
        q = (x - self.mean) @ self.axes
        return np.c_[q[:, : self.leading], np.linalg.norm(q[:, self.leading :], axis=1)]


def integer_vectors(embeddings: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)``: the vectors that are kept, as integers."""
    e = F.col("embedding").cast("array<double>")

    def usable(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(LARGEST))

    return embeddings.where((F.size(e) == width) & F.forall(e, usable)).select(
        "vec_id", F.transform(e, lambda v: F.floor(v * scale).cast("int")).alias("x")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(values: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(values).reshape(-1)))


def _sums(column: str, width: int) -> list[Column]:
    return [F.sum(F.col(column)[j]).alias(f"v{j}") for j in range(width)]


def rotation(vectors: DataFrame, width: int = WIDTH) -> Rotation | None:
    """Principal axes of all vectors; None without vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 2, width))  # products of the components, their sums, the count
        for batch in batches:
            x = _matrix(batch.column("x"), width).astype(float)
            total[:width] += x.T @ x
            total[width] += x.sum(0)
            total[width + 1] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 2, dtype=np.int32)), _lists(total)], names=["line", "v"])

    lines = vectors.select("x").mapInArrow(run, "line int, v array<double>").groupBy("line").agg(*_sums("v", width)).orderBy("line").collect()
    total = np.array([list(r)[1:] for r in lines], float)  # width + 2 rows
    if not len(total) or not total[-1, 0]:
        return None
    n, mean = total[-1, 0], total[-2] / total[-1, 0]
    variance, axes = np.linalg.eigh(total[:width] / n - np.outer(mean, mean))
    variance, axes = np.maximum(variance[::-1], 0), axes[:, ::-1]
    share = np.cumsum(variance) / max(variance.sum(), 1e-300)
    leading = min(int(np.searchsorted(share, VARIANCE)) + 1, max(1, int(width * MOST_LEADING)))
    return Rotation(mean, axes, leading)


def index(vectors: DataFrame, turned: Rotation, width: int = WIDTH) -> DataFrame:
    """``(vec_id, x, rotated)``, written."""
    shared = vectors.sparkSession.sparkContext.broadcast(turned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = shared.value.apply(_matrix(batch.column("x"), width).astype(float))
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(f)], names=["vec_id", "x", "rotated"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return cut(vectors.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, x array<int>, rotated array<double>"))


def nearest(x: np.ndarray, f: np.ndarray, centroids: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (the smaller number where equal), squared distance, and distances measured."""
    far = (f * f).sum(1)[:, None] + (g * g).sum(1)
    low = far - 2 * (f @ g.T) - (1e-9 * far + 1e-3)
    best = low.argmin(1)
    most = ((x - centroids[best]) ** 2).sum(1)
    row, number = np.nonzero(low <= most[:, None])
    d = ((x[row] - centroids[number]) ** 2).sum(1)
    order = np.lexsort((number, d, row))
    first = order[np.r_[True, row[order][1:] != row[order][:-1]]]
    return number[first].astype(np.int32), d[first], len(row)


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, g: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, int]]:
    for low in range(0, len(batch), ROWS_AT_ONCE):
        part = batch.slice(low, ROWS_AT_ONCE)
        x = _matrix(part.column("x"), centroids.shape[1]).astype(np.int64)
        yield part, x, *nearest(x, _matrix(part.column("rotated"), g.shape[1]), centroids, g)


def _moved(known: DataFrame, centroids: np.ndarray, turned: Rotation) -> np.ndarray:
    """Centroids replaced by the floored means of the vectors nearest to them."""
    k, width = centroids.shape
    shared = known.sparkSession.sparkContext.broadcast((centroids, turned.apply(centroids.astype(float))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            for _, x, number, _, _ in _assigned(batch, *shared.value):
                count += np.bincount(number, minlength=k)
                order = np.argsort(number, kind="stable")
                there = np.flatnonzero(np.bincount(number, minlength=k))
                total[there] += np.add.reduceat(x[order], np.searchsorted(number[order], there), axis=0)
        there = np.flatnonzero(count).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(count[there]), _lists(total[there])], names=["cluster", "n", "v"])

    sums = known.select("x", "rotated").mapInArrow(run, "cluster int, n long, v array<long>")
    out = centroids.copy()
    for r in sums.groupBy("cluster").agg(F.sum("n").alias("n"), *_sums("v", width)).collect():  # a row a centroid
        out[r[0]] = [s // r[1] for s in list(r)[2:]]
    return out


def assign(known: DataFrame, centroids: np.ndarray, turned: Rotation) -> DataFrame:
    """``(vec_id, cluster, distance, measured)``; ``measured``: distances taken in integers."""
    shared = known.sparkSession.sparkContext.broadcast((centroids, turned.apply(centroids.astype(float))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, number, distance, measured in _assigned(batch, *shared.value):
                each = np.zeros(len(part), np.int64)
                each[0] = measured
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(number), pa.array(distance), pa.array(each)],
                    names=["vec_id", "cluster", "distance", "measured"],
                )

    kind = known.schema["vec_id"].dataType.simpleString()
    return known.mapInArrow(run, f"vec_id {kind}, cluster int, distance long, measured long")


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = 2) -> np.ndarray:
    """The k vectors whose ``seed:vec_id`` has the least SHA-256."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select("x", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def clusters(
    embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, seed: int = 2, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` and the final centroids.

    Sums beyond a long are null.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    vectors = integer_vectors(spread(embeddings.select("vec_id", "embedding")), width, scale)
    turned = rotation(vectors, width)
    if turned is None:
        empty = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], empty), np.zeros((0, width), np.int64)
    known = index(vectors, turned, width)
    centroids = first_centroids(known, k, seed)
    for _ in range(rounds):
        centroids = _moved(known, centroids, turned)
    told = cut(assign(known, centroids, turned))
    inertia = told.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    total = told.agg(F.try_sum("distance").alias("inertia"))
    digests = spark.createDataFrame(
        [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())],
        "cluster int, centroid_sha256 string",
    )
    # A row a centroid on the right.
    out = told.join(F.broadcast(inertia.join(digests, "cluster").crossJoin(total)), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centroids
