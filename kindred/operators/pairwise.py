"""Distances between all points, block against block.

Exact silhouettes and exact Ward merging compare every distinct point with every
other.  Points are dealt into blocks of bounded size and each pair of blocks is
one group, so no group grows with the data; each group returns sums or minima,
never pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1024


def distances(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
    """Euclidean distances between the vectors of two blocks."""
    x, y = np.stack(a["vector"].to_numpy()), np.stack(b["vector"].to_numpy())
    squared = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    same = a["pid"].to_numpy()[:, None] == b["pid"].to_numpy()[None, :]
    return np.sqrt(np.where(same, 0.0, np.maximum(squared, 0.0)))


def by_blocks(
    points: DataFrame,
    n: int,
    reduce_pair: Callable[[pd.DataFrame, pd.DataFrame, np.ndarray], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Apply ``reduce_pair(a, b, distances)`` to each ordered pair of blocks of the points.

    Two blocks meet in one group, which serves both directions with the same distances.
    """
    blocks = max(1, -(-n // BLOCK_ROWS))
    dealt = points.withColumn("_own", F.pmod(F.xxhash64("pid"), F.lit(blocks)))

    def numbers(low, high):
        return F.explode(F.sequence(low.cast("bigint"), high.cast("bigint")))

    left = dealt.withColumnRenamed("_own", "_i").withColumn("_j", numbers(F.col("_i"), F.lit(blocks - 1)))
    right = dealt.withColumnRenamed("_own", "_j").withColumn("_i", numbers(F.lit(0), F.col("_j")))
    right = right.select(*[F.col(c).alias(c) for c in left.columns])  # columns of its own

    def apply(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
        between = distances(a, b)
        forth = reduce_pair(a, b, between)
        return forth if key[0] == key[1] else pd.concat([forth, reduce_pair(b, a, between.T)])

    return left.groupBy("_i", "_j").cogroup(right.groupBy("_i", "_j")).applyInPandas(apply, schema)


def between_blocks(
    left: DataFrame,
    n_left: int,
    right: DataFrame,
    n_right: int,
    reduce_pair: Callable[[pd.DataFrame, pd.DataFrame, np.ndarray], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Apply ``reduce_pair(a, b, distances)`` to each block of the left points with each block of the right ones."""
    rows, columns = max(1, -(-n_left // BLOCK_ROWS)), max(1, -(-n_right // BLOCK_ROWS))

    def dealt(points: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(others - 1).cast("bigint")))
        return points.withColumn(own, F.pmod(F.xxhash64("pid"), F.lit(blocks))).withColumn(other, numbers)

    a = dealt(left, "_i", rows, "_j", columns)
    b = dealt(right, "_j", columns, "_i", rows).select(*[F.col(c).alias(c) for c in a.columns])  # columns of its own

    def apply(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
        return reduce_pair(a, b, distances(a, b))

    return a.groupBy("_i", "_j").cogroup(b.groupBy("_i", "_j")).applyInPandas(apply, schema)
