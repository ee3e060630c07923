"""K-Means rounds of several starts together, until no point changes its cluster.

A round is one job whatever the number of starts: each task returns the sums of the vectors nearest to
each mean, for all starts that still move.  A start ends when a round gives every point the cluster it
had, which is told by a digest of the clusters; unlike the last digits of the means, it does not depend
on the order of summation.  Means (starts x k x width numbers) are all that reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# Vectors of one block, and of a task where the cluster's cores have one each.
BLOCK_ROWS = 4096
TASK_ROWS = 8 * BLOCK_ROWS
# Bytes of sums that may reach the driver at once; beyond, executors add them up first.
SUMS_AT_ONCE = 64 << 20


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nearest(x: np.ndarray, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest mean (the smaller where equal) and the squared distance less that of the origin."""
    far = (means * means).sum(1) - 2.0 * (x @ means.T)
    best = far.argmin(1)
    return best, far[np.arange(len(x)), best]


def few_tasks(data: DataFrame) -> DataFrame:
    """Kept rows dealt to no more tasks than their number calls for: each round pays for every task."""
    wanted = max(data.sparkSession.sparkContext.defaultParallelism, -(-data.count() // TASK_ROWS))
    return data.coalesce(wanted) if data.rdd.getNumPartitions() > wanted else data


def blocks(points: DataFrame, vector: str, weight: str | None) -> RDD:
    """``(number, x, w)``: vectors and weights in blocks of bounded size, kept."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(low, BLOCK_ROWS)
                x, w = _matrix(part.column(0)), part.column(1).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, w)], names=["x", "w"])

    packed = points.select(F.col(vector).cast("array<double>").alias("x"), w.alias("w")).mapInArrow(run, "x binary, w binary")
    numbered = packed.select(F.monotonically_increasing_id().alias("number"), "x", "w")
    return numbered.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)


def _round(kept: RDD, means: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float, int]]:
    """Of each start: sums and weights by mean, training cost, digest of the clusters."""

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        total = {i: [np.zeros_like(m), np.zeros(len(m)), 0.0, 0] for i, m in means.items()}
        for number, x, w in rows:
            w = np.frombuffer(w)
            x = np.frombuffer(x).reshape(len(w), -1)
            norms, weighted = (x * x).sum(1), x * w[:, None]
            for i, m in means.items():
                best, far = _nearest(x, m)
                order = np.argsort(best, kind="stable")
                there, first = np.unique(best[order], return_index=True)
                total[i][0][there] += np.add.reduceat(weighted[order], first)
                total[i][1] += np.bincount(best, weights=w, minlength=len(m))
                total[i][2] += float(np.maximum(norms + far, 0.0) @ w)
                mark = hashlib.blake2b(best.astype(np.int32).tobytes(), digest_size=8, salt=number.to_bytes(8, "little"))
                total[i][3] += int.from_bytes(mark.digest(), "little")
        yield total

    def both(a: dict, b: dict) -> dict:
        return {i: [x + y for x, y in zip(a[i], b[i], strict=True)] for i in a}

    size = sum(m.nbytes for m in means.values()) * kept.getNumPartitions()
    return kept.mapPartitions(run).treeReduce(both, depth=1 if size <= SUMS_AT_ONCE else 2)


def settled(kept: RDD, starts: list[np.ndarray], rounds: int) -> tuple[np.ndarray, float, list[int]]:
    """The means of least training cost, that cost, and the rounds of each start; a mean without points stays."""
    means, marks, took = dict(enumerate(starts)), {}, [0] * len(starts)
    costs = dict.fromkeys(means, float("inf"))
    moving = list(means)
    for _ in range(rounds):
        if not moving:
            break
        for i, (sums, weight, cost, mark) in _round(kept, {i: means[i] for i in moving}).items():
            took[i] += 1
            costs[i] = cost
            if marks.get(i) == mark:
                moving.remove(i)
                continue
            marks[i] = mark
            means[i] = np.where(weight[:, None] > 0, sums / np.where(weight > 0, weight, 1.0)[:, None], means[i])
    best = min(costs, key=costs.get)
    return means[best], costs[best], took


def placed(points: DataFrame, vector: str, means: np.ndarray, output: str) -> DataFrame:
    """Points with the number of their nearest mean."""
    columns = points.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [np.zeros(0, np.int32)]
            for low in range(0, len(batch), BLOCK_ROWS):
                best.append(_nearest(_matrix(batch.column("_x").slice(low, BLOCK_ROWS)), means)[0].astype(np.int32))
            own = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(np.concatenate(best))], names=[*columns, output])

    schema = StructType([*points.schema.fields, StructField(output, IntegerType())])
    return points.withColumn("_x", F.col(vector).cast("array<double>")).mapInArrow(run, schema)
