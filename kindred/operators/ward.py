"""Bottom-up merging by least increase of variance (Ward)."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.fixed import FEATURE_CLUSTERS
from kindred.operators.components import components
from kindred.operators.features import kmeans
from kindred.operators.pairwise import between_blocks, by_blocks
from kindred.sources.staging import cut

# K-Means groups that the grouped form merges.
GROUPS = 2_000


def _nearest_in_block(a: pd.DataFrame, b: pd.DataFrame, between: np.ndarray) -> pd.DataFrame:
    """Cheapest partner in block b of each group in block a; ties to the least id."""
    order = np.argsort(b["pid"].to_numpy())
    b, between = b.iloc[order], between[:, order]
    na, nb = a["weight"].to_numpy()[:, None], b["weight"].to_numpy()[None, :]
    # Rounded so that both directions of a pair agree.
    cost = np.round(between * np.sqrt(2.0 * na * nb / (na + nb)), 10)
    cost[a["pid"].to_numpy()[:, None] == b["pid"].to_numpy()[None, :]] = np.inf
    at = cost.argmin(1)
    return pd.DataFrame(
        {"pid": a["pid"].to_numpy(), "other": b["pid"].to_numpy()[at], "cost": cost[np.arange(len(a)), at]}
    )


def merges(points: DataFrame, n: int, stop_at: int = 1) -> DataFrame | None:
    """``(a, b, height, step)`` of the merges down to ``stop_at`` groups or fewer.

    Two groups that are each other's nearest neighbour merge in any order with
    the same result, so each round merges all such pairs at once.  Heights never
    decrease up the tree, so the rounds end once every merge not yet made is
    known to lie above the ones needed.  ``n`` is the number of points; a single
    point has no merges.

    A merged group is never nearer to a third one than the nearer of its parts was, so a group keeps its
    nearest neighbour until that one merges.  Rounds after the first compare only merged groups, and
    those whose neighbour merged, with the others.
    """
    groups = cut(points.select("pid", "vector", F.col("weight").cast("double").alias("weight")))
    left = groups.count()
    rounds: list[DataFrame] = []
    kept = asking = None
    while left > 1:
        if kept is None:
            found = by_blocks(groups, left, _nearest_in_block, "pid long, other long, cost double")
        else:
            found = between_blocks(asking, asking.count(), groups, left, _nearest_in_block, "pid long, other long, cost double")
        best = (
            found.where(F.col("cost") != float("inf"))
            .groupBy("pid")
            .agg(F.min(F.struct("cost", "other")).alias("_m"))
            .select("pid", F.col("_m.other").alias("other"), F.col("_m.cost").alias("height"))
        )
        best = cut(best if kept is None else best.unionByName(kept))
        if left <= stop_at:
            floor = best.agg(F.min("height")).first()[0]
            needed = _union(rounds).orderBy("height").limit(n - stop_at).agg(F.max("height")).first()[0]
            if needed is None or needed <= floor:
                break
        named = best.select(
            F.least("pid", "other").alias("a"), F.greatest("pid", "other").alias("b"), "height"
        )
        # A pair named from both sides is mutual.
        pairs = cut(
            named.groupBy("a", "b")
            .agg(F.count("*").alias("sides"), F.max("height").alias("height"))
            .where(F.col("sides") == 2)
            .select("a", "b", "height", F.lit(len(rounds)).alias("step"))
        )
        made = pairs.count()
        if not made:  # rounding hid the mutual pair: merge the cheapest one
            pairs = cut(named.orderBy("height", "a", "b").limit(1).withColumn("step", F.lit(len(rounds))))
            made = 1
        rounds.append(pairs)
        left -= made

        second = groups.select(F.col("pid").alias("b"), F.col("vector").alias("vb"), F.col("weight").alias("wb"))
        total = F.col("weight") + F.col("wb")
        mean = F.when(F.col("b").isNull(), F.col("vector")).otherwise(
            F.zip_with("vector", "vb", lambda x, y: (x * F.col("weight") + y * F.col("wb")) / total)
        )
        kept = groups.join(pairs.select(F.col("b").alias("pid")), "pid", "left_anti")
        merged = kept.join(pairs.select(F.col("a").alias("pid"), "b"), "pid", "left").join(second, "b", "left")
        groups = cut(merged.select("pid", mean.alias("vector"), F.coalesce(total, "weight").alias("weight")))
        gone = pairs.select(F.explode(F.array("a", "b")).alias("pid"))
        kept = cut(best.join(gone, "pid", "left_anti").join(gone.withColumnRenamed("pid", "other"), "other", "left_anti").select(*best.columns))
        asking = cut(groups.join(kept, "pid", "left_anti"))
    return _union(rounds) if rounds else None


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def ward(points: DataFrame, k: int = FEATURE_CLUSTERS) -> DataFrame:
    """``(pid, cluster)``: k clusters, named by their first point.

    ``points(pid, vector, weight)`` holds distinct points; all of them are merged, at any number.
    """
    points = cut(points.select("pid", "vector", "weight"))
    n = points.count()
    tree = merges(points, n, k)
    if tree is None or n <= k:
        return points.select("pid", F.col("pid").alias("cluster"))
    lowest = cut(tree.orderBy("height", "step", "a").limit(n - k))
    return components(points, lowest).withColumnRenamed("component", "cluster")


def ward_grouped(points: DataFrame, k: int = FEATURE_CLUSTERS, *, groups: int = GROUPS) -> DataFrame:
    """As ``ward``, but merges ``groups`` K-Means groups of the points: every point gets a
    cluster, the tree is approximate.  For more points than exact merging can compare."""
    points = cut(points.select("pid", "vector", "weight"))
    grouped = cut(kmeans(points, groups, starts=1, weight="weight", output="_g"))
    weighted = F.explode(F.transform("vector", lambda x, i: F.struct(i.alias("i"), (x * F.col("weight")).alias("x"))))
    sums = grouped.select("_g", weighted.alias("c")).groupBy("_g", "c.i").agg(F.sum("c.x").alias("x"))
    vectors = sums.groupBy("_g").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("xs"))  # one per column
    sizes = grouped.groupBy("_g").agg(F.sum("weight").alias("weight"), F.min("pid").alias("pid"))
    centres = cut(
        sizes.join(vectors, "_g").select("_g", "pid", "weight", F.transform("xs", lambda s: s["x"] / F.col("weight")).alias("vector"))
    )
    placed = ward(centres, k).join(centres.select("pid", "_g"), "pid")
    return grouped.select("pid", "_g").join(placed.select("_g", "cluster"), "_g").select("pid", "cluster")
