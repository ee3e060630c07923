"""One-step clustering of items on their rank, and its quality measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.fixed import RANK_CLUSTERS
from kindred.functions.noise import uniform_int
from kindred.operators.order_stats import numeric_values_at


def bucket_edges(items: DataFrame, k: int, column: str = "rank") -> list[tuple[float, float]]:
    """Lowest and highest rank of k buckets of equal count; of fewer if items are fewer."""

    def ends(n: int) -> list[int]:
        buckets = min(k, n)
        return [p for i in range(buckets) for p in (i * n // buckets, (i + 1) * n // buckets - 1)]

    values = numeric_values_at(items, column, ends)
    return list(zip(values[0::2], values[1::2], strict=True))


def pick_seeds(
    items: DataFrame,
    k: int,
    column: str = "rank",
    *,
    seeding: str | Sequence[float] = "midpoint",
    seed: int = 0,
) -> list[float]:
    """k starting points, one per bucket: midpoints, seeded random, or given."""
    if not isinstance(seeding, str):
        return [float(s) for s in seeding]
    edges = bucket_edges(items, k, column)
    if seeding == "midpoint":
        return [float((low + high) // 2) for low, high in edges]
    if seeding != "random":
        raise ValueError(f"unknown seeding {seeding!r}")
    spark = items.sparkSession
    drawn = spark.createDataFrame(
        [(i, low, high) for i, (low, high) in enumerate(edges)], "i long, low double, high double"
    ).select("i", uniform_int(F.col("low"), F.col("high"), seed, F.col("i")).alias("s"))
    return [float(r.s) for r in drawn.orderBy("i").collect()]


def assign_clusters(
    items: DataFrame,
    k: int = RANK_CLUSTERS,
    column: str = "rank",
    *,
    seeding: str | Sequence[float] = "midpoint",
    seed: int = 0,
) -> DataFrame:
    """Add ``cluster_pos`` (0 has the best mean rank) and ``centroid``.

    Each item goes to its nearest seed, the earlier one on ties; the centroid is
    the mean of the items assigned.  There is one assignment step only.
    """
    seeds = pick_seeds(items, k, column, seeding=seeding, seed=seed)
    if not seeds:
        nothing = {"centroid": F.lit(None).cast("double"), "cluster_pos": F.lit(0)}
        return items.withColumns(nothing).where(F.lit(False))
    rank = F.col(column)
    options = [F.struct(F.abs(rank - s).alias("far"), F.lit(i).alias("i")) for i, s in enumerate(seeds)]
    nearest = items.withColumn("_seed", F.array_min(F.array(*options))["i"])
    centroids = nearest.groupBy("_seed").agg(F.avg(column).alias("centroid"))
    numbered = centroids.select(  # k rows at most
        "_seed",
        "centroid",
        (F.row_number().over(Window.orderBy("centroid", "_seed")) - 1).alias("cluster_pos"),
    )
    return nearest.join(F.broadcast(numbered), "_seed").drop("_seed")


def cluster_sse(clustered: DataFrame, column: str = "rank") -> DataFrame:
    """Size, squared error of each cluster and its deviation from the mean error."""
    error = F.pow(F.col(column).cast("long") - F.col("centroid"), 2)
    per = clustered.groupBy("cluster_pos").agg(
        F.first("centroid").alias("centroid"), F.count("*").alias("n"), F.sum(error).alias("sse")
    )
    return per.withColumn("sse_minus_mean", F.col("sse") - F.avg("sse").over(Window.partitionBy()))


def cluster_boundaries(clustered: DataFrame, column: str = "rank", order: str = "ord") -> DataFrame:
    """Distance of each cluster's last row to its own centroid and to the next."""
    last = clustered.groupBy("cluster_pos").agg(
        F.first("centroid").alias("centroid"),
        F.max_by(F.col(column).cast("long"), order).alias("last_rank"),
    )
    following = F.lead("centroid").over(Window.orderBy("cluster_pos"))  # k rows
    return (
        last.withColumn("next_centroid", following)
        .where(F.col("next_centroid").isNotNull())
        .select(
            "cluster_pos",
            F.abs(F.col("last_rank") - F.col("centroid")).alias("dist_own"),
            F.abs(F.col("last_rank") - F.col("next_centroid")).alias("dist_next"),
        )
    )
