"""Standardised features and their distinct points."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.fixed import FEATURE_CLUSTERS, KMEANS_STARTS
from kindred.operators import lloyd


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean 0 and population deviation 1; a column that does not vary becomes 0."""
    moments = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns]
    scaled = df.withColumn("_m", df.select(F.struct(*moments)).scalar())
    value = {
        c: F.when(F.col(f"_m.{c}.std") == 0, F.lit(0.0)).otherwise(
            (F.col(c) - F.col(f"_m.{c}.mean")) / F.col(f"_m.{c}.std")
        )
        for c in columns
    }
    return scaled.withColumns(value).drop("_m")


def standardised_label_points(items: DataFrame, features: str = "features", order: str = "ord") -> DataFrame:
    """Distinct rows of the standardised multi-hot matrix.

    ``(features, pid, weight, vector)``: ``pid`` is the first row's order key and
    ``weight`` the number of rows.  Rows are grouped before vectors are made, so
    copies cost one vector.  The label list, one entry per matrix column, is a
    scalar.
    """
    groups = items.groupBy(features).agg(F.min(order).alias("pid"), F.count("*").alias("weight"))
    n = groups.select(F.sum("weight")).scalar()
    per_label = (
        groups.select(F.explode(features).alias("label"), "weight")
        .groupBy("label")
        .agg(F.sum("weight").alias("n"))
        .select("label", (F.col("n") / n).alias("mean"))
    )
    columns = per_label.select(F.array_sort(F.collect_list(F.struct("label", "mean")))).scalar()

    def cell(column):
        mean = column["mean"]
        std = F.sqrt(mean * (1 - mean))
        hot = F.array_contains(F.col(features), column["label"]).cast("double")
        return F.when(std == 0, F.lit(0.0)).otherwise((hot - mean) / std)

    return groups.withColumn("_columns", columns).withColumn("vector", F.transform("_columns", cell)).drop("_columns")


def distinct_points(df: DataFrame, vector: str = "vector", order: str = "ord") -> DataFrame:
    """``(vector, pid, weight)``: one row per distinct vector."""
    return df.groupBy(F.col(vector).alias("vector")).agg(
        F.min(order).alias("pid"), F.count("*").alias("weight")
    )


def kmeans(
    points: DataFrame,
    k: int = FEATURE_CLUSTERS,
    *,
    vector: str = "vector",
    seed: int = 42,
    starts: int = KMEANS_STARTS,
    weight: str | None = None,
    output: str = "cluster",
    rounds: int = 20,
    tolerance: float = 1e-4,
) -> DataFrame:
    """K-Means, the best of several starts by training cost.

    A start ends after ``rounds`` or when no mean moves more than ``tolerance``.  With tolerance 0 Spark
    gives the first means only, and all starts share their rounds (see ``lloyd``): one job a round.
    """
    data = points.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>"))).persist()
    together = tolerance == 0 and rounds > 0

    def fitted(data: DataFrame, start: int) -> KMeansModel:
        estimator = KMeans(k=k, seed=seed + start, featuresCol="_v", predictionCol=output, maxIter=0 if together else rounds, tol=tolerance)
        return (estimator.setWeightCol(weight) if weight else estimator).fit(data)

    try:
        if together:
            few = lloyd.few_tasks(data)
            first = [np.array(fitted(few, start).clusterCenters()) for start in range(starts)]
            kept = lloyd.blocks(few, vector, weight)
            means, _, _ = lloyd.settled(kept, first, rounds)
            kept.unpersist()
            return lloyd.placed(points, vector, means, output)
        best = min((fitted(data, start) for start in range(starts)), key=lambda m: m.summary.trainingCost)
    finally:
        data.unpersist()
    return best.transform(data).drop("_v")


def misplaced(placed: DataFrame, *, vector: str = "vector", cluster: str = "cluster", slack: float = 1e-6) -> DataFrame:
    """``(points, clusters, misplaced)``: points nearer to the mean of a cluster not their own.

    ``placed`` has ``weight``.  The means are few and meet the points as one scalar.
    """
    share = F.col("_x") * F.col("weight")
    means = (
        placed.select(cluster, "weight", F.posexplode(vector).alias("_i", "_x"))
        .groupBy(cluster, "_i")
        .agg((F.sum(share) / F.sum("weight")).alias("_x"))
        .groupBy(cluster)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda c: c["_x"]).alias("mean"))
    )
    listed = means.select(F.collect_list(F.struct(F.col(cluster).alias("cluster"), "mean"))).scalar()

    def apart(mean):
        return F.sqrt(F.aggregate(F.zip_with(vector, mean, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, v: t + v))

    far = placed.withColumn("_means", listed).withColumn(
        "_far", F.transform("_means", lambda m: F.struct(m["cluster"].alias("cluster"), apart(m["mean"]).alias("d")))
    )
    own = F.array_max(F.transform(F.filter("_far", lambda f: f["cluster"] == F.col(cluster)), lambda f: f["d"]))
    least = F.array_min(F.transform("_far", lambda f: f["d"]))
    return far.agg(
        F.count("*").alias("points"),
        F.count_distinct(cluster).alias("clusters"),
        F.count_if(least < own - slack).alias("misplaced"),
    )
