"""Feature clustering of a catalog: three algorithms, their scores and sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.fixed import DBSCAN_EPS, DBSCAN_MIN_SAMPLES, FEATURE_CLUSTERS
from kindred.operators.dbscan import dbscan
from kindred.operators.features import kmeans, standardised_label_points
from kindred.operators.profile import value_counts
from kindred.operators.silhouette import silhouette
from kindred.operators.ward import ward
from kindred.sources.staging import cut

ALGORITHMS = ("kmeans_cluster", "dbscan_cluster", "agglomerative_cluster")


def cluster_points(
    points: DataFrame,
    *,
    k: int = FEATURE_CLUSTERS,
    eps: float = DBSCAN_EPS,
    min_samples: int = DBSCAN_MIN_SAMPLES,
) -> DataFrame:
    """Distinct points with the label each algorithm gives them."""
    points = cut(points)
    by_means = kmeans(points, k, weight="weight", output="kmeans_cluster")
    dense = dbscan(points, eps=eps, min_samples=min_samples).withColumnRenamed("cluster", "dbscan_cluster")
    merged = ward(points, k).withColumnRenamed("cluster", "agglomerative_cluster")
    return cut(by_means.join(dense, "pid").join(merged, "pid"))


def cluster_items(items: DataFrame, features: str = "features", **options) -> DataFrame:
    """Items with their three cluster labels; points are joined back by features."""
    clustered = cluster_points(standardised_label_points(items, features), **options)
    return items.join(clustered.select(features, *ALGORITHMS), features)


def cluster_scores(clustered: DataFrame) -> DataFrame:
    """``(algorithm, silhouette)`` of the three labellings."""
    scores = None
    for name in ALGORITHMS:
        one = silhouette(clustered.withColumn("cluster", F.col(name))).withColumn("algorithm", F.lit(name))
        scores = one if scores is None else scores.unionByName(one)
    return scores.select("algorithm", "silhouette")


def cluster_sizes(items: DataFrame, column: str = "kmeans_cluster") -> DataFrame:
    return value_counts(items, column)
