"""Items related to one anchor or to many: item sets joined with the current cohort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.fixed import RANK_CLUSTERS
from kindred.functions.text import phrase_count, tokens
from kindred.operators.decks import greedy_set
from kindred.operators.labelsets import anchor_value, legal_items
from kindred.operators.order_stats import grouped_values_at
from kindred.operators.rank_clusters import assign_clusters
from kindred.sources.staging import build_side, cut


def item_words(items: DataFrame) -> DataFrame:
    return items.select("item_id", tokens("text").alias("tokens"))


def ranked_members(
    items: DataFrame, anchor_name: str, *, clusters: int = RANK_CLUSTERS, seeding="midpoint"
) -> DataFrame:
    """Legal items of the anchor, clustered on rank."""
    legal = legal_items(items, anchor_name)
    placed = assign_clusters(legal.select("item_id", "ord", "rank", "text"), clusters, seeding=seeding)
    return placed.select(
        anchor_value(items, anchor_name, F.col("item_id")).alias("anchor_id"),
        "item_id",
        "ord",
        "rank",
        "cluster_pos",
        "centroid",
        phrase_count(tokens("text")).alias("n_phrases"),
    )


def anchor_set(
    items: DataFrame, anchor_name: str, *, clusters: int = RANK_CLUSTERS, seeding="midpoint"
) -> DataFrame:
    """The anchor's item set. ``items(item_id, ord, name, text, labels, rank)``."""
    members = ranked_members(items, anchor_name, clusters=clusters, seeding=seeding)
    return greedy_set(members, item_words(items))


def _sets(items: DataFrame, labels: str) -> DataFrame:
    """Items with their label set, and a text that names it."""
    own = F.array_sort(F.array_distinct(F.coalesce(labels, F.array().cast("array<string>"))))
    return items.select("item_id", "ord", "rank", "text", own.alias("_labels")).withColumn("_set", F.to_json("_labels"))


def ranked_members_of(items: DataFrame, anchors: DataFrame, *, clusters: int = RANK_CLUSTERS, labels: str = "labels") -> DataFrame:
    """Legal items of every anchor of ``anchors(anchor_id)``, clustered on rank, in one run.

    What an anchor may use, and so seeds and centroids, depends on its label set alone: they
    are found once for each set that an anchor has.  Sets are compared by their labels, not items.
    Seeds are midpoints, as ``ranked_members`` has them.  Unknown anchors give no rows.
    """
    keyed = _sets(items, labels)
    asked = cut(anchors.select("anchor_id").distinct())  # counted: else Spark might broadcast the catalog
    chosen = cut(
        keyed.select(F.col("item_id").alias("anchor_id"), "_set", "_labels").join(build_side(asked, asked.count()), "anchor_id")
    )
    sets = cut(keyed.select("_set", "_labels").distinct())
    allowed = chosen.select(F.col("_set").alias("_allowed"), F.explode(F.array_union(F.transform("_labels", lambda x: F.concat(F.lit("="), x)), F.array(F.lit("")))).alias("label")).distinct()
    # The empty set is met by a label that every allowed set has, and no other set.
    own = F.when(F.size("_labels") == 0, F.array(F.lit(""))).otherwise(F.transform("_labels", lambda x: F.concat(F.lit("="), x)))
    needs = sets.select("_set", F.size(own).alias("n"), F.explode(own).alias("label"))
    legal = cut(needs.join(allowed, "label").groupBy("_allowed", "_set", "n").agg(F.count("*").alias("met")).where("met = n").select("_allowed", "_set"))
    pool = cut(
        keyed.join(build_side(legal, legal.count()), "_set").select(
            "_allowed", "item_id", "ord", "rank", phrase_count(tokens("text")).alias("n_phrases")
        )
    )

    def edges(n: Column) -> Column:
        buckets = F.least(F.lit(clusters).cast("long"), n)
        ends = F.transform(
            F.sequence(F.lit(0).cast("long"), buckets - 1),
            lambda i: F.array(F.floor(i * n / buckets), F.floor((i + 1) * n / buckets) - 1),
        )
        return F.flatten(ends)

    at = grouped_values_at(pool, ["_allowed"], "rank", edges)
    seeds = (
        at.groupBy("_allowed", F.floor(F.col("place") / 2).alias("i"))
        .agg(F.floor((F.min("value") + F.max("value")) / 2).cast("double").alias("s"))
        .groupBy("_allowed")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("seeds"))  # k a set
    )
    seeds = cut(seeds)
    n_sets = seeds.count()
    far = F.array_min(F.transform("seeds", lambda s, i: F.struct(F.abs(F.col("rank") - s).alias("far"), i.alias("i"))))
    nearest = pool.join(build_side(seeds, n_sets), "_allowed").withColumn("_seed", far["i"]).drop("seeds")
    centroids = nearest.groupBy("_allowed", "_seed").agg(F.avg("rank").alias("centroid"))
    place = Window.partitionBy("_allowed").orderBy("centroid", "_seed")
    numbered = centroids.withColumn("cluster_pos", F.row_number().over(place) - 1)
    placed = nearest.join(build_side(numbered, clusters * n_sets), ["_allowed", "_seed"]).drop("_seed")
    return (
        placed.join(build_side(chosen.select("anchor_id", F.col("_set").alias("_allowed")), chosen.count()), "_allowed")
        .select("anchor_id", "item_id", "ord", "rank", "cluster_pos", "centroid", "n_phrases")
    )


def anchor_sets(items: DataFrame, anchors: DataFrame, *, clusters: int = RANK_CLUSTERS) -> DataFrame:
    """The item sets of many anchors, ``anchors(anchor_id)``, in one run."""
    return greedy_set(ranked_members_of(items, anchors, clusters=clusters), item_words(items))


def related_items(deck: DataFrame, current: DataFrame) -> DataFrame:
    """Current-cohort items of each anchor's set with ``sim_score``, most similar first.

    Members of the upcoming cohort have no match here and drop out; so does the
    anchor, by its id.
    """
    members = deck.where(F.col("item_id") != F.col("anchor_id")).select(
        "anchor_id", "item_id", "rank", F.col("sim").alias("sim_score"), "deck_pos"
    )
    joined = current.drop("rank").join(build_side(members, deck.count()), "item_id")
    return joined.orderBy("anchor_id", F.col("sim_score").desc(), "rank", "deck_pos")
