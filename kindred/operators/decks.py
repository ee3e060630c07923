"""Item sets built around an anchor, without a loop.

The set grows by taking, from one cluster at a time, the unused item most
similar to the scorer; ties go to the earlier row.  A cluster is left as soon as
its last row has been taken, whatever else it still holds.  The scorer is the
anchor for the first 49 picks and the first pick for the rest.

Taking the best unused item again and again from one cluster is the same as
walking down its ranking, so each scorer needs only ranked lists: the top of
each cluster, cut after the cluster's last row, joined in cluster order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.fixed import FIRST_SCORER_PICKS, SET_SIZE
from kindred.operators.overlap import shared_phrases
from kindred.sources.staging import build_side, cut, small


def _ranked_walk(scored: DataFrame, wanted: int, has_exit: bool) -> DataFrame:
    """The first ``wanted`` picks per anchor with ``step`` = 1, 2, ...

    A pick never needs more than ``wanted`` rows of one cluster, so each task
    keeps that many before the shuffle.
    """
    best = [F.col("sim").desc(), F.col("ord")]
    in_cluster = Window.partitionBy("anchor_id", "cluster_pos").orderBy(*best)
    top = scored.withColumn("_rn", F.row_number().over(in_cluster)).where(F.col("_rn") <= wanted)
    if has_exit:
        cluster = Window.partitionBy("anchor_id", "cluster_pos")
        exit_rank = F.min(F.when(F.col("is_last"), F.col("_rn"))).over(cluster)
        top = top.withColumn("_exit", exit_rank).where(
            F.col("_exit").isNull() | (F.col("_rn") <= F.col("_exit"))
        )
    walk = Window.partitionBy("anchor_id").orderBy("cluster_pos", "_rn")
    return (
        top.withColumn("step", F.row_number().over(walk))
        .where(F.col("step") <= wanted)
        .select("anchor_id", "scorer_id", "item_id", "ord", "rank", "sim", "cluster_pos", "is_last", "step")
    )


def _score(members: DataFrame, scorers: DataFrame, items: DataFrame, usable: DataFrame, n_scorers: int, n_usable: int) -> DataFrame:
    """Add ``sim`` of each member to its scorer; no common word means 0.

    ``usable`` holds the words of the members, ``items`` those of the scorers too.  Every scorer may share
    words with every usable item, which Spark does not see in the size of the words: it would broadcast the pairs.
    """
    ids = scorers.select(F.col("scorer_id").alias("item_id")).distinct()
    chosen = items.join(small(ids, n_scorers), "item_id", "left_semi")
    anchors = cut(chosen.select(F.col("item_id").alias("anchor_id"), "tokens"))
    shared = shared_phrases(anchors, usable).withColumnRenamed("anchor_id", "scorer_id")
    return members.join(build_side(shared, n_scorers * n_usable), ["scorer_id", "item_id"], "left").withColumn(
        "sim", F.coalesce("shared", F.lit(0)) / F.col("n_phrases")
    )


def greedy_set(
    members: DataFrame,
    items: DataFrame,
    *,
    size: int = SET_SIZE,
    first_span: int = FIRST_SCORER_PICKS,
    leave_clusters: bool = True,
) -> DataFrame:
    """Item set of each anchor.

    ``members(anchor_id, item_id, ord, rank, cluster_pos, n_phrases)`` lists what
    each anchor may use; ``items(item_id, tokens)`` has the words of all of them
    and of the anchors.  Result: ``(anchor_id, deck_pos, scorer_id, item_id, sim,
    rank, ord)``; position 0 is the anchor itself, where it is a member.
    """
    members = cut(
        members.select("anchor_id", "item_id", "ord", "rank", "cluster_pos", "n_phrases")
    )
    last = members.groupBy("anchor_id", "cluster_pos").agg(F.max("ord").alias("ord"))
    n_last, n_anchors = last.agg(F.count("*"), F.count_distinct("anchor_id")).first()
    marked = members.join(
        build_side(last.withColumn("is_last", F.lit(True)), n_last), ["anchor_id", "cluster_pos", "ord"], "left"
    ).withColumn("is_last", F.coalesce("is_last", F.lit(False)))
    others = marked.where(F.col("item_id") != F.col("anchor_id"))

    # Only items that some set may use are split into words and compared.
    ids = cut(members.select("item_id").distinct())
    usable = cut(items.select("item_id", "tokens").join(build_side(ids, ids.count()), "item_id", "left_semi"))
    n_usable = usable.count()

    anchors = members.select(F.col("anchor_id").alias("scorer_id")).distinct()
    scored = _score(others.withColumn("scorer_id", F.col("anchor_id")), anchors, items, usable, n_anchors, n_usable)
    picks = first = cut(_ranked_walk(scored, min(first_span, size - 1), leave_clusters))

    if size - 1 > first_span and not first.where(F.col("step") == first_span).isEmpty():
        moved = F.when(F.col("is_last") & F.lit(leave_clusters), 1).otherwise(0)
        start_from = first.where(F.col("step") == first_span).select(
            "anchor_id", (F.col("cluster_pos") + moved).alias("_from")
        )
        scorer = first.where(F.col("step") == 1).select("anchor_id", F.col("item_id").alias("scorer_id"))
        turn = start_from.join(scorer, "anchor_id")  # at most one row per anchor
        taken = first.select("anchor_id", "item_id")
        left = (
            others.join(small(turn, n_anchors), "anchor_id")
            .where(F.col("cluster_pos") >= F.col("_from"))
            .join(small(taken, first_span * n_anchors), ["anchor_id", "item_id"], "left_anti")
        )
        second = _ranked_walk(
            _score(left, turn, usable, usable, n_anchors, n_usable), size - 1 - first_span, leave_clusters
        )
        picks = first.unionByName(second.withColumn("step", F.col("step") + first_span))

    start = members.where(F.col("item_id") == F.col("anchor_id")).select(
        "anchor_id",
        F.lit(0).alias("deck_pos"),
        F.col("anchor_id").alias("scorer_id"),
        "item_id",
        F.lit(1.0).alias("sim"),
        "rank",
        "ord",
    )
    chosen = picks.select(
        "anchor_id", F.col("step").alias("deck_pos"), "scorer_id", "item_id", "sim", "rank", "ord"
    )
    return cut(start.unionByName(chosen))
