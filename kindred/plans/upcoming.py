"""Recommendations from the upcoming cohort, with a predicted rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.fixed import UPCOMING_LIMIT
from kindred.functions.text import phrase_count, tokens
from kindred.operators.decks import greedy_set
from kindred.operators.labelsets import anchor_value, legal_items
from kindred.operators.regression import fit, predict
from kindred.plans.related import item_words
from kindred.sources.staging import small


def upcoming_set(
    items: DataFrame, upcoming: DataFrame, anchor_name: str, *, legal_only: bool = False
) -> DataFrame:
    """Greedy set over the whole upcoming cohort: one cluster that is never left."""
    pool = upcoming
    if legal_only:
        legal = legal_items(items, anchor_name).select("item_id")
        pool = upcoming.join(legal, "item_id", "left_semi")
    members = pool.select(
        anchor_value(items, anchor_name, F.col("item_id")).alias("anchor_id"),
        "item_id",
        "ord",
        "rank",
        F.lit(0).alias("cluster_pos"),
        phrase_count(tokens("text")).alias("n_phrases"),
    ).where(F.col("anchor_id").isNotNull())
    return greedy_set(members, item_words(items), leave_clusters=False)


def upcoming_recommendations(
    items: DataFrame,
    upcoming: DataFrame,
    related: DataFrame,
    anchor_name: str,
    *,
    limit: int = UPCOMING_LIMIT,
    legal_only: bool = False,
) -> DataFrame:
    """The most similar upcoming items; the model is fitted on the related items.

    ``related`` has ``sim_score`` and ``rank``.
    """
    deck = upcoming_set(items, upcoming, anchor_name, legal_only=legal_only)
    top = (
        deck.where(F.col("item_id") != F.col("anchor_id"))
        .orderBy(F.col("sim").desc(), "deck_pos")
        .limit(limit)
        .select("item_id", F.col("sim").alias("sim_score"), "deck_pos")
    )
    model = fit(related, "sim_score", "rank")
    joined = upcoming.join(small(top, limit), "item_id")
    named = joined.select(
        F.col("item_id").alias("card_index"),
        "name",
        "manaCost",
        "types",
        "text",
        "sim_score",
        F.col("rank").alias("edhrecRank"),
        "deck_pos",
    )
    return (
        predict(named, model, "sim_score", "edhrecRank_prediction")
        .orderBy(F.col("sim_score").desc(), "deck_pos")
        .drop("deck_pos")
    )


def names(result: DataFrame) -> DataFrame:
    return result.select("name")
