"""Pair and triple rules over finished item sets.

A set has at most 63 rows per anchor, so everything here is bounded by the
number of sets, not by the catalog.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.text import phrase_count
from kindred.operators.overlap import similarity
from kindred.sources.staging import cut, small


def pair_rules(deck: DataFrame) -> DataFrame:
    """Pair rules of each set, best rank first."""
    return deck.orderBy("anchor_id", "rank", "deck_pos")


def _words_of(deck: DataFrame, items: DataFrame, *columns: str) -> DataFrame:
    """Words of the items named in these columns of the sets, fetched in one scan."""
    ids = deck.select(F.explode(F.array(*columns)).alias("item_id")).distinct()
    return cut(
        items.select("item_id", "tokens").join(small(ids, len(columns) * deck.count()), "item_id", "left_semi")
    )


def _set_similarities(deck: DataFrame, items: DataFrame, from_column: str) -> DataFrame:
    """``(anchor_id, a, b, sim)``: similarity of set members b to members a."""
    a = deck.select("anchor_id", F.col(from_column).alias("a")).distinct()
    b = deck.select("anchor_id", F.col("item_id").alias("b"))
    words = _words_of(deck, items, "item_id", "scorer_id")
    first = words.join(a.select(F.col("a").alias("item_id")).distinct(), "item_id", "left_semi")
    sims = similarity(first.withColumnRenamed("item_id", "anchor_id"), words).select(
        F.col("anchor_id").alias("a"), F.col("item_id").alias("b"), "sim"
    )
    return (
        a.join(b, "anchor_id")  # pairs inside one set of bounded size
        .join(sims, ["a", "b"], "left")
        .select("anchor_id", "a", "b", F.coalesce("sim", F.lit(0.0)).alias("sim"))
    )


def _rules_per_card(deck: DataFrame, sims: DataFrame, scored_by: str) -> DataFrame:
    """Every rule of a set against every card of the set, with the similarity."""
    rules = deck.select(
        "anchor_id",
        F.col("scorer_id").alias("r_anchor"),
        F.col("item_id").alias("r_item"),
        F.col("sim").alias("r_sim"),
        F.col("rank").alias("r_rank"),
        F.col("deck_pos").alias("r_pos"),
    )
    by = sims.select("anchor_id", F.col("a").alias(scored_by), F.col("b").alias("card_id"), "sim")
    return rules.join(by, ["anchor_id", scored_by])


def _term(best: Column, last: Column, term: str) -> Column:
    if term not in ("best", "last"):
        raise ValueError(f"unknown term {term!r}")
    return best if term == "best" else last


def _in_order(found: DataFrame, by: Column) -> DataFrame:
    """Sort the rules of each set and number them from 0."""
    place = Window.partitionBy("anchor_id").orderBy(by, "deck_pos")
    return (
        found.withColumn("rule_pos", F.row_number().over(place) - 1)
        .drop("deck_pos")
        .orderBy("anchor_id", "rule_pos")
    )


def triple_rules(deck: DataFrame, items: DataFrame, *, term: str = "best") -> DataFrame:
    """Best rule for each card of the set, with support and confidence.

    The rule must name neither the card as its scorer nor as its item; ties go to
    the better rank, then the earlier pick.  ``term='best'`` uses the similarity
    of the chosen rule; ``term='last'`` that of the rule that comes last.  Best
    confidence first, equal ones in the order of the set; ``rule_pos`` counts them.
    """
    per_card = _rules_per_card(deck, _set_similarities(deck, items, "scorer_id"), "r_anchor")
    order = F.struct("r_rank", "r_pos")
    last = per_card.groupBy("anchor_id", "card_id").agg(F.max_by("sim", order).alias("last_sim"))
    choice = Window.partitionBy("anchor_id", "card_id").orderBy(
        F.col("sim").desc(), "r_rank", "r_pos"
    )
    best = (
        per_card.where((F.col("r_anchor") != F.col("card_id")) & (F.col("r_item") != F.col("card_id")))
        .withColumn("_n", F.row_number().over(choice))
        .where(F.col("_n") == 1)
    )
    used = deck.groupBy("anchor_id", F.col("scorer_id").alias("r_anchor")).agg(F.count("*").alias("uses"))
    sizes = _words_of(deck, items, "scorer_id").select(
        F.col("item_id").alias("r_anchor"), phrase_count("tokens").alias("r_phrases")
    )
    cards = deck.select("anchor_id", F.col("item_id").alias("card_id"), "rank", "deck_pos")
    s = _term(F.col("sim"), F.col("last_sim"), term)
    found = (
        cards.join(best, ["anchor_id", "card_id"], "left")
        .join(last, ["anchor_id", "card_id"], "left")
        .join(used, ["anchor_id", "r_anchor"], "left")
        .join(sizes, "r_anchor", "left")
        .select(
            "anchor_id",
            "r_anchor",
            "r_item",
            "card_id",
            ((s + F.col("r_sim")) / F.col("uses")).alias("support"),
            (F.try_divide(s + F.col("r_sim"), F.col("r_sim")) / F.col("r_phrases")).alias("confidence"),
            "rank",
            "deck_pos",
        )
    )
    return _in_order(found, F.col("confidence").desc_nulls_last())


def triple_rules_mean(deck: DataFrame, items: DataFrame, *, term: str = "best") -> DataFrame:
    """The older form: rules are scored by their item, support by the mean similarity.

    ``term='last'`` uses the similarity of the rule that comes last and reports
    that rule's pair.  Best rank first, equal ones in the order of the set.
    """
    sims = _set_similarities(deck, items, "item_id")
    mean = sims.groupBy("anchor_id", F.col("b").alias("card_id")).agg(F.avg("sim").alias("mean_sim"))
    per_card = _rules_per_card(deck, sims, "r_item")
    rule = F.struct("r_anchor", "r_item", "r_sim", "sim")
    chosen = per_card.groupBy("anchor_id", "card_id").agg(
        F.max_by(rule, F.struct("sim", -F.col("r_rank"), -F.col("r_pos"))).alias("best"),
        F.max_by(rule, F.struct("r_rank", "r_pos")).alias("last"),
    )
    pair = _term(F.col("best"), F.col("last"), term)
    s = _term(F.col("best.sim"), F.col("last.sim"), term)
    total = s + F.col("best.r_sim")
    cards = deck.select("anchor_id", F.col("item_id").alias("card_id"), "rank", "deck_pos")
    found = (
        cards.join(chosen, ["anchor_id", "card_id"])
        .join(mean, ["anchor_id", "card_id"])
        .select(
            "anchor_id",
            pair["r_anchor"].alias("r_anchor"),
            pair["r_item"].alias("r_item"),
            "card_id",
            F.try_divide(total, F.col("mean_sim")).alias("support"),
            F.try_divide(total, F.col("best.r_sim")).alias("confidence"),
            "rank",
            "deck_pos",
        )
    )
    return _in_order(found, F.col("rank"))


def top_rules(triples: DataFrame, names: DataFrame, n: int = 10) -> DataFrame:
    """The rules of highest confidence, with the names of the three items.

    ``triples`` as ``triple_rules`` returns them; ``names(item_id, name)``.
    """
    columns = ("r_anchor", "r_item", "card_id")
    top = cut(triples.orderBy(F.col("confidence").desc_nulls_last(), "rule_pos").limit(n))
    ids = top.select(F.explode(F.array(*columns)).alias("item_id")).distinct()
    known = cut(names.join(small(ids, 3 * n), "item_id").select("item_id", "name"))
    for column in columns:
        top = top.join(
            known.select(F.col("item_id").alias(column), F.col("name").alias(f"{column}_name")), column, "left"
        )
    return top.select(
        "r_anchor_name", "r_item_name", "card_id_name", "support", "confidence"
    )
