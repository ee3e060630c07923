"""Searches and point lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.fixed import ANCHOR_TYPE, MISSING_COST, SEARCH_LIMIT
from kindred.functions.text import display_text, matches


def search_names(
    items: DataFrame,
    term: str,
    *,
    type_term: str = ANCHOR_TYPE,
    limit: int = SEARCH_LIMIT,
    regex: bool = False,
) -> DataFrame:
    """First names, by row order, that hold the term and have the type."""
    hit = matches("name", term, regex=regex, ignore_case=True) & matches(
        "types", type_term, regex=regex, ignore_case=True
    )
    return items.where(hit).select("ord", "name").orderBy("ord").limit(limit)


def first_named(items: DataFrame, name: str) -> DataFrame:
    """The first row with this name, or none."""
    return items.where(F.col("name") == name).orderBy("ord").limit(1)


def item_card(items: DataFrame, name: str) -> DataFrame:
    """Display fields of one item."""
    return first_named(items, name).select(
        F.col("name").alias("cardname"),
        "types",
        F.col("manaCost").alias("manacost"),
        display_text("text").alias("cardtext"),
        F.col("edhrecRank").alias("edhrec"),
        F.col("setCode").alias("setcode"),
    )


def recommendation_card(recommendations: DataFrame, name: str) -> DataFrame:
    """Display fields of one recommended item; nulls are shown as text.

    The fill applies to every column that may be a number or missing, so those
    come back as strings.
    """
    filled = {
        c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_COST))
        for c in ("manaCost", "sim_score", "edhrecRank", "edhrecRank_prediction")
    }
    row = (
        recommendations.where(F.col("name") == name)
        .orderBy(F.col("sim_score").desc(), "card_index")
        .limit(1)
        .withColumns(filled)
    )
    shown = display_text("text")
    return row.select(
        F.col("name").alias("cardname"),
        "types",
        shown.alias("text"),
        "manaCost",
        shown.alias("cardtext"),
        F.col("edhrecRank").alias("edhrec"),
        F.col("edhrecRank_prediction").alias("edhrec_predicted"),
        "sim_score",
    )


def _hits(df: DataFrame, value: str):
    """Names of the columns of a row that equal the value."""
    return F.array_compact(
        F.array(*[F.when(F.col(c).cast("string") == value, F.lit(c)) for c in df.columns])
    )


def cells_equal(df: DataFrame, value: str, order: str = "ord") -> DataFrame:
    """(order, column) of every cell equal to the value.

    Matching columns are found inside each row, so rows without a hit are
    dropped before anything is exploded.
    """
    found = df.select(order, _hits(df.drop(order), value).alias("columns")).where(F.size("columns") > 0)
    return found.select(order, F.explode("columns").alias("column"))


def columns_always_equal(df: DataFrame, value: str, order: str = "ord") -> DataFrame:
    """Columns that equal the value in every row with at least one hit."""
    cells = df.drop(order)
    found = cells.select(_hits(cells, value).alias("columns")).where(F.size("columns") > 0)
    per_column = found.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.array_contains("columns", c)).alias(c) for c in cells.columns],
    )
    return (
        per_column.unpivot("_rows", list(cells.columns), "column", "hits")
        .where((F.col("hits") == F.col("_rows")) & (F.col("_rows") > 0))
        .select("column", F.col("hits").alias("rows"))
    )


def has_name(items: DataFrame, name: str) -> DataFrame:
    """One row saying whether the name occurs; stops at the first hit."""
    hit = items.where(F.col("name") == name).limit(1)
    return hit.agg((F.count("*") > 0).alias("found"))
