"""Catalog cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.fixed import (
    AVAILABILITY,
    DROPPED_TYPE,
    FILL_NUMBER,
    FILL_TEXT_NUMBER,
    UPCOMING_COHORT,
)
from kindred.functions.labels import label_set
from kindred.functions.text import matches

PIPELINE_COLUMNS = (
    "name", "colorIdentity", "keywords", "text", "edhrecRank", "manaValue", "uuid",
    "availability", "isOnlineOnly", "isTextless", "manaCost", "types", "setCode",
)


def keep_matching(df: DataFrame, column: str, term: str, **how) -> DataFrame:
    return df.where(matches(column, term, **how))


def drop_matching(df: DataFrame, column: str, term: str, **how) -> DataFrame:
    return df.where(~matches(column, term, **how))


def keep_last(df: DataFrame, key: str = "name", order: str = "ord") -> DataFrame:
    """One row per key, the last by ``order``.

    ``max_by`` aggregates before the shuffle, so a key that holds much of the
    table sends one row per task.
    """
    row = F.struct(*df.columns)
    return df.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def fill_with_max(df: DataFrame, column: str) -> DataFrame:
    """Replace nulls by the column's greatest value in the same table."""
    greatest = df.select(F.max(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), greatest))


def clean_items(
    items: DataFrame,
    *,
    availability: str = AVAILABILITY,
    dropped_type: str = DROPPED_TYPE,
    columns: tuple[str, ...] = PIPELINE_COLUMNS,
    regex: bool = False,
) -> DataFrame:
    """The cleaning chain, in its fixed order: de-duplicate, then filter, then fill."""
    available = keep_matching(items, "availability", availability, regex=regex)
    single = keep_last(available.select("ord", *columns))
    kept = drop_matching(single, "types", dropped_type, regex=regex).where(F.col("text").isNotNull())
    return fill_with_max(kept, "edhrecRank")


def split_cohorts(
    items: DataFrame, code: str = UPCOMING_COHORT, column: str = "setCode", *, regex: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(current, upcoming)."""
    return (
        drop_matching(items, column, code, regex=regex),
        keep_matching(items, column, code, regex=regex),
    )


def typed_fill(
    df: DataFrame,
    *,
    text: tuple[str, ...] = ("text",),
    flags: tuple[str, ...] = ("hasAlternativeDeckLimit", "isReserved"),
    numbers: tuple[str, ...] = ("edhrecRank", "edhrecSaltiness"),
    text_numbers: tuple[str, ...] = ("toughness",),
    lists: tuple[str, ...] = ("subtypes", "supertypes", "colors"),
) -> DataFrame:
    """Replace nulls by a default for the column's kind; lists are parsed first."""
    fills: dict[str, Column] = {}
    fills |= {c: F.coalesce(c, F.lit("")) for c in text}
    fills |= {c: F.coalesce(c, F.lit(False)) for c in flags}
    fills |= {c: F.coalesce(c, F.lit(FILL_NUMBER)) for c in numbers}
    fills |= {c: F.coalesce(c, F.lit(FILL_TEXT_NUMBER)) for c in text_numbers}
    fills |= {c: label_set(c) for c in lists}
    return df.withColumns(fills)


def drop_unranked(df: DataFrame, column: str = "edhrecRank") -> DataFrame:
    """Drop rows whose rank is the fill value."""
    return df.where(F.col(column) != FILL_NUMBER)
