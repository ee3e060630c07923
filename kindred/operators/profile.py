"""Table inspection and label counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """Type and non-null count of each column, in one pass."""
    kinds = dict(df.dtypes)
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), F.col(c).alias("non_null")
        )
        for c in df.columns
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def head(df: DataFrame, n: int = 10, order: str = "ord") -> DataFrame:
    return df.orderBy(order).limit(n)


def tail(df: DataFrame, n: int = 10, order: str = "ord") -> DataFrame:
    return df.orderBy(F.col(order).desc()).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.col("n").desc(), column)


def label_counts(df: DataFrame, labels: str, *, top: int | None = None) -> DataFrame:
    """Rows per label of a label-list column, most frequent first."""
    counted = value_counts(df.select(F.explode(labels).alias("label")), "label")
    return counted.limit(top) if top else counted
