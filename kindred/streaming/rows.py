"""Cleaning and scoring of arriving items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.fixed import AVAILABILITY, DROPPED_TYPE
from kindred.functions.labels import label_set
from kindred.functions.text import tokens
from kindred.operators.clean import drop_matching, keep_matching


def clean_arrivals(items: DataFrame) -> DataFrame:
    """The row-wise part of the cleaning chain, with parsed labels and words."""
    kept = drop_matching(keep_matching(items, "availability", AVAILABILITY), "types", DROPPED_TYPE)
    return kept.where(F.col("text").isNotNull()).withColumns(
        {"labels": label_set("colorIdentity"), "tokens": tokens("text")}
    )


def predict_arrivals(items: DataFrame, slope: float, intercept: float, x: str = "sim_score") -> DataFrame:
    """Predicted rank of arriving items from a line fitted beforehand."""
    return items.withColumn("prediction", F.lit(intercept) + F.lit(slope) * F.col(x))
