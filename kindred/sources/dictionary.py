"""Keyword dictionary: nested JSON to a (category, keyword) dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The categories of the dictionary file.
CATEGORIES = ("abilityWords", "keywordAbilities", "keywordActions")


def dictionary_schema(categories: tuple[str, ...] = CATEGORIES) -> T.StructType:
    words = T.ArrayType(T.StringType())
    return T.StructType(
        [
            T.StructField("meta", T.StructType([T.StructField("date", T.StringType()), T.StructField("version", T.StringType())])),
            T.StructField("data", T.StructType([T.StructField(c, words) for c in categories])),
        ]
    )


def read_dictionary(
    spark: SparkSession,
    path: str,
    categories: tuple[str, ...] = CATEGORIES,
    *,
    one_document_per_file: bool = True,
) -> DataFrame:
    raw = spark.read.schema(dictionary_schema(categories)).json(path, multiLine=one_document_per_file)
    rows = [
        F.struct(F.lit(c).alias("category"), F.col(f"data.{c}").alias("keywords"))
        for c in categories
    ]
    return (
        raw.select(F.explode(F.array(*rows)).alias("r"))
        .select("r.category", F.explode("r.keywords").alias("keyword"))
        .distinct()
    )


def category_counts(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("category").agg(F.count("*").alias("n"))
