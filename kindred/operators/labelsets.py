"""Label sets: subset filter, multi-hot features and cosine neighbours."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.fixed import NEAREST_LIMIT
from kindred.functions.labels import decode, feature_labels, is_legendary, is_subset


def anchor_value(items: DataFrame, name: str, value: Column, order: str = "ord") -> Column:
    """A value of the first item with this name, as a scalar; null if there is none."""
    return (
        items.where(F.col("name") == name).orderBy(order).limit(1).select(value.alias("_value")).scalar()
    )


def legal_items(items: DataFrame, anchor_name: str, labels: str = "labels") -> DataFrame:
    """Items whose labels are all among the anchor's.

    An item or anchor without labels has the empty set; an unknown anchor gives
    no rows.  The anchor's set is a scalar, so this is a plain filter.
    """
    empty = F.array().cast("array<string>")
    allowed = anchor_value(items, anchor_name, F.coalesce(labels, empty))
    return items.where(is_subset(F.coalesce(labels, empty), allowed))


def item_features(
    items: DataFrame,
    *,
    colors: str = "colorIdentity",
    keywords: str = "keywords",
    supertypes: str = "supertypes",
) -> DataFrame:
    """``features``: the sorted set of feature labels of each item.

    Prefixes keep the three sources apart, because both lists may hold ``''``.
    """
    color = F.transform(feature_labels(colors), lambda c: F.concat(F.lit("color:"), decode(c)))
    keyword = F.transform(feature_labels(keywords), lambda k: F.concat(F.lit("kw:"), k))
    none = F.array().cast("array<string>")
    flag = F.when(is_legendary(supertypes), F.array(F.lit("flag:legendary"))).otherwise(none)
    return items.withColumn("features", F.array_sort(F.array_distinct(F.concat(color, keyword, flag))))


def feature_rows(items: DataFrame, key: str = "item_id", features: str = "features") -> DataFrame:
    """Long form of the multi-hot matrix: one row per item and label."""
    return items.select(key, F.explode(features).alias("label"))


def vocabulary(items: DataFrame, features: str = "features") -> list[str]:
    """Sorted distinct labels: the columns of the matrix."""
    rows = items.select(F.explode(features).alias("label")).distinct().collect()
    return sorted(r.label for r in rows)


def multi_hot(
    items: DataFrame, words: list[str] | None = None, features: str = "features", output: str = "vector"
) -> DataFrame:
    """Sparse 0/1 vector per item, columns in label order."""
    words = vocabulary(items, features) if words is None else words
    model = CountVectorizerModel.from_vocabulary(words, inputCol=features, outputCol=output, minTF=0.0)
    return model.setBinary(True).transform(items)


def label_cosine(a: Column, b: Column) -> Column:
    """Cosine of two label sets; 0 when either is empty."""
    shared = F.size(F.array_intersect(a, b)).cast("double")
    scale = F.sqrt(F.size(a).cast("double") * F.size(b))
    return F.coalesce(F.try_divide(shared, scale), F.lit(0.0))


def vector_cosine(a: Column, b: Column) -> Column:
    """Cosine of two number arrays; 0 when either is zero."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, v: total + v)

    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b))), F.lit(0.0))


def nearest(
    items: DataFrame,
    anchor_id: int | str,
    *,
    column: str = "features",
    key: str = "item_id",
    measure=label_cosine,
    top: int = NEAREST_LIMIT,
) -> DataFrame:
    """The ``top`` items most similar to the anchor, the anchor itself left out.

    The anchor's value is a scalar, so one pass with a bounded top-k is enough.
    """
    anchor = items.where(F.col(key) == anchor_id).orderBy(key).limit(1).select(column).scalar()
    known = items.where(F.col(key) != anchor_id).withColumn("_anchor", anchor).where(F.col("_anchor").isNotNull())
    scored = known.withColumn("similarity", measure(F.col(column), F.col("_anchor"))).drop("_anchor")
    return scored.orderBy(F.col("similarity").desc(), key).limit(top)
