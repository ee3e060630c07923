"""Label-list expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.fixed import FLAG_SUPERTYPE, LABEL_NAMES
from kindred.functions.text import strip


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_set(text: Column | str) -> Column:
    """Set of labels of a comma list; null is the empty set."""
    parts = F.transform(F.split(_col(text), ",", -1), lambda x: strip(x))
    return F.coalesce(F.array_distinct(parts), F.array().cast("array<string>"))


def feature_labels(text: Column | str) -> Column:
    """Labels as features: null and empty text are the one label ``''``."""
    filled = F.coalesce(_col(text), F.lit(""))
    return F.transform(F.split(filled, ",", -1), lambda x: strip(x))


def decode(label: Column, names: dict[str, str] | None = None) -> Column:
    """Full name of a label code; unknown codes stay as they are."""
    pairs = chain.from_iterable((names or LABEL_NAMES).items())
    table = F.create_map(*[F.lit(v) for v in pairs])
    return F.coalesce(F.try_element_at(table, label), label)


def decode_all(labels: Column | str, names: dict[str, str] | None = None) -> Column:
    return F.transform(_col(labels), lambda x: decode(x, names))


def is_subset(labels: Column | str, of: Column) -> Column:
    return F.size(F.array_except(_col(labels), of)) == 0


def is_legendary(supertypes: Column | str) -> Column:
    return F.coalesce(_col(supertypes).contains(FLAG_SUPERTYPE), F.lit(False))
