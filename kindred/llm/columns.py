"""Names that cannot clash: rows are carried as one struct, and results replace columns named like them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "_row"


def packed(df: DataFrame) -> DataFrame:
    """``df`` as one column that holds the row."""
    return df.select(F.struct(*(F.col(quoted(c)) for c in df.columns)).alias(ROW))


def field(name: str) -> Column:
    """A column of the packed row."""
    return F.col(ROW).getField(name)


def fields(df: DataFrame, *results: str) -> list[Column]:
    """The packed row's columns, without those named like a result (Spark does not tell case apart)."""
    return [field(c).alias(c) for c in others(df, *results)]


def others(df: DataFrame, *results: str) -> list[str]:
    taken = {r.lower() for r in results}
    return [c for c in df.columns if c.lower() not in taken]


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to differ from every column."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
