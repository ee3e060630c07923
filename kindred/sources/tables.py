"""Item-table schemas and the Parquet and CSV scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.sources.staging import cut, small

_S, _D, _B = T.StringType(), T.DoubleType(), T.BooleanType()

ITEM_SCHEMA = T.StructType(
    [T.StructField(n, _S) for n in ("name", "colorIdentity", "colors", "subtypes", "supertypes", "keywords", "text")]
    + [T.StructField(n, _D) for n in ("edhrecRank", "edhrecSaltiness", "manaValue")]
    + [T.StructField(n, _S) for n in ("manaCost", "power", "toughness", "type", "types", "setCode", "availability")]
    + [T.StructField(n, _B) for n in ("isOnlineOnly", "isTextless", "isReserved", "hasAlternativeDeckLimit")]
    + [T.StructField(n, _S) for n in ("uuid", "layout", "rarity")]
)

EXTRACT_SCHEMA = T.StructType(
    [T.StructField(n, _S) for n in ("name", "colorIdentity", "keywords", "supertypes")]
)


def read_table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Parquet scan of the named columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    *,
    na_tokens: Sequence[str] = (),
    multi_line: bool = True,
) -> DataFrame:
    """CSV scan with quoted line breaks and doubled quotes.

    Files known to hold no quoted line breaks can be read with ``multi_line=False``; large
    ones are then split among tasks.  Only the empty field is null; ``na_tokens`` adds further null spellings.
    """
    df = spark.read.schema(schema).csv(
        path, header=True, multiLine=multi_line, quote='"', escape='"'
    )
    if not na_tokens:
        return df
    tokens = list(na_tokens)
    return df.select(
        *[
            F.when(~F.col(f.name).isin(tokens), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )


def with_row_order(scan: DataFrame, name: str = "ord") -> DataFrame:
    """Add the row number, from 0, in order of file names and of places in the files.

    Large files may be split among tasks.  One task reads a split in one go, so ids
    generated in the scan rise by one within it; the counts of the splits, one small row each,
    added up by file and then over the files, give what comes before.  The scan is
    written with its ids first: read twice, it could be split another way, for Spark deals
    small inputs by the cores that it has at that moment.  No row of the scan is sorted or,
    up to the bound of a broadcast on the number of splits, shuffled.
    """
    marked = cut(
        scan.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    splits = marked.groupBy("_file", "_start").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    splits = cut(splits)
    in_file = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    over_files = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("_file").agg(F.sum("_n").alias("_n"))
    files = files.select("_file", F.coalesce(F.sum("_n").over(over_files), F.lit(0)).alias("_files"))
    before = F.coalesce(F.sum("_n").over(in_file), F.lit(0))
    inside = splits.select("_file", "_start", (before - F.col("_first")).alias("_inside"))
    shifts = inside.join(files, "_file").select("_file", "_start", (F.col("_files") + F.col("_inside")).alias("_shift"))
    return (
        marked.join(small(shifts, splits.count()), ["_file", "_start"])
        .withColumn(name, F.col("_row") + F.col("_shift"))
        .drop("_file", "_start", "_row", "_shift")
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with a header and no index column; outer blanks are kept."""
    df.write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
