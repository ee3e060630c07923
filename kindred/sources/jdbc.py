"""JDBC scan. Credentials come from the caller or the environment only."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

EXTRACT_COLUMNS = ("name", "colorIdentity", "keywords", "supertypes")


def jdbc_options(
    url: str,
    table: str,
    *,
    columns: tuple[str, ...] = EXTRACT_COLUMNS,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a projected read, split by ranges of a numeric column if given."""
    wanted = list(columns)
    if partition_column and partition_column not in wanted:
        wanted.append(partition_column)
    options = {
        "url": url,
        "dbtable": f"(SELECT {', '.join(wanted)} FROM {table}) extract",
        "fetchsize": str(fetch_size),
    }
    if driver:
        options["driver"] = driver
    if partition_column:
        if bounds is None or partitions < 2:
            raise ValueError("a partition column needs bounds and at least two partitions")
        low, high = bounds
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    for option, variable in (("user", "KINDRED_JDBC_USER"), ("password", "KINDRED_JDBC_PASSWORD")):
        if variable in os.environ:
            options[option] = os.environ[variable]
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    columns = kwargs.get("columns", EXTRACT_COLUMNS)
    scan = spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()
    return scan.select(*columns)
