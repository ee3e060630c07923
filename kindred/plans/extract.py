"""Extract job: database table to CSV."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from kindred.sources.jdbc import read_jdbc
from kindred.sources.tables import write_csv

log = logging.getLogger(__name__)


def extract_to_csv(spark: SparkSession, url: str, table: str, path: str, **options) -> bool:
    """Copy the projected table to CSV; log and return False if it cannot be read."""
    try:
        rows = read_jdbc(spark, url, table, **options)  # connects to learn the schema
    except (Py4JJavaError, PySparkException) as error:
        log.error("extract of %s failed: %s", table, error)
        return False
    write_csv(rows, path)
    return True
