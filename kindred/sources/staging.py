"""Shared-storage helpers: lineage cuts and staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast is asked for only where a row bound is known and below this.
BROADCAST_ROW_BOUND = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder.

    Taken from ``spark.checkpoint.dir``.  Where that is absent a temporary folder is made
    if all runs on one machine; on a cluster it is an error.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = spark.conf.get("spark.checkpoint.dir", conf)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="kindred-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to shared storage and read it back: the lineage ends there.

    A written table, unlike a checkpoint, also drops the constraints Spark infers
    along the way (they multiply over the rounds of a loop) and gives the planner
    its true size.
    """
    path = staged_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table written to the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast where the row bound allows it; else leave it to Spark."""
    return F.broadcast(df) if rows <= BROADCAST_ROW_BOUND else df


def build_side(df: DataFrame, rows: int) -> DataFrame:
    """As ``small``, but past the bound ask for a sort-merge join.

    Use it where the other side is the catalog: Spark estimates an exploded scan
    by its file size and might broadcast the catalog instead.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROW_BOUND else df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a scan that has fewer splits than the cluster has cores.

    A scan of many files already has more splits than that and is returned as
    it is: no shuffle.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df
