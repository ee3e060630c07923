"""Token counts kept up to date by signed deltas.

A batch holds changes of documents: ``insert``, ``delete`` or ``revise``, each with the tokenizer version it
counts for.  Its effect is the difference to what the earlier batches left of the same documents: the
old counts with a minus, the new ones with a plus.  The signed rows go to ``path/ledger/batch=<n>``, their sums by
source, language and version to ``path/rollup/batch=<n>``; totals are sums of rollups.

Batches have numbers and are committed in that order.  A batch's folders are replaced as a whole, so
committing one again (after a lost driver, or twice by mistake) gives the same totals.

Of several changes of one document and version in a batch the one with the greatest ``seq`` counts, of
equal ones the greatest by operation and values.  Deleting what is not there has no effect; inserting what is
there replaces it, as does revising; revising what is not there inserts it.  Null sources and languages are
groups, null versions one version; null tokens count 0.  A change without a doc_id names no document, so it can only add:
each insert or revise counts as a document of its own, a delete has no effect.  A change whose operation is null or none
of the three changes nothing and is kept in ``path/rejects/batch=<n>`` (``rejected``).  An empty batch is a
batch.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ("source", "lang", "version")
OPERATIONS = ("insert", "delete", "revise")
LEDGER = "doc_id long, version string, source string, lang string, docs long, tokens long"
REJECTS = "doc_id long, version string, op string, seq long"
ROLLUP = "source string, lang string, version string, docs long, tokens long"


def _final(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The change that counts of each document and version, and all changes without a document."""
    rows = changes.where(F.col("op").isin(*OPERATIONS)).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("version").cast("string").alias("version"),
        F.struct(
            F.col("seq").cast("long").alias("seq"),
            "op",
            F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"),
            F.coalesce(F.col("tokens").cast("long"), F.lit(0)).alias("tokens"),
        ).alias("change"),
    )
    named = rows.where("doc_id is not null").groupBy("doc_id", "version").agg(F.max("change").alias("change"))
    return named, rows.where("doc_id is null")


def _earlier(spark: SparkSession, path: str, kind: str, schema: str, batch: int | None) -> DataFrame:
    """Rows of the batches before ``batch`` (all, if none is given)."""
    numbers = range(1, batch) if batch is not None else None
    if numbers is not None and not len(numbers):
        return spark.createDataFrame([], schema)
    paths = [f"{path}/{kind}/batch={n}" for n in numbers] if numbers is not None else [f"{path}/{kind}/*"]
    return spark.read.schema(schema).parquet(*paths)


def commit_batch(changes: DataFrame, path: str, batch: int) -> None:
    """Apply batch number ``batch`` (1, 2, ...); the earlier ones must be there."""
    spark = changes.sparkSession
    final, unnamed = _final(changes)
    refused = changes.where(~F.coalesce(F.col("op").isin(*OPERATIONS), F.lit(False)))
    refused.select(
        F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("version", "op")), F.col("seq").cast("long").alias("seq")
    ).write.mode("overwrite").parquet(f"{path}/rejects/batch={batch}")
    # What is left of a document is the sum of its signed rows.
    left = (
        _earlier(spark, path, "ledger", LEDGER, batch)
        .groupBy("doc_id", "version", "source", "lang")
        .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        .where("docs <> 0 or tokens <> 0")
    )
    same = (left["doc_id"] == final["doc_id"]) & left["version"].eqNullSafe(final["version"])
    minus = left.join(final, same, "left_semi").select(
        "doc_id", "version", "source", "lang", (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens")
    )
    plus = final.union(unnamed).where("change.op <> 'delete'").select(
        "doc_id", "version", "change.source", "change.lang", F.lit(1).cast("long").alias("docs"), "change.tokens"
    )
    signed = minus.union(plus).groupBy("doc_id", "version", "source", "lang").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    signed.where("docs <> 0 or tokens <> 0").write.mode("overwrite").parquet(f"{path}/ledger/batch={batch}")
    written = spark.read.schema(LEDGER).parquet(f"{path}/ledger/batch={batch}")
    sums = written.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    sums.write.mode("overwrite").parquet(f"{path}/rollup/batch={batch}")


def totals(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """``(source, lang, version, docs, tokens)`` after batch ``upto`` (the last, if none is given)."""
    rows = _earlier(spark, path, "rollup", ROLLUP, None if upto is None else upto + 1)
    return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")


def rejected(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """``(doc_id, version, op, seq)`` of the changes that batches up to ``upto`` refused."""
    return _earlier(spark, path, "rejects", REJECTS, None if upto is None else upto + 1)
