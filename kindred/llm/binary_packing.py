"""Packing by power-of-two decomposition.

A document's ids (with an end id) are cut into pieces whose lengths are powers of two, longest
first: as many of the longest as fit, then one for each binary digit of the rest.  Every piece is a
sequence of its own, so no sequence crosses documents and none is padded; sequences of equal length
lie in one bucket, from which batches of one shape are read.

``path/pieces/length=L`` holds the sequences of each length, ``path/starts`` the number of the first
sequence that each writing task has of each length; numbers are gapless, by length and task.  A task
streams its documents: what it holds is a slice of texts (one text at least).  Spark's writers
commit the files, so a lost task is written anew with the same rows.

Null and empty texts have the end id only.  Rows that repeat an id are documents of their own.  An
empty table gives no sequences.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.llm import words as W
from kindred.llm.rans_tokens import encoder
from kindred.sources.staging import small, spread

LONGEST = 4096
END_ID = 2
# Ids sent in one batch: a piece is never larger.
IDS_AT_ONCE = 1 << 22

PIECE = "doc_id long, start long, doc_tokens long, part int, number long, ids binary, length int"


def binary_pieces(sizes: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, start, length)`` of the pieces of documents of these sizes, in order."""
    lengths = longest >> np.arange(longest.bit_length())
    counts = (sizes[:, None] // lengths) & 1
    counts[:, 0] = sizes // longest
    which = np.repeat(np.tile(np.arange(len(lengths)), len(sizes)), counts.reshape(-1))
    doc, length = np.repeat(np.arange(len(sizes)), counts.sum(1)), lengths[which]
    before = np.cumsum(length) - length
    return doc, before - (np.cumsum(sizes) - sizes)[doc], length


def _numbers(length: np.ndarray, seen: dict[int, int]) -> np.ndarray:
    """Running number of each piece among those of its length."""
    out = np.empty(len(length), np.int64)
    for size in np.unique(length).tolist():
        at = np.flatnonzero(length == size)
        out[at] = seen.get(size, 0) + np.arange(len(at))
        seen[size] = seen.get(size, 0) + len(at)
    return out


def pieces(documents: DataFrame, tokenizer_path: str, longest: int = LONGEST, end_id: int = END_ID) -> DataFrame:
    """One row a sequence, with little-endian 32-bit ids."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen = encoder(tokenizer_path, end_id), TaskContext.get().partitionId(), {}
        for batch in batches:
            for rows, texts in W.slices(batch, "text"):
                ids, sizes = own.encode(texts)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                doc, start, length = binary_pieces(sizes, longest)
                ends = np.r_[0, np.cumsum(length)]
                low = 0
                while low < len(doc):
                    high = max(low + 1, int(np.searchsorted(ends, ends[low] + IDS_AT_ONCE, side="right")) - 1)
                    cuts = (4 * (ends[low : high + 1] - ends[low])).astype(np.int32)
                    data = pa.py_buffer(raw[4 * ends[low] : 4 * ends[high]])
                    own_ids = pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(cuts.tobytes()), data])
                    d, n = doc[low:high], length[low:high]
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column(0).take(pa.array(d)),
                            pa.array(start[low:high]),
                            pa.array(sizes[d].astype(np.int64)),
                            pa.array(np.full(len(d), part, np.int32)),
                            pa.array(_numbers(n, seen)),
                            own_ids,
                            pa.array(n.astype(np.int32)),
                        ],
                        names=["doc_id", "start", "doc_tokens", "part", "number", "ids", "length"],
                    )
                    low = high

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE)


def write_packed(documents: DataFrame, path: str, tokenizer_path: str, longest: int = LONGEST, end_id: int = END_ID) -> None:
    spark = documents.sparkSession
    packed = pieces(spread(documents.select("doc_id", "text")), tokenizer_path, longest, end_id)
    packed.write.option("compression", "zstd").partitionBy("length").parquet(f"{path}/pieces")
    # A row a task and length.
    counts = spark.read.schema(PIECE).parquet(f"{path}/pieces").groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n"))
    shorter = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)  # a row a length: at most log2(longest) + 1
    base = lengths.select("length", F.coalesce(F.sum("n").over(shorter), F.lit(0)).alias("base"))
    counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n")).join(F.broadcast(base), "length").select(
        "length", "part", (F.col("n") + F.col("base")).alias("first")
    ).write.parquet(f"{path}/starts")


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)`` of every piece."""
    starts = spark.read.schema("length int, part int, first long").parquet(f"{path}/starts")
    return (
        spark.read.schema(PIECE)
        .parquet(f"{path}/pieces")
        .join(small(starts, starts.count()), ["length", "part"])
        .select(
            "doc_id", "start", F.col("length").cast("long").alias("length"), "doc_tokens",
            (F.col("first") + F.col("number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids",
        )
    )
