"""Phrase overlap: how much of one item's wording another item shares.

``sim(a, b)`` is the number of distinct phrases a and b share, divided by the
number of phrases of b, repeats included.  A phrase is any run of words, so a
text of n words has n(n+1)/2 of them; none of them is ever built here, and repeats on
both sides do not multiply (see ``kindred.operators.runs``).

The anchors' words are counted first.  Up to the row bound they are broadcast and the catalog is read
in one pass without a shuffle; its texts are compared where they lie, copies once a task.  Beyond it anchors and items are
dealt into blocks of bounded size, and each pair of blocks is one group.
Words are compared by 64-bit hashes, runs by 62-bit names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kindred.operators.runs import Anchors, shared
from kindred.sources import staging

# Words of the items, and of the anchors, that meet in one group beyond the bound.
ITEM_WORDS = 2_000_000
ANCHOR_WORDS = 100_000
# Counts that a task remembers of texts it has compared.
REMEMBERED = 2_000_000


def _coded(rows: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col("tokens").isNotNull()).select(key, F.transform("tokens", lambda w: F.xxhash64(w)).alias("codes"))


def _compared(a: Anchors, codes: list[np.ndarray], met: dict[bytes, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of anchor and item, shared phrases and words of the item, of pairs that share any.

    ``met`` remembers the texts that the task has compared, by digest: copies are compared once.
    """
    out = [(np.zeros(0, np.int64),) * 4]
    for i, own in enumerate(codes):
        text = hashlib.blake2b(np.ascontiguousarray(own), digest_size=16).digest()
        if text not in met:
            if len(met) * a.n >= REMEMBERED:
                met.clear()
            count = shared(a, own)
            at = np.flatnonzero(count)
            met[text] = at, count[at]
        at, count = met[text]
        out.append((at, np.full(len(at), i), count, np.full(len(at), len(own))))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _counted(anchors: DataFrame, items: DataFrame) -> DataFrame:
    """``(anchor_id, item_id, shared, n_words)`` of pairs that share a word."""
    spark = items.sparkSession
    a_type, i_type = anchors.schema["anchor_id"].dataType, items.schema["item_id"].dataType
    schema = f"anchor_id {a_type.simpleString()}, item_id {i_type.simpleString()}, shared long, n_words long"
    n_words = anchors.agg(F.coalesce(F.sum(F.size("tokens").cast("long")), F.lit(0))).first()[0]
    if n_words > staging.BROADCAST_ROW_BOUND:
        return _by_blocks(anchors, items, n_words, schema)

    rows = _coded(anchors, "anchor_id").collect()  # at most as many words as the bound
    ids = [r["anchor_id"].asDict(True) if isinstance(r["anchor_id"], Row) else r["anchor_id"] for r in rows]
    id_type = to_arrow_type(a_type)
    known = spark.sparkContext.broadcast((ids, Anchors.of([np.array(r["codes"], np.int64) for r in rows])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, a = known.value
        names, met = pa.array(names, id_type), {}
        for batch in batches:
            lists = batch.column("codes")
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            at, i, count, n = _compared(a, [flat[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)], met)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(at)), batch.column("item_id").take(pa.array(i)), pa.array(count), pa.array(n)],
                names=["anchor_id", "item_id", "shared", "n_words"],
            )

    if not ids:
        return spark.createDataFrame([], schema)
    return _coded(items, "item_id").mapInArrow(run, schema)


def _by_blocks(anchors: DataFrame, items: DataFrame, n_words: int, schema: str) -> DataFrame:
    total = items.agg(F.coalesce(F.sum(F.size("tokens").cast("long")), F.lit(0))).first()[0]
    i_blocks, a_blocks = (max(1, -(-n // most)) for n, most in ((total, ITEM_WORDS), (n_words, ANCHOR_WORDS)))

    def every(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = _coded(anchors, "anchor_id").withColumn("_a", F.pmod(F.xxhash64("anchor_id"), F.lit(a_blocks)).cast("int")).withColumn("_i", every(i_blocks))
    right = _coded(items, "item_id").withColumn("_i", F.pmod(F.xxhash64("item_id"), F.lit(i_blocks)).cast("int")).withColumn("_a", every(a_blocks))

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        a = Anchors.of([np.asarray(c, np.int64) for c in x["codes"]])
        at, i, count, n = _compared(a, [np.asarray(c, np.int64) for c in y["codes"]], {})
        return pd.DataFrame(
            {"anchor_id": x["anchor_id"].to_numpy()[at], "item_id": y["item_id"].to_numpy()[i], "shared": count, "n_words": n}
        )

    return left.groupBy("_a", "_i").cogroup(right.groupBy("_a", "_i")).applyInPandas(meet, schema)


def shared_phrases(anchors: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct phrases shared by each anchor and item that share a word.

    ``anchors(anchor_id, tokens)``, ``items(item_id, tokens)`` ->
    ``(anchor_id, item_id, shared)``; ids are distinct on each side.
    """
    return _counted(anchors, items).drop("n_words")


def similarity(anchors: DataFrame, items: DataFrame, top: int | None = None) -> DataFrame:
    """``(anchor_id, item_id, shared, n_phrases, sim)`` for pairs that share a word.

    Pairs without a common word have similarity 0 and are not listed.  ``top`` keeps that many
    items of each anchor, ties to the least id; by default all are listed.
    """
    n = F.col("n_words")
    pairs = _counted(anchors, items).withColumn("n_phrases", (n * (n + 1) / 2).cast("long")).select(
        "anchor_id", "item_id", "shared", "n_phrases", (F.col("shared") / F.col("n_phrases")).alias("sim")
    )
    if top is None:
        return pairs
    best = Window.partitionBy("anchor_id").orderBy(F.col("sim").desc(), "item_id")
    return pairs.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= top).drop("_place")
