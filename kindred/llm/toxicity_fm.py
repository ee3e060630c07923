"""Toxicity by a factorization machine over hashed terms.

Terms are runs of letters and digits (bytes above 127 count as letters), lower-cased; each
also counts by its first bytes, so that a stem is known with endings never seen.  A document is the set
of its terms' hashes.  The machine adds a weight for each known term and the product of two
terms' vectors for each pair, so a pair may count for more or less than its terms.

It learns from a bounded sample of labelled rows (``SAMPLE_ROWS``, least hashes of doc_id; near copies
in it count once): terms whose share among toxic rows stands out are kept, at most ``TERMS``, and fitted by
full-batch descent in the driver.  Every document is scored, whole, by tasks that get the
fitted table.  Only the text is an input.

Null and empty texts have no term and get the base rate.  Labels that repeat a doc_id count as toxic if
any does; null labels are ignored.  Without rows of both labels the score is the base rate.  Null ids are
never held out and never learnt from.  All columns of the documents are kept, but for one named like the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm import words as W
from kindred.llm.columns import others, quoted
from kindred.sources.staging import cut

SAMPLE_ROWS = 16_000
TERMS = 4096
RANK = 8
STEMS = (4, 5, 6)
FOLDS = 5
# Least deviation, in standard errors, of a term's share of toxic rows.
STANDS_OUT = 4.5
ROUNDS = 400

BETWEEN = np.ones(256, bool)
BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def term_hashes(texts: W.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Text index and hash of each term and stem, repeats included."""
    starts, ends, bounds = W.word_spans(texts, BETWEEN)
    data, doc = W.LOWER[texts.data], W.owner(bounds)
    docs, values = [doc], [W.span_hashes(data, starts, ends)]
    for size in STEMS:
        long = ends - starts > size
        docs.append(doc[long])
        values.append(W.mix(W.span_hashes(data, starts[long], starts[long] + size) ^ W.U64(size)))
    return np.concatenate(docs), np.concatenate(values)


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass
class Model:
    terms: np.ndarray
    base: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, n: int, doc: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Scores of n texts from their term hashes."""
        if len(self.terms) and len(values):
            at = np.minimum(np.searchsorted(self.terms, values), len(self.terms) - 1)
            known = self.terms[at] == values
            doc, at = W.distinct_within(doc[known], at[known])
        else:
            doc = at = np.zeros(0, np.int64)
        y = np.full(n, self.base) + np.bincount(doc, self.weights[at], n)
        for k in range(self.vectors.shape[1]):
            v = self.vectors[at, k]
            y += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
        return 1 / (1 + np.exp(-np.clip(y, -40, 40)))


def sample(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(_id, toxic, least, terms)`` of the sampled rows; ``least``: least shingle hash, which near copies mostly share."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(known), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in W.slices(batch, "text"):
                doc, values = W.distinct_within(*term_hashes(texts))
                ends = np.searchsorted(doc, np.arange(len(texts) + 1))
                least = np.zeros(len(texts), W.U64)
                owner, shingle = W.distinct_within(*W.shingle_hashes(*W.word_hashes(texts)))
                some, at = np.unique(owner, return_index=True)
                least[some] = shingle[at]
                terms = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), W.signed(values))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), W.signed(least), terms], names=["_id", "toxic", "least", "terms"])

    return texts.select("_id", "text", "_toxic").mapInArrow(run, "_id long, toxic int, least long, terms array<long>")


def known_terms(rows: DataFrame, most: int = TERMS) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The terms that stand out, in order, and each sampled row's label and places among them.

    ``rows`` is the bounded sample; its terms are counted by tasks, and only what is known of it is collected.
    """
    once = cut(rows.groupBy("toxic", "least").agg(F.min_by("terms", "_id").alias("terms"), F.min("_id").alias("_id")))
    n, positive = once.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    labels = once.select("_id", "toxic").orderBy("_id").collect()
    empty = np.zeros(0, np.int64)
    if positive in (0, n):
        return np.zeros(0, W.U64), [(r["toxic"], empty) for r in labels]
    rate = positive / n
    seen, toxic = F.count("*"), F.sum("toxic")
    deviation = F.abs(toxic - seen * rate) / F.sqrt(seen * (rate * (1 - rate)))
    counted = once.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(deviation.alias("deviation"), seen.alias("seen"))
    kept = counted.where((F.col("deviation") >= STANDS_OUT) & (F.col("seen") >= 4)).orderBy(F.desc("deviation"), "term").limit(most)
    kept = cut(kept.select("term"))
    terms = np.sort(np.array([r[0] for r in kept.collect()], np.int64).view(W.U64))
    held = once.select("_id", F.explode("terms").alias("term")).join(F.broadcast(kept), "term").groupBy("_id").agg(F.collect_list("term").alias("terms"))
    held = {r["_id"]: np.array(r["terms"], np.int64).view(W.U64) for r in held.collect()}
    return terms, [(r["toxic"], np.sort(np.searchsorted(terms, held[r["_id"]])) if r["_id"] in held else empty) for r in labels]


def fit(terms: np.ndarray, rows: list[tuple[int, np.ndarray]], rank: int = RANK, rounds: int = ROUNDS) -> Model:
    n, positive = len(rows), sum(label for label, _ in rows)
    base = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    m = len(terms)
    if not m:
        return Model(np.zeros(0, W.U64), base, np.zeros(0), np.zeros((0, rank)))
    label = np.array([x for x, _ in rows], float)
    doc = np.repeat(np.arange(n), [len(t) for _, t in rows])
    at = np.concatenate([t for _, t in rows])
    w0, w = base, np.zeros(m)
    v = 0.1 * np.random.default_rng(7).standard_normal((m, rank))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (np.zeros(1), w, v)]
    by_term, by_doc = np.argsort(at, kind="stable"), np.argsort(doc, kind="stable")
    term_at = np.flatnonzero(np.r_[True, np.diff(at[by_term]) > 0])
    doc_at = np.flatnonzero(np.r_[True, np.diff(doc[by_doc]) > 0])
    docs = doc[by_doc][doc_at]
    for step in range(1, rounds + 1):
        held = v[at]
        s, q = np.zeros((n, rank)), np.zeros((n, rank))
        s[docs] = np.add.reduceat(held[by_doc], doc_at)
        q[docs] = np.add.reduceat((held * held)[by_doc], doc_at)
        y = w0 + np.bincount(doc, w[at], n) + 0.5 * (s * s - q).sum(1)
        g = 1 / (1 + np.exp(-np.clip(y, -40, 40))) - label
        grads = (
            np.array([g.mean()]),
            np.bincount(at, g[doc], m) / n + 1e-5 * w,
            np.add.reduceat((g[doc][:, None] * (s[doc] - held))[by_term], term_at) / n + 1e-4 * v,
        )
        moves = []
        for grad, (first, second) in zip(grads, state, strict=True):
            first[...] = 0.9 * first + 0.1 * grad
            second[...] = 0.999 * second + 0.001 * grad * grad
            moves.append(0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8))
        w0 -= float(moves[0][0])
        w -= moves[1]
        v -= moves[2]
    return Model(terms, w0, w, v)


def scored(documents: DataFrame, model: Model, column: str = "_toxicity") -> DataFrame:
    """``documents`` with a score from 0 to 1 of every whole text, in place of any column of that name."""
    documents = documents.select(*map(quoted, others(documents, column)))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    text = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in W.slices(batch, batch.schema.names[text]):
                score = shared.value.score(len(texts), *term_hashes(texts))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(score)], names=[*rows.schema.names, column])

    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, T.StructField(column, T.DoubleType())]))


def toxicity(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, column: str = "_toxicity") -> DataFrame:
    """Learn from the labels, score every document in a column of that name."""
    return scored(documents, fit(*known_terms(sample(documents, labels, rows))), column)
