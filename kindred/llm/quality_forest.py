"""Quality rules, and an isolation forest on their statistics.

Statistics of each whole text come first (words, code points in words, symbols, repeated lines, words in
repeated 8-word windows, and shares of capitals, digits and punctuation).  Fixed rules reject short
and repetitive texts.  Trees part the box of the labelled rows at random values of random statistics, and samples
of good rows with it; a text that is soon where few or none of these are is unlike them.  Half of the labelled rows grow
the trees.  The threshold is the score that has the greatest difference between the share of bad rows it
rejects and the share of good rows it loses, both counted on the other half.

The forest is fitted in the driver on a bounded sample (``SAMPLE_ROWS`` labelled rows, least hashes of doc_id);
statistics and scores cover every row.  Null and empty texts have zero words and fail the rules.
Labels that repeat a doc_id count by the least quality; null labels are ignored.  Without good or bad labels, or with one
good row only, the rules alone decide.  Null ids have no label.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import words as W
from kindred.sources.staging import cut

LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8
SAMPLE_ROWS = 20_000
TREES = 200
TREE_ROWS = 256
DEPTH = 8
SEED = 11

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
PUNCT = np.zeros(256, bool)
PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_punct", "n_lines")


def _per_text(flags: np.ndarray, texts: W.Texts) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(flags)][texts.offsets])


def duplicate_lines(texts: W.Texts, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those of them that equal an earlier line."""
    n = len(texts)
    edge = np.zeros(len(texts.data) + 1, bool)
    edge[texts.offsets] = True
    breaks = np.flatnonzero(texts.data == 10)
    begin = np.unique(np.r_[texts.offsets[:-1], breaks + 1])
    begin = begin[begin < len(texts.data)]
    if not len(begin):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    end = np.r_[begin[1:], len(texts.data)]
    end = np.where((texts.data[end - 1] == 10) & (end > begin), end - 1, end)
    has_word = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end = begin[has_word], end[has_word]
    doc = np.searchsorted(texts.offsets, begin, side="right") - 1
    lines = np.bincount(doc, minlength=n)
    distinct = np.bincount(W.distinct_within(doc, W.span_hashes(texts.data, begin, end))[0], minlength=n)
    return lines, lines - distinct


def repeated_words(hashes: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text: words that lie in a window of words found twice or more in the text."""
    m = len(hashes) - window + 1
    covered = np.zeros(len(hashes) + 1, np.int64)
    if m > 0:
        owner = W.owner(bounds)
        with np.errstate(over="ignore"):
            total = np.zeros(m, W.U64)
            for k in range(window):
                total += hashes[k : k + m] * W.PLACE[k]
        at = np.flatnonzero(owner[:m] == owner[window - 1 :])
        doc, value = owner[at], total[at]
        order = W.sort_within(doc, value)
        same = (doc[order][1:] == doc[order][:-1]) & (value[order][1:] == value[order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = at[twice]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + window, -1)
    return np.diff(np.r_[0, np.cumsum(np.cumsum(covered)[:-1] > 0)][bounds])


def statistics(texts: W.Texts) -> dict[str, np.ndarray]:
    starts, ends, bounds = W.word_spans(texts)
    data = texts.data
    lines, repeated = duplicate_lines(texts, starts)
    lead = (data & 0xC0) != 0x80
    return {
        "n_words": np.diff(bounds),
        "word_chars": _per_text(lead & ~W.SPACE[data], texts),
        "n_symbols": _per_text(SYMBOLS[data], texts),
        "n_dup_lines": repeated,
        "n_repeat_words": repeated_words(W.span_hashes(data, starts, ends), bounds),
        "n_upper": _per_text(UPPER[data], texts),
        "n_digits": _per_text(DIGIT[data], texts),
        "n_punct": _per_text(PUNCT[data], texts),
        "n_lines": lines,
    }


def measured(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every row, with ``base_failed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in W.slices(batch, "text"):
                got = statistics(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *(pa.array(got[s].astype(np.int64)) for s in STATS)], names=["doc_id", *STATS]
                )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.mapInArrow(run, "doc_id long, " + ", ".join(f"{s} long" for s in STATS))
    return out.withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
    )


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Shares, on which the trees split.

    Word length counts by its logarithm and symbols up to one a word, so that a few extreme texts do not widen the box.
    """
    words, chars, lines = (np.maximum(stats[s], 1).astype(float) for s in ("n_words", "word_chars", "n_lines"))
    return np.stack(
        [
            np.log(chars / words),
            np.minimum(stats["n_symbols"] / words, 1),
            stats["n_dup_lines"] / lines,
            stats["n_repeat_words"] / words,
            stats["n_upper"] / chars,
            stats["n_digits"] / chars,
            stats["n_punct"] / chars,
        ],
        axis=1,
    )


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    big = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Complete binary trees; a leaf above the last depth has an infinite split."""

    column: np.ndarray
    split: np.ndarray
    path: np.ndarray
    rows: int
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 (common) to 1 (soon alone)."""
        total = np.zeros(len(x))
        at = np.arange(len(x))
        for column, split, path in zip(self.column, self.split, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[at, column[node]] >= split[node])
            total += path[node - (2**DEPTH - 1)]
        return 2.0 ** (-total / max(len(self.path), 1) / max(float(_mean_path(self.rows)), 1e-9))


def grow(x: np.ndarray, box: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    """Trees of samples of ``x``; ``box`` has the least and greatest value of each column, between which they split.

    Splits are drawn from the part of the box that a node covers, not from the values its rows have: what good rows never
    have lies beside them in an empty part with a short path.
    """
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    inner = 2**DEPTH - 1
    columns, splits = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    paths = np.zeros((trees, 2**DEPTH))
    for t in range(trees):
        held = {0: x[rng.choice(len(x), rows, replace=False)]}
        length, part = {0: 0.0}, {0: box}
        for node in range(inner):
            own, depth, (low, high) = held.pop(node), length.pop(node), part.pop(node)
            open_columns = np.flatnonzero(high > low)
            if len(own) > 1 and len(open_columns):
                c = int(rng.choice(open_columns))
                s = rng.uniform(low[c], high[c])
                columns[t, node], splits[t, node] = c, s
                right = own[:, c] >= s
                children, depth = (own[~right], own[right]), depth + 1
                below, above = np.array([low, high]), np.array([low, high])
                below[1, c] = above[0, c] = s
                parts = (below, above)
            else:
                children = (own, own)  # a leaf: both ways lead to the same path
                parts = (np.array([low, high]),) * 2
            for k, child in enumerate(children):
                held[2 * node + 1 + k], length[2 * node + 1 + k], part[2 * node + 1 + k] = child, depth, parts[k]
        for leaf in range(2**DEPTH):
            paths[t, leaf] = length[inner + leaf] + float(_mean_path(len(held[inner + leaf])))
    return Forest(columns, splits, paths, rows, np.inf)


def calibrate(forest: Forest, x: np.ndarray, good: np.ndarray) -> Forest:
    """Set the threshold with the greatest share of bad rows rejected less share of good rows lost, midway to the next lower score."""
    scores = forest.score(x)
    values = np.unique(scores)
    own, bad = np.sort(scores[good]), np.sort(scores[~good])
    if not len(own) or not len(bad):
        return forest
    lost = 1 - np.searchsorted(own, values) / len(own)
    rejected = 1 - np.searchsorted(bad, values) / len(bad)
    best = len(values) - 1 - int(np.argmax((rejected - lost)[::-1]))  # of equal ones the one that loses least
    if rejected[best] > lost[best]:
        forest.threshold = float(values[max(best - 1, 0) : best + 1].mean())
    return forest


def halves(good: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Which rows grow the trees: every other good and bad row in a random order; the others measure."""
    rng = np.random.default_rng(seed)
    grows = np.zeros(len(good), bool)
    for rows in (np.flatnonzero(good), np.flatnonzero(~good)):
        grows[rng.permutation(rows)[::2]] = True
    return grows


def fitted(x: np.ndarray, good: np.ndarray) -> Forest:
    grows = halves(good)
    measures = ~grows
    if (~good).sum() == 1:
        measures = measures | ~good  # a single bad row serves for both
    forest = grow(x[grows & good], np.array([x[grows].min(0), x[grows].max(0)]))
    return calibrate(forest, x[measures], good[measures])


def fit(stats: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Forest | None:
    """A forest from the bounded sample of labelled rows that the rules let pass."""
    known = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # Rows that repeat an id may be more than the sample's bound.
    got = stats.where("not base_failed").join(F.broadcast(known), "doc_id").orderBy("doc_id", *STATS).limit(rows).toPandas()
    good = got["quality"].to_numpy() == 1
    if not good.any() or good.all():
        return None
    return fitted(features({s: got[s].to_numpy() for s in STATS}), good)


def filtered(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics, ``base_failed``, ``score`` and ``kept`` of every row."""
    stats = cut(measured(documents))
    forest = fit(stats, labels, rows)
    if forest is None:
        return stats.withColumns({"score": F.lit(0.0), "kept": ~F.col("base_failed")})
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(features({s: batch.column(s).to_numpy() for s in STATS}))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    scored = stats.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema) + ", score double")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") < forest.threshold))
