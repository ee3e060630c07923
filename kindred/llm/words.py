"""Words, shingles and lines of Arrow text batches as NumPy arrays.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; only A-Z are lower-cased.
Hashes are 64 bits wide and depend on the bytes alone, so every task computes the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Text handled at once; a longer single text is still one slice.
SLICE_BYTES = 4 << 20
# Span of a positional hash; a word longer than this is hashed by itself.
PIECE_BYTES = 1 << 19

U64 = np.uint64
_SEED = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _stream(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(_SEED) + U64(seed))


SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUE = _stream(256, 1)
PLACE = _stream(64, 2) | U64(1)
BASE = 0xD6E8FEB86659FD93
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and its inverse modulo 2**64 for i up to n."""
    if n not in _powers:
        tables = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            out = np.ones(n + 1, U64)
            with np.errstate(over="ignore"):
                out[1:] = U64(base)
                np.multiply.accumulate(out, out=out)
            tables.append(out)
        _powers[n] = (tables[0], tables[1])
    return _powers[n]


@dataclass
class Texts:
    """Bytes of several texts end to end; ``offsets`` has one entry more than there are texts."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64))
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(data, offsets - offsets[0])


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut a batch into runs of rows with at most ``most`` bytes of text (one row at least)."""
    texts = texts_of(batch.column(batch.schema.get_field_index(column)))
    begin, n = 0, len(texts)
    while begin < n:
        end = int(np.searchsorted(texts.offsets, texts.offsets[begin] + most, side="right")) - 1
        end = min(n, max(end, begin + 1))
        low, high = texts.offsets[begin], texts.offsets[end]
        yield batch.slice(begin, end - begin), Texts(texts.data[low:high], texts.offsets[begin : end + 1] - low)
        begin = end


def word_spans(texts: Texts, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of words before each text (n + 1 entries).

    ``between`` tells which bytes separate words.
    """
    solid = ~between[texts.data]
    edge = np.zeros(len(solid) + 1, bool)
    edge[texts.offsets] = True
    before = np.zeros(len(solid) + 1, bool)
    before[1:] = solid
    after = np.zeros(len(solid) + 1, bool)
    after[:-1] = solid
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, texts.offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash the byte spans, which are in order and do not overlap."""
    out = np.zeros(len(starts), U64)
    long = (ends - starts) > PIECE_BYTES
    for i in np.flatnonzero(long):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    power, inverse = _power_tables(2 * PIECE_BYTES)
    short = np.flatnonzero(~long)
    k = 0
    while k < len(short):
        low = starts[short[k]]
        stop = int(np.searchsorted(starts[short], low + PIECE_BYTES, side="right"))
        take = short[k:stop]
        piece = data[low : ends[take[-1]]]
        sums = np.zeros(len(piece) + 1, U64)
        np.cumsum(BYTE_VALUE[piece] * power[: len(piece)], out=sums[1:])
        a, b = starts[take] - low, ends[take] - low
        with np.errstate(over="ignore"):
            out[take] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(U64) * U64(_SEED))
        k = stop
    return out


def word_hashes(texts: Texts, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of words before each text."""
    starts, ends, bounds = word_spans(texts)
    data = LOWER[texts.data] if lower else texts.data
    return span_hashes(data, starts, ends), bounds


def owner(bounds: np.ndarray) -> np.ndarray:
    """Index of the text that each element belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int = 5, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Text index and hash of each run of ``width`` words.

    ``whole``: a text with fewer words, but at least one, gives the whole sequence as one.
    """
    counts = np.diff(bounds)
    doc = owner(bounds)
    with np.errstate(over="ignore"):
        n = max(0, len(hashes) - width + 1)
        total = np.zeros(n, U64)
        for k in range(width):
            total += hashes[k : k + n] * PLACE[k]
        inside = doc[:n] == doc[width - 1 : width - 1 + n] if n else np.zeros(0, bool)
        docs, values = [doc[:n][inside]], [mix(total[inside])]
        if whole:
            for size in range(1, width):
                which = np.flatnonzero(counts == size)
                if len(which):
                    at = bounds[which]
                    total = np.full(len(which), U64(size))
                    for k in range(size):
                        total += hashes[at + k] * PLACE[k]
                    docs.append(which)
                    values.append(mix(total))
    return np.concatenate(docs), np.concatenate(values)


def sort_within(doc: np.ndarray, *values: np.ndarray) -> np.ndarray:
    """Order of rows by text, then by the values in turn."""
    return np.lexsort((*reversed(values), doc))


def distinct_within(doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, in order of text and value."""
    order = sort_within(doc, values)
    doc, values = doc[order], values[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    return doc[first], values[first]


def signed(values: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
