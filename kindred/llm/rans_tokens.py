"""Token ids in a block format: static range asymmetric numeral system with interleaved lanes.

``write_tokens`` encodes whole texts with a public tokenizer, appends an end id to each and
writes blocks in ascending order of doc_id (null first, then by the text's hash):

* ``path/plain``: the ids as they are, until they are counted; a reader needs only the others;
* ``path/table``: ``id, count`` of every id in the corpus; scaled counts are the shared table;
* ``path/blocks``: one row a block of whole documents: place, documents, their lengths, CRC-32 of the
  payload and of the ids, and the payload.

A payload has ``LANES`` states that take the ids in turn and share one stream of 32-bit words.  It
starts with checkpoints (states and place in the stream at every ``STEPS`` rows of lanes), so a
decoder can start at any of them; blocks decode independently of each other.  Spark's
writers commit the files, so a lost task is written anew.

Null and empty texts have the end id only.  Rows that repeat an id follow each other.  An empty
table gives no blocks.  Extra columns are ignored.  A text longer than a block is a block.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from kindred.llm import words as W

SCALE = 20
LOW = np.uint64(1 << 31)
LANES = 1024
STEPS = 128
BLOCK_TOKENS = 1 << 18
END_ID = 1
# Words whose ids a worker remembers; beyond it forgets all and goes on.
REMEMBERED = 1_500_000
MAGIC = b"KRANS1"


# --- the code ----------------------------------------------------------------


class Table:
    """Counts scaled to 2**SCALE, their running sums, and the id at each place."""

    def __init__(self, counts: np.ndarray):
        total = int(counts.sum())
        f = np.where(counts > 0, np.maximum(1, counts.astype(object) * (1 << SCALE) // max(total, 1)), 0).astype(np.int64)
        spare = (1 << SCALE) - int(f.sum())
        if total and spare < 0:  # many ids were raised to 1: take it back from the largest
            for i in np.argsort(-f, kind="stable"):
                cut = min(-spare, int(f[i]) - 1)
                f[i] -= cut
                spare += cut
                if not spare:
                    break
        elif total:
            f[int(np.argmax(f))] += spare
        self.f = f.astype(np.uint64)
        self.c = np.r_[0, np.cumsum(f)[:-1]].astype(np.uint64)
        self.id_at = np.repeat(np.arange(len(f), dtype=np.uint32), f)


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, steps: int = STEPS) -> bytes:
    rows = -(-len(ids) // lanes)
    grid = np.full(rows * lanes, ids[-1] if len(ids) else 0, np.int64)
    grid[: len(ids)] = ids
    grid = grid.reshape(rows, lanes)
    x = np.full(lanes, LOW)
    words, written, marks = [], 0, []
    room, scale = np.uint64(63 - SCALE), np.uint64(SCALE)
    low32, by32 = np.uint64(0xFFFFFFFF), np.uint64(32)
    for t in range(rows - 1, -1, -1):
        f = table.f[grid[t]]
        full = (x >> room) >= f
        if full.any():
            out = x[full]
            words.append((out & low32).astype(np.uint32))
            written += len(out)
            x[full] = out >> by32
        q = x // f
        x = (q << scale) + (x - q * f) + table.c[grid[t]]
        if t % steps == 0:
            marks.append((written, x.copy()))
    head = struct.pack("<6sIIIII", MAGIC, len(ids), lanes, steps, len(marks), written)
    body = [head]
    for done, state in reversed(marks):
        body += [struct.pack("<I", written - done), state.astype("<u8").tobytes()]
    body += [w.astype("<u4").tobytes() for w in reversed(words)]
    return b"".join(body)


def decode_block(payload: bytes, table: Table, segment: int | None = None) -> np.ndarray:
    """The ids of a block, or of the rows after one checkpoint."""
    magic, n, lanes, steps, marks, written = struct.unpack_from("<6sIIIII", payload)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at, each, places, states = struct.calcsize("<6sIIIII"), 4 + 8 * lanes, [], []
    for k in range(marks):
        places.append(struct.unpack_from("<I", payload, at + k * each)[0])
        states.append(np.frombuffer(payload, "<u8", lanes, at + k * each + 4))
    words = np.frombuffer(payload, "<u4", written, at + marks * each).astype(np.uint64)
    rows = -(-n // lanes)
    first, last = (0, rows) if segment is None else (segment * steps, min(rows, (segment + 1) * steps))
    out = np.zeros((last - first, lanes), np.uint32)
    if rows:
        k = first // steps
        place, x = places[k], states[k].astype(np.uint64)
        scale, slots, by32 = np.uint64(SCALE), np.uint64((1 << SCALE) - 1), np.uint64(32)
        for t in range(first, last):
            slot = x & slots
            ids = table.id_at[slot]
            out[t - first] = ids
            x = table.f[ids] * (x >> scale) + slot - table.c[ids]
            need = x < LOW
            m = int(np.count_nonzero(need))
            if m:
                x[need] = (x[need] << by32) | words[place : place + m]
                place += m
        end = np.full(lanes, LOW) if last == rows else states[last // steps]
        if not np.array_equal(x, end):
            raise ValueError("token block does not decode")
    return out.reshape(-1)[: n - first * lanes]


# --- the tokenizer -----------------------------------------------------------

# Words that may be taken apart at changes between letters, single digits and other characters.
PLAIN = re.compile(rb"(?:[\x21-\x26\x28-\x7e]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
PIECES = re.compile(rb"[a-z\x80-\xff]+|[0-9]|[^a-z0-9\x80-\xff]+")
# Pieces encoded in one call.
CALL = 256


class TextEncoder:
    """Ids of texts by a public tokenizer.

    A tokenizer that marks ends of words and drops white space never joins across it, so
    each different word is encoded once and remembered (by a 64-bit hash); others get whole texts.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends_word = np.zeros(self.vocabulary, bool)
        if suffix:
            self.ends_word[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.starts, self.lengths, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _whole(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pieces without white space, many in a call; the marks of word ends part them."""
        out: list[list[int]] = []
        for k in range(0, len(pieces), CALL):
            own = pieces[k : k + CALL]
            ids = self._whole([b" ".join(own)])[0]
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(own) or ends[-1] != len(ids):
                out += self._whole(own)
                continue
            low = 0
            for high in ends.tolist():
                out.append(ids[low:high])
                low = high
        return out

    def _words(self, words: list[bytes]) -> list[list[int]]:
        parts = [PIECES.findall(w.lower()) if PLAIN.fullmatch(w) and b"<|" not in w else None for w in words]
        pieces = list({p for own in parts if own for p in own})
        ids = dict(zip(pieces, self._pieces(pieces), strict=True))
        odd = iter(self._whole([w for w, own in zip(words, parts, strict=True) if own is None]))
        return [next(odd) if own is None else ids[own[0]] if len(own) == 1 else [i for p in own for i in ids[p]] for own in parts]

    def _learn(self, texts: W.Texts, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        data = texts.data.tobytes()
        ids = self._words([data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.starts = np.insert(self.starts, at, len(self.pool) + np.cumsum(sizes) - sizes)
        self.lengths = np.insert(self.lengths, at, sizes)
        self.pool = np.r_[self.pool, flat]

    def encode(self, texts: W.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of ids of each text."""
        n = len(texts)
        if not self.by_word:
            data = texts.data.tobytes()
            ids = self._whole([data[a:b] for a, b in itertools.pairwise(texts.offsets.tolist())])
            sizes = np.fromiter(map(len, ids), np.int64, n)
            words = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        else:
            starts, ends, bounds = W.word_spans(texts)
            hashes, first, which = np.unique(W.span_hashes(texts.data, starts, ends), return_index=True, return_inverse=True)
            if len(self.known) + len(hashes) > REMEMBERED:
                self.forget()
            new = ~np.isin(hashes, self.known, assume_unique=True) if len(self.known) else np.ones(len(hashes), bool)
            if new.any():
                self._learn(texts, starts[first[new]], ends[first[new]], hashes[new])
            row = np.searchsorted(self.known, hashes)
            sizes = self.lengths[row][which]
            before = np.r_[0, np.cumsum(sizes)]
            words = self.pool[np.repeat((self.starts[row][which] - before[:-1]), sizes) + np.arange(before[-1])]
            sizes = np.diff(before[bounds])
        lengths = sizes + 1
        out = np.empty(len(words) + n, np.uint32)
        last = np.zeros(len(out), bool)
        last[np.cumsum(lengths) - 1] = True
        out[last] = self.end_id
        out[~last] = words
        return out, lengths


_encoders: dict[tuple[str, int], TextEncoder] = {}


def encoder(path: str, end_id: int) -> TextEncoder:
    """This worker's encoder; it remembers words from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = TextEncoder(path, end_id)
    return _encoders[path, end_id]


# --- the job -----------------------------------------------------------------

PLACE = "part int, block int, doc_ids array<long>, lengths array<long>, n_tokens long, ids_crc32 long"
BLOCK = PLACE + ", payload_crc32 long, payload binary"
_PLACE_FIELDS = [
    ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
]


def _blocks(docs: DataFrame, tokenizer_path: str, end_id: int, parts: int) -> DataFrame:
    """Blocks in order, with plain ids."""
    schema = pa.schema([*_PLACE_FIELDS, ("width", pa.int32()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, number = encoder(tokenizer_path, end_id), TaskContext.get().partitionId(), 0
        width = 2 if own.vocabulary <= 1 << 16 and end_id < 1 << 16 else 4
        names, sizes, held, n = [], [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate(held)
            row = {
                "part": part, "block": number, "doc_ids": list(names), "lengths": list(sizes), "n_tokens": len(ids),
                "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()), "width": width, "ids": ids.astype(f"<u{width}").tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for rows, texts in W.slices(batch, "text"):
                ids, lengths = own.encode(texts)
                at = 0
                for name, size in zip(rows.column(0).to_pylist(), lengths.tolist(), strict=True):
                    names.append(name)
                    sizes.append(size)
                    held.append(ids[at : at + size])
                    at += size
                    n += size
                    if n >= BLOCK_TOKENS:
                        yield block()
                        number += 1
                        names, sizes, held, n = [], [], [], 0
        if held:
            yield block()

    ordered = docs.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    )
    return ordered.mapInArrow(run, PLACE + ", width int, ids binary")


def _counts(blocks: DataFrame) -> DataFrame:
    """``(id, count)`` over the corpus; each task sends one row an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for width, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = np.bincount(np.frombuffer(ids.as_buffer(), f"<u{width}"), minlength=len(total))
                got[: len(total)] += total
                total = got
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "count"])

    return blocks.select("width", "ids").mapInArrow(run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def _table(counts: DataFrame) -> Table:
    """The scaled table; it has a row for each id of the vocabulary at most."""
    rows = counts.collect()
    out = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["count"]
    return Table(out)


def write_tokens(documents: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, parts: int | None = None) -> None:
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    plain = f"{path}/plain"
    _blocks(docs, tokenizer_path, end_id, parts or int(spark.conf.get("spark.sql.shuffle.partitions"))).write.option(
        "compression", "zstd"
    ).parquet(plain)
    blocks = spark.read.schema(PLACE + ", width int, ids binary").parquet(plain)
    # One row an id; only these, added up, meet in one task.
    _counts(blocks).repartition(1).write.parquet(f"{path}/table")
    table = spark.sparkContext.broadcast(_table(spark.read.schema("id long, count long").parquet(f"{path}/table")))
    schema = pa.schema([*_PLACE_FIELDS, ("payload_crc32", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                width, ids = batch.column("width")[row].as_py(), batch.column("ids")[row].as_buffer()
                payload = encode_block(np.frombuffer(ids, f"<u{width}"), table.value)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(row, 1) for k in range(6)), pa.array([zlib.crc32(payload)]), pa.array([payload])], schema=schema
                )

    blocks.mapInArrow(run, BLOCK).write.parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` of every document, decoded and checked.

    ``start``: ids before the document in the whole file; ``ids``: little-endian 32-bit.
    """
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    table = spark.sparkContext.broadcast(_table(spark.read.schema("id long, count long").parquet(f"{path}/table")))
    # One row a block, without the payloads.
    order = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    earlier = parts.select(
        "part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start")
    )
    places = (
        blocks.select("part", "block", "n_tokens")
        .withColumn("in_part", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
        .join(earlier, "part")
        .select("part", "block", (F.col("part_start") + F.col("in_part")).alias("block_start"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                payload = row["payload"]
                if zlib.crc32(payload) != row["payload_crc32"]:
                    raise ValueError(f"block {row['part']}/{row['block']} is damaged")
                raw = decode_block(payload, table.value).astype("<u4").tobytes()
                if zlib.crc32(raw) != row["ids_crc32"]:
                    raise ValueError(f"block {row['part']}/{row['block']} decodes to other ids")
                sizes = np.array(row["lengths"], np.int64)
                starts = np.cumsum(sizes) - sizes
                own = [raw[4 * a : 4 * (a + n)] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                columns = [
                    pa.array(np.full(len(sizes), row["part"], np.int32)),
                    pa.array(np.full(len(sizes), row["block"], np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts),
                    pa.array(sizes),
                    pa.array([zlib.crc32(x) for x in own], pa.int64()),
                ]
                names = ["part", "block", "doc_id", "in_block", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(own, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "part int, block int, doc_id long, in_block long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return (
        blocks.select("part", "block", "doc_ids", "lengths", "ids_crc32", "payload_crc32", "payload")
        .mapInArrow(run, schema)
        .join(places, ["part", "block"])
        .select("doc_id", (F.col("block_start") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
    )
