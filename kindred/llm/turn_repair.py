"""Cheapest repair of the turn structure of conversations, by prefix-doubling path ranking.

A conversation's rows are read in order by an automaton: nothing said yet, after a system turn, after
a user's, after an assistant's.  At each row an edit leads on: Keep (cost 0, where the role fits),
Rerole to user or assistant (1), Delete (2, the only one for blank and duplicate rows); Insert (5) adds
a turn without using a row; an undeleted truncated row costs 5 more.  The output must have the role
initials ``(s?(ua)+)?``.

Order of the rows: conversation, turn (nulls first), then role and SHA-256 of the text as given;
equal rows are interchangeable.  They are dealt in that order into blocks of even size, so a
conversation of any length is cut into segments:

* a segment of a cut conversation gives its cost from each state to each state; these small tables,
  one a segment, are put together from the end;
* a cost DP then runs backward through each segment from the cost that is left after it;
* the nodes (row, state) on optimal arcs are ranked by the first 1, 2, 4, ... letters of their
  audits, each rank from the ranks of the node and of the one its doubled pointer leads to.  A
  letter leads from a node to one node only, so the doubled pointers are unique.  Where audits
  tie in cost the ASCII-least one is the path of least letters; nodes of equal rank have equal audits, which are
  spelt once, through the doubled pointers;
* segments of cut conversations do so for each state they may be entered in, and are then chained.

Texts are not part of this: rows travel with a code of their role and faults.  ``repaired_turns`` joins the edits
back to them, and ``digests`` streams each conversation through one hash (a SHA-256 cannot be split).

Nulls in role and text count as one space, null turns come first, null conv_id is a conversation.
Extra columns are ignored.  An empty table gives empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.sources.staging import cut, small

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
# States: nothing yet, after system, after user, after assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INSERT, REROLE, DELETE, TRUNCATED = 5, 1, 2, 5
FAR = 1 << 50
# State after a turn of a user or assistant that the grammar wants next.
TURN = (USER, USER, ASSISTANT, USER)
# State after a kept row, by state and role code (0 other, 1 s, 2 u, 3 a).
KEPT = {(NOTHING, 1): SYSTEM, (NOTHING, 2): USER, (SYSTEM, 2): USER, (USER, 3): ASSISTANT, (ASSISTANT, 2): USER}
LETTERS = "DIKR"  # in ASCII order; letter 0 is the end
# Pairs of neighbouring role codes that are legal: su, ua, au.
LEGAL = np.zeros((4, 4), bool)
LEGAL[1, 2] = LEGAL[2, 3] = LEGAL[3, 2] = True
# Rows held at once, unless one segment has more.
ROWS_AT_ONCE = 1 << 16
FORCED, CUT_SHORT = 4, 8  # bits of a row's code, beside the role code


# --- rows in order -------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The query's damage, by crc32 of ``conv_id:turn`` modulo 20; ``copy`` numbers repeated rows."""

    def filled(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("fault <> 0").select(
        "conv_id",
        "turn",
        F.struct(F.col("role").alias("role"), F.sha2("text", 256).alias("text")).alias("given"),
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def in_order(rows: DataFrame, blocks: int | None = None) -> DataFrame:
    """Rows ``(conv_id, turn, given, role, text)`` as ``(block, at, conv_id, turn, role, text, code, same)``, written.

    ``code``: role code and fault bits without duplicates; ``same``: digest of role and text, null where blank.
    """
    solid = F.rtrim(F.col("text"), F.lit(WHITE))
    role = F.substring("role", 1, 1)
    code = F.when(role == "s", 1).when(role == "u", 2).when(role == "a", 3).otherwise(0)
    # Equal rows differ by their place in the input, so that many of them can be parted.
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "given", "place"]
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(blocks, *keys) if blocks else placed.repartitionByRange(*keys)
    ordered = dealt.sortWithinPartitions(*keys).select(
        F.spark_partition_id().alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "conv_id",
        "turn",
        "role",
        "text",
        code.alias("role_code"),
        (solid == "").alias("blank"),
        F.right(solid, F.lit(1)).isin(".", "!", "?").alias("ended"),
        F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256).alias("same"),
    )
    return cut(ordered)


def faults(ordered: DataFrame) -> DataFrame:
    """``(block, at, conv_id, turn, role_code, fault)`` of each row, ``fault`` its first one or null."""
    light = ordered.select("block", "at", "conv_id", "turn", "role_code", "blank", "ended", "same")
    # The first row of each wording, found with partial aggregation and met by its place: no hot key.
    first = light.where("not blank").groupBy("conv_id", "same").agg(F.min(F.struct("block", "at")).alias("first"))
    new = first.select(F.col("first.block").alias("block"), F.col("first.at").alias("at"), F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(~F.col("ended"), "truncated")
    return light.join(new, ["block", "at"], "left").select("block", "at", "conv_id", "turn", "role_code", fault.alias("fault"))


# --- the DP and the ranking ----------------------------------------------------


class Steps:
    """Backward steps of the cost DP, remembered by row code and relative costs ahead.

    Costs ahead differ by a few edits at most, so there are few different steps.
    """

    def __init__(self) -> None:
        self.known: dict[tuple[int, tuple[int, ...]], tuple[int, int, tuple[int, ...]]] = {}
        self.letter: list[list[int]] = []
        self.state: list[list[int]] = []

    def back(self, code: int, ahead: tuple[int, ...]) -> tuple[int, int, tuple[int, ...]]:
        """Number of the step, least cost before the row, and costs relative to it."""
        key = (code, ahead)
        if key not in self.known:
            role, extra = code & 3, TRUNCATED if code & CUT_SHORT else 0
            ways: list[list[tuple[int, int, int]]] = []  # cost, letter, state
            for q in range(4):
                own = [(DELETE + ahead[q], 1, q)]
                if not code & FORCED:
                    if (q, role) in KEPT:
                        own.append((extra + ahead[KEPT[q, role]], 3, KEPT[q, role]))
                    own.append((REROLE + extra + ahead[TURN[q]], 4, TURN[q]))
                ways.append(own)
            cost = with_inserts([min(w)[0] for w in ways])
            letters, states = [], []
            for q in range(4):
                own = [*ways[q], (INSERT + cost[TURN[q]], 2, TURN[q])]
                letter, state = min((x, t) for c, x, t in own if c == cost[q])
                letters.append(letter if cost[q] < FAR else 0)
                states.append(state if cost[q] < FAR else q)
            least = min(cost)
            self.letter.append(letters)
            self.state.append(states)
            self.known[key] = (len(self.letter) - 1, least, tuple(min(c - least, FAR) for c in cost))
        return self.known[key]


def with_inserts(cost: list[int]) -> list[int]:
    """Costs of the states at one place where turns may be inserted."""
    user, assistant = min(cost[USER], INSERT + cost[ASSISTANT]), min(cost[ASSISTANT], INSERT + cost[USER])
    return [min(cost[NOTHING], INSERT + user), min(cost[SYSTEM], INSERT + user), user, assistant]


AT_END = tuple(with_inserts([0, FAR, FAR, 0]))


def _backward(codes: bytes, ahead: tuple[int, ...], steps: Steps) -> tuple[list[int], list[int]]:
    """Step of each row, and the cost from each state before the first."""
    least = min(ahead)
    rest = tuple(min(a - least, FAR) for a in ahead)
    out, back = [0] * len(codes), steps.back
    for i in range(len(codes) - 1, -1, -1):
        out[i], more, rest = back(codes[i], rest)
        least += more
    return out, [min(least + r, FAR) for r in rest]


def costs_across(codes: bytes) -> list[int]:
    """Cost from each state before the rows to each state after them, 16 numbers."""
    steps, columns = Steps(), []
    for q in range(4):
        columns.append(_backward(codes, tuple(0 if t == q else FAR for t in range(4)), steps)[1])
    return [columns[t][q] for q in range(4) for t in range(4)]


def ranked(letter: np.ndarray, pointer: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Rank of each node by its whole audit, the audit's length, and the doubled pointers."""
    rank, length, doubled = letter.astype(np.int64), (letter > 0).astype(np.int64), [pointer]
    while (doubled[-1] != doubled[-1][doubled[-1]]).any():
        p = doubled[-1]
        # Audits of twice the length: by the first half, then by the second.
        rank = np.unique(rank * (rank.max() + 1) + rank[p], return_inverse=True)[1]
        length = length + length[p]
        doubled.append(p[p])
    p = doubled[-1]
    rank = np.unique(rank * (rank.max() + 1) + rank[p], return_inverse=True)[1]
    return rank, length, doubled


def walk(starts: np.ndarray, lengths: np.ndarray, doubled: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``(path, node)`` of every step of the paths, by doubled pointers."""
    path = np.repeat(np.arange(len(starts)), lengths)
    step = np.arange(len(path)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    node = starts[path]
    for k, p in enumerate(doubled):
        on = (step >> k) & 1 == 1
        node[on] = p[node[on]]
    return path, node


def repair(codes: np.ndarray, bounds: np.ndarray, ahead: list[tuple[int, ...]], last: np.ndarray, head: np.ndarray) -> dict[str, np.ndarray | list]:
    """Edits of segments, each from the states it may be entered in.

    Segment i has the rows ``bounds[i]`` to ``bounds[i + 1]``; ``ahead``: cost from each state after it;
    ``last``, ``head``: it ends, or begins, its conversation.
    """
    steps, which, costs = Steps(), [], []
    raw = codes.astype(np.uint8).tobytes()
    for i in range(len(bounds) - 1):
        own, cost = _backward(raw[bounds[i] : bounds[i + 1]], ahead[i], steps)
        which += own
        costs.append(cost)
    # Nodes: four at each row, and four after each segment.
    segment = np.repeat(np.arange(len(last)), np.diff(bounds))
    place = np.arange(len(codes)) + segment
    after = bounds[1:] + np.arange(len(last))
    n = len(codes) + len(last)
    letter, pointer = np.zeros((n, 4), np.int64), np.arange(4 * n).reshape(n, 4)
    letter[place] = np.array(steps.letter, np.int64).reshape(-1, 4)[which]
    state = np.array(steps.state, np.int64).reshape(-1, 4)[which]
    pointer[place] = 4 * (place[:, None] + np.isin(letter[place], (1, 3, 4))) + state
    for q in (SYSTEM, USER):  # what the grammar still wants at the end is inserted
        letter[after[last], q] = 2
        pointer[after[last], q] = 4 * after[last] + TURN[q]
    letter, pointer = letter.reshape(-1), pointer.reshape(-1)
    rank, length, doubled = ranked(letter, pointer)

    owner = np.repeat(np.arange(len(last)), np.where(head, 1, 4))
    entry = np.arange(len(owner)) - np.repeat(np.cumsum(np.where(head, 1, 4)) - np.where(head, 1, 4), np.where(head, 1, 4))
    starts = 4 * (bounds[:-1] + np.arange(len(last)))[owner] + entry
    # Equal ranks are equal audits: each is spelt once.
    _, one, spelt = np.unique(rank[starts], return_index=True, return_inverse=True)
    path, node = walk(starts[one], length[starts[one]], doubled)
    text = np.frombuffer(("." + LETTERS).encode(), np.uint8)[letter[node]].tobytes().decode()
    ends = np.cumsum(length[starts[one]])
    audits = [text[e - size : e] for e, size in zip(ends.tolist(), length[starts[one]].tolist(), strict=True)]
    path, node = walk(starts, length[starts], doubled)
    row_of = np.full(n, -1, np.int64)
    row_of[place] = np.arange(len(codes))
    step_letter = letter[node]
    made = np.isin(step_letter, (2, 4))  # inserted or reroled
    return {
        "segment": owner,
        "entry": entry,
        "exit": doubled[-1][starts] & 3,
        "cost": np.array(costs, np.int64)[owner, entry],
        "audit": [audits[k] for k in spelt.tolist()],
        "length": length[starts],
        "step_row": np.where(step_letter == 2, -1, row_of[node // 4]),
        "step_letter": step_letter,
        "step_role": np.where(made, np.array(TURN)[node & 3], 0),
    }


# --- the job -------------------------------------------------------------------

CODED = "block int, at long, conv_id {kind}, code int, starts boolean, head boolean, tail boolean, ahead array<long>"
SEGMENT = (
    "block int, conv_id {kind}, at long, entry int, exit int, cost long, audit string, illegal long, opens int, closes int,"
    " steps array<struct<at: long, letter: int, role: int>>"
)


def _segment_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole segments, about ``ROWS_AT_ONCE`` rows each."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if rows >= ROWS_AT_ONCE:
            begins = np.flatnonzero(batch.column("starts").to_numpy(zero_copy_only=False))
            if len(begins):
                yield pa.Table.from_batches([*held, batch.slice(0, begins[0])])
                batch, held, rows = batch.slice(begins[0]), [], 0
        held.append(batch)
        rows += len(batch)
    if rows:
        yield pa.Table.from_batches(held)


def _repaired(coded: DataFrame, kind: str) -> DataFrame:
    """Each segment of each block from each state it may be entered in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _segment_runs(batches):
            table = table.combine_chunks()
            begins = np.flatnonzero(table.column("starts").to_numpy())
            bounds = np.r_[begins, len(table)]
            first = table.take(pa.array(begins))
            codes, at = table.column("code").to_numpy(), table.column("at").to_numpy()
            ahead = [AT_END if a is None else tuple(a) for a in first.column("ahead").to_pylist()]
            tail, head = first.column("tail").to_numpy(), first.column("head").to_numpy()
            got = repair(codes, bounds, ahead, tail, head)
            role = codes & 3
            wrong = np.r_[0, np.cumsum(~LEGAL[role[:-1], role[1:]])]  # among the pairs before each row
            own = got["segment"]
            ends = pa.array(np.r_[0, np.cumsum(got["length"])].astype(np.int32))
            row = got["step_row"]
            steps = pa.StructArray.from_arrays(
                [
                    pa.array(at[row], mask=row < 0) if len(row) else pa.array([], pa.int64()),
                    pa.array(got["step_letter"].astype(np.int32)),
                    pa.array(got["step_role"].astype(np.int32)),
                ],
                names=["at", "letter", "role"],
            )
            low, high = bounds[:-1][own], bounds[1:][own] - 1
            taken = first.take(pa.array(own)).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    taken.column("block").chunk(0), taken.column("conv_id").chunk(0), taken.column("at").chunk(0),
                    pa.array(got["entry"].astype(np.int32)), pa.array(got["exit"].astype(np.int32)), pa.array(got["cost"]),
                    pa.array(got["audit"], pa.string()), pa.array((wrong[high] - wrong[low]).astype(np.int64)),
                    pa.array(role[low].astype(np.int32)), pa.array(role[high].astype(np.int32)), pa.ListArray.from_arrays(ends, steps),
                ],
                names=["block", "conv_id", "at", "entry", "exit", "cost", "audit", "illegal", "opens", "closes", "steps"],
            )

    return coded.mapInArrow(run, SEGMENT.format(kind=kind))


def _cut_costs(rows: DataFrame) -> DataFrame:
    """``(block, at, across)`` of segments of cut conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _segment_runs(batches):
            begins = np.flatnonzero(table.column("starts").to_numpy())
            bounds = np.r_[begins, len(table)]
            raw = table.column("code").to_numpy().astype(np.uint8).tobytes()
            across = [costs_across(raw[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            first = table.take(pa.array(begins)).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [first.column("block").chunk(0), first.column("at").chunk(0), pa.array(across, pa.list_(pa.int64()))],
                names=["block", "at", "across"],
            )

    return rows.mapInArrow(run, "block int, at long, across array<long>")


def _costs_ahead(segments: DataFrame) -> DataFrame:
    """``(block, at, ahead)``: cost from each state after each segment of a cut conversation.

    A conversation has a row a block that it lies in.
    """
    import pandas as pd

    def back(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block", ascending=False)
        ahead, out = list(AT_END), []
        for across in frame["across"]:
            out.append(ahead)
            m = np.asarray(across, np.int64).reshape(4, 4)
            ahead = np.minimum((m + np.array(ahead)).min(axis=1), FAR).tolist()
        return pd.DataFrame({"block": frame["block"], "at": frame["at"], "ahead": out})

    return segments.groupBy("chain").applyInPandas(back, "block int, at long, ahead array<long>")


def _entered(cut_segments: DataFrame) -> DataFrame:
    """``(block, at, entry)``: the state in which each segment of a cut conversation is entered."""
    import pandas as pd

    def chained(frame: pd.DataFrame) -> pd.DataFrame:
        out, state = [], NOTHING
        for (block, at), own in frame.sort_values(["block", "entry"]).groupby(["block", "at"], sort=True):
            out.append((block, at, state))
            state = int(own.set_index("entry")["exit"][state])
        return pd.DataFrame(out, columns=["block", "at", "entry"])

    return cut_segments.groupBy("chain").applyInPandas(chained, "block int, at long, entry int")


def repaired_segments(told: DataFrame) -> DataFrame:
    """Segments with the edits that the cheapest, ASCII-least audit has in them, from ``faults``; written."""
    kind = told.schema["conv_id"].dataType.simpleString()
    # A row a conversation and block.
    spans = told.groupBy("conv_id", "block").agg(F.min("at").alias("at"), F.max("at").alias("to"))
    order = Window.partitionBy("conv_id").orderBy("block")
    whole = Window.partitionBy("conv_id")
    spans = cut(
        spans.select(
            "*",
            F.min("block").over(whole).alias("chain"),  # one conversation at most begins in a block and goes on beyond
            F.lag("block").over(order).isNull().alias("head"),
            F.lead("block").over(order).isNull().alias("tail"),
        )
    )
    code = F.col("role_code") + F.when(F.col("fault").isin("blank", "duplicate"), FORCED).when(F.col("fault") == "truncated", CUT_SHORT).otherwise(0)
    rows = told.select("block", "at", "conv_id", code.cast("int").alias("code"))
    parts = cut(spans.where("not (head and tail)"))
    n = parts.count()  # two a block at most
    ahead = parts.select("block", "at", F.lit(None).cast("array<long>").alias("ahead"))
    if n:
        edges = small(parts.select(F.col("block").alias("b"), F.col("at").alias("low"), "to"), n)
        inside = rows.join(edges, (F.col("block") == F.col("b")) & F.col("at").between(F.col("low"), F.col("to")))
        coded = inside.select("block", "at", "code", (F.col("at") == F.col("low")).alias("starts"))
        across = _cut_costs(coded.repartition("block").sortWithinPartitions("block", "at"))
        ahead = cut(_costs_ahead(parts.select("block", "at", "chain").join(across, ["block", "at"])))
    begins = spans.select("block", "at", F.lit(True).alias("starts"), "head", "tail").join(ahead, ["block", "at"], "left")
    coded = rows.join(begins, ["block", "at"], "left").select(
        "block", "at", "conv_id", "code", F.coalesce("starts", F.lit(False)).alias("starts"), "head", "tail", "ahead"
    )
    out = cut(_repaired(coded.repartition("block").sortWithinPartitions("block", "at"), kind))
    if not n:
        return out
    chained = out.join(small(parts.select("block", "at", "chain"), n), ["block", "at"]).select("chain", "block", "at", "entry", "exit")
    entered = cut(_entered(chained))
    real = small(entered.withColumnRenamed("entry", "real"), n)
    return out.join(real, ["block", "at"], "left").where("entry = coalesce(real, 0)").drop("real")


def reports(conversations: DataFrame, told: DataFrame, segments: DataFrame) -> DataFrame:
    """Counts, cost and audit of every conversation of ``conversations``."""

    def count(fault: str) -> Column:
        return F.count(F.when(F.col("fault") == fault, 1)).alias(fault)

    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    rows = told.groupBy("conv_id").agg(gaps.alias("gaps"), count("blank"), count("duplicate"), count("truncated"))
    before = F.lag("closes").over(Window.partitionBy("conv_id").orderBy("block"))
    pair = F.when(before.isNull() | F.array(before, "opens").isin([F.array(F.lit(x), F.lit(y)) for x, y in ((1, 2), (2, 3), (3, 2))]), 0).otherwise(1)
    parts = segments.select("conv_id", "block", "cost", "audit", (F.col("illegal") + pair).alias("illegal"))
    chained = parts.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"),
        F.min_by("cost", "block").alias("cost"),  # what is left from the first segment on
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda s: s["audit"]), "").alias("audit"),
    )
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    out = every.join(rows, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    out = out.join(chained, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"))


def repaired_turns(ordered: DataFrame, segments: DataFrame) -> DataFrame:
    """``(conv_id, block, step, role, text)``: the repaired conversations, in order of block and step."""
    edits = segments.select("block", "conv_id", F.posexplode("steps").alias("step", "edit")).select(
        "block", "conv_id", "step", F.col("edit.at").alias("at"), F.col("edit.letter").alias("letter"), F.col("edit.role").alias("made")
    )
    texts = ordered.select("block", "at", "role", "text")
    role = F.when(F.col("made") == USER, "user").when(F.col("made") == ASSISTANT, "assistant").otherwise(F.col("role"))
    return (
        edits.where("letter <> 1")
        .join(texts, ["block", "at"], "left")
        .select("conv_id", "block", "step", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    )


def digests(turns: DataFrame) -> DataFrame:
    """``(conv_id, sha256)`` of the newline-joined ``role:text`` of each conversation, read as a stream."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, open_ = None, None, False
        for batch in batches:
            names, out = batch.column("conv_id").to_pylist(), ([], [])
            for own, role, text in zip(names, batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                line = f"{role}:{text}".encode()
                if open_ and own == name:
                    state.update(b"\n")
                else:
                    if open_:
                        out[0].append(name)
                        out[1].append(state.hexdigest())
                    name, state, open_ = own, hashlib.sha256(), True
                state.update(line)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field("conv_id").type), pa.array(out[1], pa.string())], names=["conv_id", "sha256"])
            kept = batch.schema.field("conv_id").type
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array([name], kept), pa.array([state.hexdigest()])], names=["conv_id", "sha256"])

    sorted_ = turns.repartition("conv_id").sortWithinPartitions("conv_id", "block", "step").select("conv_id", "role", "text")
    return sorted_.mapInArrow(run, f"conv_id {kind}, sha256 string")


def repaired(conversations: DataFrame, rows: DataFrame, blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Reports of all of ``conversations``, and the repaired turns of ``rows``.

    ``rows`` are the conversations' rows as ``damaged`` gives them.
    """
    ordered = in_order(rows, blocks)
    told = cut(faults(ordered))
    segments = cut(repaired_segments(told))
    return reports(conversations, told, segments), repaired_turns(ordered, segments)
