"""Centroid clustering, packing and conversation repair against plain restatements."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from kindred.llm import binary_packing as BP
from kindred.llm import centroid_clusters as CC
from kindred.llm import queries as Q
from kindred.llm import turn_repair as TR
from kindred.llm.oracles import OP13
from kindred.sources.staging import staged_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# --- centroid clustering -------------------------------------------------------


def plain_clusters(rows, k, rounds, width, seed=2):
    kept = [
        (i, [math.floor(256 * x) for x in e])
        for i, e in rows
        if e is not None and len(e) == width and all(x is not None and math.isfinite(x) and abs(x) < CC.LARGEST for x in e)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "~", r[1]))
    centres = [list(x) for _, x in order[:k]]

    def best(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        near = [best(x)[1] for _, x in kept]
        for j in range(len(centres)):
            own = [x for (_, x), n in zip(kept, near, strict=True) if n == j]
            if own:
                centres[j] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    told = [(i, *reversed(best(x))) for i, x in kept]
    by = {j: sum(d for _, n, d in told if n == j) for j in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, by[n], sum(by.values()), digest[n]) for i, n, d in told), key=repr)


def vectors(spark, rows, extra=False):
    df = spark.createDataFrame([(i, e) for i, e in rows], "vec_id long, embedding array<double>")
    return df.withColumns({c: F.lit(1) for c in ("x", "rotated", "cluster", "distance", "inertia", "v0", "line")}) if extra else df


def test_clusters_match_plain_rounds(spark):
    draw = random.Random(5)
    middles = [[draw.uniform(-1, 1) for _ in range(8)] for _ in range(4)]
    rows = [(i, [m + draw.gauss(0, 0.2) for m in draw.choice(middles)]) for i in range(300)]
    same = [0.25] * 8
    rows += [(1000 + i, same) for i in range(150)]  # a third are equal
    rows += [(7, rows[3][1]), (None, rows[4][1]), (None, rows[4][1])]  # repeated and missing ids
    rows += [(2000, None), (2001, [0.1] * 7), (2002, [None] + [0.1] * 7), (2003, [math.nan] * 8), (2004, [math.inf] * 8), (2005, [1e9] * 8)]
    got, centres = CC.clusters(vectors(spark, rows, extra=True), k=9, rounds=3, width=8)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_clusters(rows, 9, 3, 8)
    assert centres.shape == (9, 8)


def test_clusters_with_ties_and_few_vectors(spark):
    rows = [(i, [float(i % 2), -float(i // 2 % 2)]) for i in range(40)]
    assert sorted((tuple(r) for r in CC.clusters(vectors(spark, rows), k=12, rounds=2, width=2)[0].collect()), key=repr) == plain_clusters(rows, 12, 2, 2)
    few = rows[:3]
    assert sorted((tuple(r) for r in CC.clusters(vectors(spark, few), k=12, rounds=5, width=2)[0].collect()), key=repr) == plain_clusters(few, 12, 5, 2)
    empty, centres = CC.clusters(vectors(spark, []), k=12, width=2)
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert empty.count() == 0 and len(centres) == 0


def test_few_distances_are_measured():
    draw = np.random.default_rng(3)
    middles = draw.normal(0, 300, (20, 64))
    x = np.floor(middles[draw.integers(0, 20, 2000)] + draw.normal(0, 40, (2000, 64))).astype(np.int64)
    centres = np.floor(middles).astype(np.int64)
    variance, axes = np.linalg.eigh(np.cov(x.T))
    turned = CC.Rotation(x.mean(0), axes[:, ::-1], 12)
    number, distance, measured = CC.nearest(x, turned.apply(x.astype(float)), centres, turned.apply(centres.astype(float)))
    plain = ((x[:, None] - centres) ** 2).sum(2)
    assert (number == plain.argmin(1)).all() and (distance == plain.min(1)).all()
    assert measured < 1.2 * len(x)  # of 20 a vector


# --- packing -------------------------------------------------------------------


def test_pieces_are_binary():
    sizes = np.array([1, 2, 3, 4095, 4096, 4097, 10000, 7])
    doc, start, length = BP.binary_pieces(sizes)
    for i, n in enumerate(sizes.tolist()):
        own = length[doc == i].tolist()
        assert sum(own) == n and own == sorted(own, reverse=True)
        assert start[doc == i].tolist() == np.cumsum([0, *own[:-1]]).tolist()
        small = [x for x in own if x < 4096]
        assert len(small) == len(set(small)) and all(x & (x - 1) == 0 for x in own)


@pytest.mark.parametrize("longest", [4096, 16])
def test_packing_round_trip(spark, longest):
    draw = random.Random(9)
    texts = [" ".join(draw.choice(["alpha", "Beta!", "gamma,", "été", "数据", "x1y2"]) for _ in range(draw.randint(0, 60))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (5, "other"), (None, "no id"), (70, None), (71, ""), (72, "word " * 30_000)]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, part int, number int, length int").repartition(5)
    path = staged_path(spark, "packed")
    BP.write_packed(docs, path, TOKENIZER, longest)
    got = BP.read_packed(spark, path).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = sorted(([i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows), key=repr)
    whole = []
    for r in sorted(got, key=lambda r: r.start):
        assert r.offset == 0 and len(r.ids) == 4 * r.length and r.length & (r.length - 1) == 0 and r.length <= longest
        ids = np.frombuffer(r.ids, "<u4").tolist()
        if r.start == 0:
            whole.append([r.doc_id, r.doc_tokens, ids])
        else:
            near = [w for w in whole if w[0] == r.doc_id and w[1] == r.doc_tokens and len(w[2]) == r.start]
            near[0][2] += ids
    assert all(len(w[2]) == w[1] for w in whole)
    assert sorted(([w[0], *w[2]] for w in whole), key=repr) == want
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    by_number = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert by_number == sorted(by_number)


def test_packing_without_documents(spark):
    path = staged_path(spark, "packed")
    BP.write_packed(spark.createDataFrame([], "doc_id long, text string"), path, TOKENIZER)
    assert BP.read_packed(spark, path).count() == 0
    with pytest.raises(ValueError):
        BP.pieces(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER, longest=100)


# --- conversation repair -------------------------------------------------------

WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] if r[2] is not None else " ", hashlib.sha256((r[3] if r[3] is not None else " ").encode()).hexdigest())):
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        out += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def plain_repair(rows):
    """Least (cost, audit) over all edits, with the turns it gives, by states of the grammar."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = text.strip(WHITE)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    following = {"": "su", "s": "u", "u": "a", "a": "u"}

    def push(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, turns) in list(table.items()):
                for role in ("user", "assistant"):
                    if role[0] in following[state]:
                        push(table, role[0], (cost + 5, audit + "I", [*turns, f"{role}:"]))
        return table

    here = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        nxt = {}
        for state, (cost, audit, turns) in here.items():
            push(nxt, state, (cost + 2, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1] and role[:1] in following[state]:
                push(nxt, role[0], (cost + more, audit + "K", [*turns, f"{role}:{text}"]))
            for new in ("user", "assistant"):
                if new[0] in following[state]:
                    push(nxt, new[0], (cost + more + 1, audit + "R", [*turns, f"{new}:{text}"]))
        here = inserted(nxt)
    cost, audit, turns = min(here[s] for s in ("", "a") if s in here)
    numbers = [t for t, _, _ in rows if t is not None]
    pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:], strict=False)]
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest(),
    )


def made_conversations(seed=4):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(120), None]:
        for turn in range(draw.randint(1, 9)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = draw.choice(["Yes.", "No!", "why?", "cut", " \n", "", None, "Long answer. ", f"t{turn}.", "a "])
            rows.append((conv, draw.choice([turn, turn, turn, None, draw.randint(-3, 20)]), role, text))
    long = [(500, t, ("user", "assistant")[t % 2] if draw.random() < 0.8 else "system", draw.choice([f"w{t}.", f"w{t}", "same.", ""])) for t in range(700)]
    return rows + long + [(501, 3, "user", "Again and again.")] * 300


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("blocks", [None, 1, 7, 40])
def test_repair_matches_plain_search(spark, blocks):
    rows = made_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    extra = df.withColumns({c: F.lit(1) for c in ("block", "at", "code", "same", "steps", "fault", "id", "copy", "given", "place")})
    report, turns = TR.repaired(extra, TR.damaged(extra), blocks)
    digest = {r.conv_id: r.sha256 for r in TR.digests(turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    got = {r.conv_id: (*list(r)[1:], digest.get(r.conv_id, empty)) for r in report.collect()}
    want = {c: plain_repair(plain_damage(own)) for c, own in by_conversation(rows).items()}
    assert got.keys() == want.keys()
    assert {c: (got[c], want[c]) for c in got if got[c] != want[c]} == {}


def test_sql_twin_of_the_repair_matches_plain_search():
    rows = made_conversations(seed=11)
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", pa.Table.from_pandas(frame, preserve_index=False))
    got = {r[0]: tuple(r[1:]) for r in con.execute(OP13).fetchall()}
    assert got == {c: plain_repair(plain_damage(own)) for c, own in by_conversation(rows).items()}


def test_repair_without_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    report, turns = TR.repaired(empty, TR.damaged(empty))
    assert report.count() == 0 and turns.count() == 0 and TR.digests(turns).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    gone = spark.createDataFrame([(dropped, 0, "user", "Hello.")], empty.schema)
    report, turns = TR.repaired(gone, TR.damaged(gone))
    assert [tuple(r) for r in report.collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "")] and turns.count() == 0


def test_repair_query_on_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in Q.read(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in Q.op13_turn_repair(spark, sf).collect()}
    assert got == {c: plain_repair(plain_damage(own)) for c, own in by_conversation(rows).items()}


def test_long_conversation_costs_little():
    codes = bytes(random.Random(1).choice([1, 2, 3, 2 | TR.FORCED, 3 | TR.CUT_SHORT]) for _ in range(200_000))
    whole = TR.repair(np.frombuffer(codes, np.uint8), np.array([0, len(codes)]), [TR.AT_END], np.array([True]), np.array([True]))
    assert len(whole["audit"][0]) == whole["length"][0] >= len(codes)
    across = TR.costs_across(codes)
    assert whole["cost"][0] == min(across[q] + TR.AT_END[q] for q in range(4))
