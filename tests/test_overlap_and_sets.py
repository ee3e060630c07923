"""Overlap, item sets and rules against plain restatements."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.functions.text import tokens
from kindred.operators import decks, overlap, runs
from kindred.operators.candidates import candidates
from kindred.operators.decks import greedy_set
from kindred.operators.overlap import shared_phrases, similarity
from kindred.operators.rules import top_rules, triple_rules, triple_rules_mean
from kindred.plans.related import anchor_set, anchor_sets, related_items
from kindred.plans.upcoming import upcoming_recommendations
from kindred.sources import staging


def phrase_set(words):
    return {tuple(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)}


def sim(a, b):
    return len(phrase_set(a) & phrase_set(b)) / (len(b) * (len(b) + 1) / 2)


def random_texts(n, seed, letters="abc", longest=14):
    rng = random.Random(seed)
    return {i: [rng.choice(letters) for _ in range(rng.randint(1, longest))] for i in range(n)}


def words_frame(spark, texts, key="item_id"):
    return spark.createDataFrame(list(texts.items()), f"{key} long, tokens array<string>")


def test_worked_overlaps(spark):
    rows = [(1, "draw a card"), (2, "Draw a card, then discard a card."), (3, "a a")]
    items = spark.createDataFrame(rows, "item_id long, text string").select("item_id", tokens("text").alias("tokens"))
    found = {
        (r.anchor_id, r.item_id): r.sim
        for r in similarity(items.withColumnRenamed("item_id", "anchor_id"), items).collect()
    }
    assert found[1, 2] == 6 / 28 and found[2, 1] == 1.0 and found[3, 3] == pytest.approx(2 / 3)
    best = similarity(items.withColumnRenamed("item_id", "anchor_id"), items, top=1).collect()
    assert {(r.anchor_id, r.item_id) for r in best} == {(1, 1), (2, 1), (3, 3)}


@pytest.mark.parametrize("letters,longest", [("ab", 12), ("abcdefg", 40), ("a", 30)])
def test_overlap_equals_brute_force(spark, letters, longest):
    texts = random_texts(24, len(letters), letters, longest)
    items = words_frame(spark, texts)
    got = {
        (r.anchor_id, r.item_id): r.shared
        for r in shared_phrases(items.withColumnRenamed("item_id", "anchor_id"), items).collect()
    }
    want = {(a, b): len(phrase_set(x) & phrase_set(y)) for a, x in texts.items() for b, y in texts.items()}
    assert got == {k: v for k, v in want.items() if v}


def test_overlap_of_one_word_texts(spark):
    texts = {1: ["a"] * 1200, 2: ["a"] * 700}
    items = words_frame(spark, texts)
    got = {(r.anchor_id, r.item_id): r.shared for r in shared_phrases(items.withColumnRenamed("item_id", "anchor_id"), items).collect()}
    assert got == {(1, 1): 1200, (1, 2): 700, (2, 1): 700, (2, 2): 700}


def test_repeats_do_not_multiply(spark):
    """5,000 words of one, of two, and a passage ten times over: closed values, in seconds."""
    passage = [str(i) for i in range(499)] + ["."]
    texts = {1: ["a"] * 5000, 2: ["a", "b"] * 2500, 3: passage * 10}
    items = words_frame(spark, texts)
    begin = time.perf_counter()
    got = {(r.anchor_id, r.item_id): r.shared for r in shared_phrases(items.withColumnRenamed("item_id", "anchor_id"), items).collect()}
    assert time.perf_counter() - begin < 20
    # Of period d, a text of n words has d phrases of each length up to n - d + 1, then one less for each word more.
    of_period = {d: sum(min(d, 5000 - length + 1) for length in range(1, 5001)) for d in (1, 2, 500)}
    assert got == {(1, 1): of_period[1], (2, 2): of_period[2], (3, 3): of_period[500], (1, 2): 1, (2, 1): 1}


def test_runs_equal_brute_force():
    rng = random.Random(3)

    def made():
        return [rng.choice(letters) for _ in range(rng.randint(0, rng.choice([3, 12, 40])))]

    def code(words):
        return np.array([ord(w) << 33 | ord(w) for w in words], np.int64)

    for _ in range(300):
        letters = rng.choice(["a", "ab", "abc", "abcdefghij"])
        base = made()
        texts = [made() + rng.choice([[], base, base * 2, base * 3]) + made() for _ in range(4)]
        got = runs.shared(runs.Anchors.of([code(t) for t in texts[:3]]), code(texts[3])).tolist()
        assert got == [len(phrase_set(t) & phrase_set(texts[3])) for t in texts[:3]]


def test_overlap_beyond_the_broadcast_bound(spark, monkeypatch):
    from kindred.sources import staging

    monkeypatch.setattr(staging, "BROADCAST_ROW_BOUND", 0)
    texts = random_texts(10, 5)
    items = words_frame(spark, texts)
    got = shared_phrases(items.withColumnRenamed("item_id", "anchor_id"), items)
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().sparkPlan().toString()
    for r in got.collect():
        assert r.shared == len(phrase_set(texts[r.anchor_id]) & phrase_set(texts[r.item_id]))


def loop_set(texts, clusters, anchor, size, span, leave=True):
    """The set as a literal loop, one pick at a time."""
    deck, where = [(anchor, anchor, 1.0)], 0
    while where < len(clusters) and len(deck) < size:
        scorer = anchor if len(deck) <= span else deck[1][1]
        free = [i for i in clusters[where] if i not in {d[1] for d in deck}]
        if not free:
            where += 1
            continue
        pick = max(free, key=lambda i: (sim(texts[scorer], texts[i]), -i))
        deck.append((scorer, pick, sim(texts[scorer], texts[pick])))
        if leave and pick == clusters[where][-1]:
            where += 1
    return deck


@pytest.mark.parametrize("seed,leave", [(1, True), (2, True), (3, False)])
def test_greedy_set_equals_the_loop(spark, seed, leave):
    texts = random_texts(60, seed, longest=7)
    rng = random.Random(seed)
    pos = {i: rng.randint(0, 3) if leave else 0 for i in texts}
    clusters = [[i for i in sorted(texts) if pos[i] == c] for c in range(4 if leave else 1)]
    members = [
        (a, i, i, float(i), pos[i], len(texts[i]) * (len(texts[i]) + 1) // 2) for a in (0, 7) for i in texts
    ]
    frame = spark.createDataFrame(
        members, "anchor_id long, item_id long, ord long, rank double, cluster_pos int, n_phrases long"
    )
    deck = greedy_set(frame, words_frame(spark, texts), size=20, first_span=9, leave_clusters=leave).collect()
    for anchor in (0, 7):
        got = [(r.scorer_id, r.item_id, r.sim) for r in sorted(deck, key=lambda r: r.deck_pos) if r.anchor_id == anchor]
        assert got == loop_set(texts, clusters, anchor, 20, 9, leave)


def loop_triples(texts, deck, rank, term):
    ordered = sorted(deck, key=lambda d: rank[d[1]])
    out = {}
    for _, card, _ in deck:
        fits = [d for d in ordered if card not in (d[0], d[1])]
        best = max(fits, key=lambda d: sim(texts[d[0]], texts[card]), default=None)
        if best is None:
            out[card] = None
            continue
        s = sim(texts[(best if term == "best" else ordered[-1])[0]], texts[card])
        uses = sum(d[0] == best[0] for d in deck)
        n = len(texts[best[0]])
        out[card] = (best[0], best[1], (s + best[2]) / uses, (s + best[2]) / best[2] / (n * (n + 1) / 2) if best[2] else None)
    return out


def loop_triples_mean(texts, deck, rank, term):
    ordered = sorted(deck, key=lambda d: rank[d[1]])
    out = {}
    for _, card, _ in deck:
        best = max(ordered, key=lambda d: sim(texts[d[1]], texts[card]))
        told = best if term == "best" else ordered[-1]
        total = sim(texts[told[1]], texts[card]) + best[2]
        mean = sum(sim(texts[d[1]], texts[card]) for d in deck) / len(deck)
        out[card] = (told[0], told[1], total / mean if mean else None, total / best[2] if best[2] else None)
    return out


@pytest.mark.parametrize("term", ["best", "last"])
def test_triple_rules_equal_the_loop(spark, term):
    texts = random_texts(30, 11, longest=6)
    rank = {i: float(i % 5) for i in texts}
    deck = loop_set(texts, [sorted(texts)], 0, 14, 8)
    frame = spark.createDataFrame(
        [(0, p, s, i, v, rank[i], i) for p, (s, i, v) in enumerate(deck)],
        "anchor_id long, deck_pos int, scorer_id long, item_id long, sim double, rank double, ord long",
    )
    items = words_frame(spark, texts)
    for rules, loop in ((triple_rules, loop_triples), (triple_rules_mean, loop_triples_mean)):
        want = loop(texts, deck, rank, term)
        rows = rules(frame, items, term=term).collect()
        assert len(rows) == len(deck)
        assert [r.rule_pos for r in rows] == list(range(len(deck)))
        place = {i: p for p, (_, i, _) in enumerate(deck)}
        if rules is triple_rules:
            order = [(r.confidence is None, -(r.confidence or 0), place[r.card_id]) for r in rows]
        else:
            order = [(rank[r.card_id], place[r.card_id]) for r in rows]
        assert order == sorted(order)
        for r in rows:
            a, b, support, confidence = want[r.card_id] or (None,) * 4
            assert (r.r_anchor, r.r_item) == (a, b)
            assert r.support == (None if support is None else pytest.approx(support))
            assert r.confidence == (None if confidence is None else pytest.approx(confidence))
    names = spark.createDataFrame([(i, f"n{i}") for i in texts], "item_id long, name string")
    top = top_rules(triple_rules(frame, items), names, 5).collect()
    assert len(top) == 5 and all(r.card_id_name for r in top)


def test_candidates(spark):
    texts = ["z\\nA b, c", "A b, c", "A b,", "b,", "q\\nA b, c", "A b, c"]
    rows = [(i, i, "same" if i in (1, 5) else f"n{i}", t) for i, t in enumerate(texts)]
    related = spark.createDataFrame(rows, "item_id long, ord long, name string, text string")
    got = [(r.ord, r.name, r.paragraph, r.overlap) for r in candidates(related).collect()]
    assert got == [(0, "n0", "A b, c", 6), (1, "same", "A b, c", 6), (2, "n2", "A b,", 3), (4, "n4", "A b, c", 6)]
    assert candidates(related, limit=2).count() == 2


def test_jobs_end_to_end(spark):
    texts = random_texts(80, 21, "abcde", 8)
    rows = [
        (i, i, f"n{i}", " ".join(w), ["U"] if i % 3 else [], float(i * 7 % 80), "NEW" if i % 4 == 0 else "OLD", None, "t")
        for i, w in texts.items()
    ]
    items = spark.createDataFrame(
        rows,
        "item_id long, ord long, name string, text string, labels array<string>, rank double, setCode string, manaCost string, types string",
    )
    current, coming = items.where(F.col("setCode") == "OLD"), items.where(F.col("setCode") == "NEW")
    deck = anchor_set(items, "n1")
    assert deck.count() <= 63 and deck.where("deck_pos = 0").first().item_id == 1
    related = related_items(deck, current)
    ids = [r.item_id for r in related.collect()]
    assert 1 not in ids and all(i % 4 for i in ids)  # neither the anchor nor the other cohort
    recs = upcoming_recommendations(items, coming, related, "n1").collect()
    assert len(recs) == 10
    best = sorted(((-sim(texts[1], texts[i]), i) for i in texts if i % 4 == 0))[:10]
    assert [r.card_index for r in recs] == [i for _, i in best]
    legal = upcoming_recommendations(items, coming, related, "n3", legal_only=True).collect()
    assert all(r.card_index % 3 == 0 for r in legal)
    assert upcoming_recommendations(items, coming, related, "nobody").count() == 0


def test_many_anchors_equal_one_at_a_time(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(9)]
    kinds = [None, [], ["a"], ["b"], ["a", "b"], ["b", "a", "a"], [""], ["a", None]][:7]
    rows = [(i, i, f"n{i}", " ".join(rng.choice(words) for _ in range(rng.randint(1, 8))), rng.choice(kinds), rng.choice([None, float(rng.randint(1, 60))])) for i in range(160)]
    items = spark.createDataFrame(rows, "item_id long, ord long, name string, text string, labels array<string>, rank double")
    asked = [3, 17, 44, 90, 9999]
    many = anchor_sets(items, spark.createDataFrame([(a,) for a in asked], "anchor_id long"), clusters=4)
    got = {(r.anchor_id, r.deck_pos): (r.item_id, r.sim) for r in many.collect()}
    want = {}
    for a in asked[:-1]:
        want |= {(a, r.deck_pos): (r.item_id, r.sim) for r in anchor_set(items, f"n{a}", clusters=4).collect()}
    assert got == want and len({a for a, _ in got}) == 4
    found = related_items(many, items).collect()
    assert {(r.anchor_id, r.item_id) for r in found} == {(a, i) for (a, _), (i, _) in want.items() if i != a}


def test_pairs_of_many_anchors_are_not_broadcast(spark, monkeypatch):
    """Each anchor may share words with every item: past the row bound their pairs stay off the driver."""
    monkeypatch.setattr(staging, "BROADCAST_ROW_BOUND", 60)
    plans, walk = [], decks._ranked_walk

    def seen(scored, *rest):
        plans.append(scored._jdf.queryExecution().executedPlan().toString())
        return walk(scored, *rest)

    monkeypatch.setattr(decks, "_ranked_walk", seen)
    rng = random.Random(15)
    rows = [(i, i, " ".join(rng.choice("abcd") for _ in range(3)), [], float(i)) for i in range(80)]
    items = spark.createDataFrame(rows, "item_id long, ord long, text string, labels array<string>, rank double")
    found = anchor_sets(items, spark.createDataFrame([(a,) for a in (1, 2, 3, 9999)], "anchor_id long"))
    assert {r.anchor_id for r in found.select("anchor_id").distinct().collect()} == {1, 2, 3}
    joins = [j for p in plans for j in re.findall(r"(\w+Join) \[scorer_id#\d+L?, item_id#\d+L?\]", p)]
    assert joins and set(joins) == {"SortMergeJoin"}


def test_copies_of_a_text_are_compared_once(monkeypatch):
    calls = []
    monkeypatch.setattr(overlap, "shared", lambda a, own: calls.append(1) or runs.shared(a, own))
    texts = [np.array(t, np.int64) for t in ([1, 2, 3], [2, 3], [1, 2, 3], [9], [2, 3], [])]
    anchors = runs.Anchors.of([np.array([1, 2, 3], np.int64), np.array([3, 9], np.int64)])
    at, item, count, n = overlap._compared(anchors, texts, {})
    want = [(a, i, c, len(t)) for i, t in enumerate(texts) for a, c in enumerate(runs.shared(anchors, t)) if c]
    assert list(zip(at, item, count, n, strict=True)) == want and len(calls) == 4


def test_unknown_anchor_and_few_items(spark):
    rows = [(i, i, f"n{i}", t, [], float(i)) for i, t in enumerate(["a b", "a", "b c"])]
    items = spark.createDataFrame(
        rows, "item_id long, ord long, name string, text string, labels array<string>, rank double"
    )
    assert anchor_set(items, "nobody").count() == 0
    got = [r.item_id for r in anchor_set(items, "n0").orderBy("deck_pos").collect()]
    assert got == [0, 1, 2]
