"""Near duplicates, decontamination and mixing against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from kindred.llm import decontaminate, jaccard_join, line_templates, mixing
from kindred.operators import components
from kindred.sources.staging import cut

DOCS = "doc_id long, text string, source string, component_id int, _size string"


def words_of(text):
    return (text or "").encode().lower().split()


def components_of(rows):
    sets = {}
    for i, text in rows:
        w = words_of(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    of = {i: i for i in sets}

    def top(i):
        while of[i] != i:
            i = of[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            common = len(sets[x] & sets[y])
            if x < y and common and 100 * common >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((top(x), top(y)))
                of[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = " ".join(rng.choice(vocabulary) for _ in range(14))
    texts = []
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((1, 3, 6, 12, 40, 120, 400)))]
        texts.append(" ".join(base))
        for _ in range(rng.choice((0, 0, 1, 4))):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(copy) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(line + "\n" + " ".join(copy) if rng.random() < 0.3 else " ".join(copy).upper())
    texts += [None, "", " \t\n", "one", "ONE", "a b c d", "x" * 700_000 + " y z", "é É ß", "w1 " * 3000]
    return list(enumerate(texts))


def test_near_duplicates(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, None, 7, "s") for i, t in rows], DOCS).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == components_of(rows)
    kept = {r.doc_id for r in jaccard_join.one_of_each(df).select("doc_id").collect()}
    assert kept == {i for i, (n, c) in got.items() if n == 0 or i == c}


def test_crowded_parts_wait(spark, monkeypatch):
    """Many documents share a long passage; some are near copies whose links cross the first stars."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(40):
        own = [f"d{i}x{k}" for k in range(30)] if i % 2 else [w if rng.random() > 0.05 else f"e{i}{w}" for w in base]
        rows.append((i, " ".join(passage + own)))
    monkeypatch.setattr(jaccard_join, "PARTS_AT_ONCE", 50)
    monkeypatch.setattr(jaccard_join, "WAITS_FROM", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == components_of(rows)


def test_near_duplicates_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, None)], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect())
    assert got == {(None, 2, None): 1, (4, 2, 4): 2, (9, 0, 9): 1}
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0


def test_ids_with_several_texts(spark):
    rows = [(2, "a b c d e f"), (4, "a b c d e f"), (4, "g h i j k l m"), (7, "g h i j k l m"), (9, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect())
    assert got == [(2, 2, 2), (4, 2, 2), (4, 3, 2), (7, 3, 2), (9, 1, 9)]


def test_links_found_later_contract_components_only(spark, monkeypatch):
    """Chains of near copies: rounds over the links of the first stars are not gone through again."""
    rng = random.Random(5)
    rows = []
    for chain in range(6):
        words = [f"c{chain}w{k}" for k in range(120)]
        for step in range(8):
            rows.append((10 * chain + step, " ".join(words)))
            words[5 * step : 5 * step + 3] = [f"c{chain}s{step}x{k}" for k in range(3)]
    # A passage that they share keeps documents of different components in the same parts through both rounds.
    passage = [f"p{k}" for k in range(100)]
    rows += [(100 + i, " ".join(passage + [f"d{i}x{k}" for k in range(60)])) for i in range(8)]
    rng.shuffle(rows)
    monkeypatch.setattr(jaccard_join, "WAITS_FROM", 4)
    written, write = [], components.cut
    monkeypatch.setattr(components, "cut", lambda df: written.append(len(written)) or write(df))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == components_of(rows)
    assert len(written) <= 12, len(written)


def test_merged_components(spark):
    def frame(pairs):
        return spark.createDataFrame(pairs, "a long, b long")

    found = jaccard_join._merged(None, frame([(5, 6), (6, 7), (1, 2), (20, 21), (30, 30)]))
    for new in ([(7, 9), (9, 8), (5, 6)], [(2, 8), (40, 41)], [(1, 9)]):
        found = jaccard_join._merged(found, frame(new))
    got = sorted((r.leader, r.component) for r in found.collect())
    assert got == [(1, 1), (2, 1), *((i, 1) for i in range(5, 10)), (20, 20), (21, 20), (40, 40), (41, 40)]


def test_large_texts_that_share_a_passage_leave_the_join_empty(spark, monkeypatch):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(900)]
    rows = [(i, " ".join(passage + [f"d{i}x{k}" for k in range(rng.choice([250, 1400, 2000]))])) for i in range(40)]
    met, across = [], jaccard_join._across
    monkeypatch.setattr(jaccard_join, "_across", lambda *a: met.append(cut(across(*a))) or met[-1])
    monkeypatch.setattr(jaccard_join, "WAITS_FROM", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == components_of(rows)
    few = len({c for _, c in got.values()})
    assert sum(m.count() for m in met) < 2 * few


@pytest.mark.parametrize("percent", [50, 60, 75, 90, 100])
def test_bounds_of_the_sketch(percent):
    """Linked sizes never differ in more than the bound, and both sides look far enough."""
    for a in range(1, 60):
        for b in range(a, 100 * a // percent + 1):
            need = -(-percent * (a + b) // (100 + percent))
            if need <= a:
                apart = a + b - 2 * need
                assert apart <= jaccard_join.most_apart(a, b, percent)
                assert apart <= jaccard_join.most_apart(a, 100 * a // percent, percent)


def test_hamming_is_a_lower_bound():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    for _ in range(30):
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        look = [jaccard_join._looks(np.zeros(len(x), np.int64), x, 1)[0].view(np.uint64) for x in (a, b)]
        assert int(np.bitwise_count(look[0] ^ look[1]).sum()) <= len(np.setxor1d(a, b))


def leaks_of(docs, items):
    out = {}
    for i, text in docs:
        w = [x.decode() for x in (text or "").lower().encode().split()]
        for j, item in items:
            v = [x.decode() for x in (item or "").lower().encode().split()]
            k = min(5, len(v))
            if not v or len(w) < k:
                continue
            target = Counter(tuple(v[s : s + k]) for s in range(len(v) - k + 1))
            for start in range(max(len(w) - len(v), 0) + 1):
                own = w[start : start + len(v)]
                window = Counter(tuple(own[s : s + k]) for s in range(len(own) - k + 1))
                common, most = sum((window & target).values()), sum((window | target).values())
                if 100 * common >= 75 * most:
                    out[i, j] = max(out.get((i, j), 0), common / most)
    return out


def test_leaks(spark):
    rng = random.Random(9)
    words = [f"t{i}" for i in range(200)]
    items = [(j, " ".join(rng.choice(words) for _ in range(size))) for j, size in enumerate((3, 6, 14, 20, 35, 59))]
    items += [(6, None), (7, " "), (8, "r r r r r r r r"), (None, "t1 t2 t3 t4 t5 t6")]
    docs = []
    for i in range(60):
        body = [rng.choice(words) for _ in range(rng.randrange(60))]
        item = (items[i % 6][1]).split()
        for _ in range(rng.randrange(3)):
            item[rng.randrange(len(item))] = "edit"
        if rng.random() < 0.3:
            item.insert(len(item) // 2, "more")
        at = rng.randrange(len(body) + 1)
        docs.append((i, " ".join(body[:at] + item + body[at:]).upper()))
    docs += [(90, None), (91, ""), (92, items[4][1][:-30]), (93, "r " * 50), (94, items[3][1]), (None, items[3][1])]
    a = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(a, b).collect()}
    want = leaks_of([d for d in docs if d[0] is not None], [x for x in items if x[0] is not None])
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    kept = {r.doc_id for r in decontaminate.without_leaks(a, b).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}
    assert decontaminate.leaks(a, b.limit(0)).count() == 0 and decontaminate.leaks(a.limit(0), b).count() == 0


def targets_of(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        share = (total - sum(held.values())) / max(sum(weight[s] for s in free), 1)
        over = [s for s in free if share * weight[s] > most * sizes[s]]
        if not over:
            return held | {s: share * weight[s] for s in free}
        held |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    rng = random.Random(seed)
    counts = {"a": 400, "b": 3, "c": 30, None: 50, "é": 1, "empty": 4, "Z": 60}
    rows, i = [], 0
    for source, n in counts.items():
        for _ in range(n):
            i += 1
            rows.append((i, source, None if source == "empty" else "w " * rng.randrange(60), 1))
    rows += [(1, *rows[0][1:3], 1), (None, "c", "x y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, taken int")
    got = mixing.mixture(df).collect()
    sizes = defaultdict(int)
    for _, s, t, _ in rows:
        sizes[s] += len((t or "").split())
    want = targets_of(sizes)
    taken, most = defaultdict(int), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r["_source_size"] == sizes[r.source] and abs(r["_target"] - want[r.source]) < 1e-6 * max(want[r.source], 1)
        assert 0 <= r["_copies"] <= 3
        taken[r.source] += r["_copies"] * r["_size"]
        most[r.source] = max(most[r.source], r["_size"])
    for s in counts:
        assert abs(taken[s] - want[s]) <= most[s] + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixture(df.repartition(5)).collect()))
    mixed = Counter(r.doc_id for r in mixing.mixed(df).collect())
    assert sum(mixed.values()) == sum(r["_copies"] for r in got)
    assert mixing.mixture(df.limit(0)).count() == 0


def test_line_templates(spark):
    rows = [(i, f"user {i} logged in from host{i}\n{chr(97 + i)} words of {i} own\n\nAll rights kept by the owner") for i in range(12)]
    rows += [(50, None), (51, ""), (52, "user 5 logged in from nowhere"), (53, "a line of its own")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, leaf string")
    got = {r.doc_id: (r.text, r["_lines"], r["_dropped"]) for r in line_templates.without_recurring_lines(df).collect()}
    for i in range(12):
        assert got[i] == (f"{chr(97 + i)} words of {i} own\n", 4, 2)
    assert got[50] == (None, 0, 0) and got[51] == ("", 1, 0)
    assert got[52] == ("", 1, 1) and got[53] == ("a line of its own", 1, 0)
    assert line_templates.without_recurring_lines(df.limit(0)).count() == 0


def plain_recurring(held):
    """Lines to drop of ``{line: ids of its documents}``."""

    def lead(t):
        return (len(t), *("<*>" if any(c.isdigit() for c in x) else x for x in t[:3]))

    leaves = defaultdict(list)
    for line in held:
        if line.split():
            leaves[lead(line.split())].append(line)
    gone = set()
    for where, lines in leaves.items():
        bound = 3 if where[0] >= 20 else 8
        exact = {x for x in lines if len(held[x]) >= bound}
        found, left = {}, lines
        while left:
            count = Counter()
            for x in left:
                count.update({(p, t): len(held[x]) for p, t in enumerate(x.split()) if p >= 3})
            for places, n in found.items():
                count.update(dict.fromkeys(places, n))
            of = {}
            for x in left:
                common = [(p, t) for p, t in enumerate(x.split()) if p >= 3 and count[p, t] >= bound]
                n = where[0] - 3
                needed = max(-(-n // 2), -(-where[0] // 2) - sum(t != "<*>" for t in where[1:]), 0)
                if len(common) >= needed:
                    least = sorted((count[c] for c in common), reverse=True)[needed - 1] if n > 0 else 0
                    of[x] = frozenset(c for c in common if count[c] >= least)
            docs = defaultdict(set)
            for x, places in of.items():
                docs[places] |= held[x]
            now = {k: len(d) for k, d in docs.items() if k in found or len(d) >= bound}
            found = now | found
            went = {x for x in of if of[x] in now}
            gone |= went
            if not went:
                break
            left = [x for x in left if x not in went and x not in exact]
        gone |= exact
    return gone


def test_templates_that_hide_each_other(spark):
    """Random lines of few words in one leaf, long lines in three documents, and clashing names."""
    rng = random.Random(11)
    rows = []
    for i in range(120):
        kind = rng.randrange(3)
        body = [["red", "green", "blue"][kind], *(rng.choice("pqrs") + rng.choice("12345678") for _ in range(3)), ["x", "y", "x"][kind]]
        lines = ["the same lead " + " ".join(body)]
        if i % 30 == 0:
            lines.append(" ".join(f"long{k}" if k != 9 else f"own{i}" for k in range(24)))
        if i % 50 == 1:
            lines.append(" ".join(f"rare{k}" for k in range(24)))
        rows.append((i, "\n".join(lines), 1, "k"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, _LINES int, _key string")
    out = line_templates.without_recurring_lines(docs)
    assert out.columns == ["doc_id", "text", "_key", "_lines", "_dropped"]
    held = defaultdict(set)
    for i, text, *_ in rows:
        for line in text.split("\n"):
            held[line].add(i)
    gone = plain_recurring(held)
    for r in out.collect():
        assert r.text == "\n".join(x for x in rows[r.doc_id][1].split("\n") if x not in gone)
    assert any(x.startswith("long0") for x in gone) and any(x.startswith("rare0") for x in gone)


def test_several_templates_of_a_leaf(spark):
    """Against the rounds told plainly: one template a line, the places of most documents; recurring ones and exact lines go."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(40):
        own = [f"d{i}x{k}" for k in range(30)] if i % 2 else [w if rng.random() > 0.05 else f"e{i}{w}" for w in base]
        rows.append((i, " ".join(passage + own)))
    monkeypatch.setattr(jaccard_join, "PARTS_AT_ONCE", 50)
    monkeypatch.setattr(jaccard_join, "WAITS_FROM", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == components_of(rows)


def test_near_duplicates_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, None)], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect())
    assert got == {(None, 2, None): 1, (4, 2, 4): 2, (9, 0, 9): 1}
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0


def test_ids_with_several_texts(spark):
    rows = [(2, "a b c d e f"), (4, "a b c d e f"), (4, "g h i j k l m"), (7, "g h i j k l m"), (9, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect())
    assert got == [(2, 2, 2), (4, 2, 2), (4, 3, 2), (7, 3, 2), (9, 1, 9)]


def test_large_texts_that_share_a_passage_leave_the_join_empty(spark, monkeypatch):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(900)]
    rows = [(i, " ".join(passage + [f"d{i}x{k}" for k in range(rng.choice([250, 1400, 2000]))])) for i in range(40)]
    met, across = [], jaccard_join._across
    monkeypatch.setattr(jaccard_join, "_across", lambda *a: met.append(cut(across(*a))) or met[-1])
    monkeypatch.setattr(jaccard_join, "WAITS_FROM", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == components_of(rows)
    few = len({c for _, c in got.values()})
    assert sum(m.count() for m in met) < 2 * few


@pytest.mark.parametrize("percent", [50, 60, 75, 90, 100])
def test_bounds_of_the_sketch(percent):
    """Linked sizes never differ in more than the bound, and both sides look far enough."""
    for a in range(1, 60):
        for b in range(a, 100 * a // percent + 1):
            need = -(-percent * (a + b) // (100 + percent))
            if need <= a:
                apart = a + b - 2 * need
                assert apart <= jaccard_join.most_apart(a, b, percent)
                assert apart <= jaccard_join.most_apart(a, 100 * a // percent, percent)


def test_hamming_is_a_lower_bound():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    for _ in range(30):
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        look = [jaccard_join._looks(np.zeros(len(x), np.int64), x, 1)[0].view(np.uint64) for x in (a, b)]
        assert int(np.bitwise_count(look[0] ^ look[1]).sum()) <= len(np.setxor1d(a, b))


def leaks_of(docs, items):
    out = {}
    for i, text in docs:
        w = [x.decode() for x in (text or "").lower().encode().split()]
        for j, item in items:
            v = [x.decode() for x in (item or "").lower().encode().split()]
            k = min(5, len(v))
            if not v or len(w) < k:
                continue
            target = Counter(tuple(v[s : s + k]) for s in range(len(v) - k + 1))
            for start in range(max(len(w) - len(v), 0) + 1):
                own = w[start : start + len(v)]
                window = Counter(tuple(own[s : s + k]) for s in range(len(own) - k + 1))
                common, most = sum((window & target).values()), sum((window | target).values())
                if 100 * common >= 75 * most:
                    out[i, j] = max(out.get((i, j), 0), common / most)
    return out


def test_leaks(spark):
    rng = random.Random(9)
    words = [f"t{i}" for i in range(200)]
    items = [(j, " ".join(rng.choice(words) for _ in range(size))) for j, size in enumerate((3, 6, 14, 20, 35, 59))]
    items += [(6, None), (7, " "), (8, "r r r r r r r r"), (None, "t1 t2 t3 t4 t5 t6")]
    docs = []
    for i in range(60):
        body = [rng.choice(words) for _ in range(rng.randrange(60))]
        item = (items[i % 6][1]).split()
        for _ in range(rng.randrange(3)):
            item[rng.randrange(len(item))] = "edit"
        if rng.random() < 0.3:
            item.insert(len(item) // 2, "more")
        at = rng.randrange(len(body) + 1)
        docs.append((i, " ".join(body[:at] + item + body[at:]).upper()))
    docs += [(90, None), (91, ""), (92, items[4][1][:-30]), (93, "r " * 50), (94, items[3][1]), (None, items[3][1])]
    a = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(a, b).collect()}
    want = leaks_of([d for d in docs if d[0] is not None], [x for x in items if x[0] is not None])
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    kept = {r.doc_id for r in decontaminate.without_leaks(a, b).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}
    assert decontaminate.leaks(a, b.limit(0)).count() == 0 and decontaminate.leaks(a.limit(0), b).count() == 0


def targets_of(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        share = (total - sum(held.values())) / max(sum(weight[s] for s in free), 1)
        over = [s for s in free if share * weight[s] > most * sizes[s]]
        if not over:
            return held | {s: share * weight[s] for s in free}
        held |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    rng = random.Random(seed)
    counts = {"a": 400, "b": 3, "c": 30, None: 50, "é": 1, "empty": 4, "Z": 60}
    rows, i = [], 0
    for source, n in counts.items():
        for _ in range(n):
            i += 1
            rows.append((i, source, None if source == "empty" else "w " * rng.randrange(60), 1))
    rows += [(1, *rows[0][1:3], 1), (None, "c", "x y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, taken int")
    got = mixing.mixture(df).collect()
    sizes = defaultdict(int)
    for _, s, t, _ in rows:
        sizes[s] += len((t or "").split())
    want = targets_of(sizes)
    taken, most = defaultdict(int), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r["_source_size"] == sizes[r.source] and abs(r["_target"] - want[r.source]) < 1e-6 * max(want[r.source], 1)
        assert 0 <= r["_copies"] <= 3
        taken[r.source] += r["_copies"] * r["_size"]
        most[r.source] = max(most[r.source], r["_size"])
    for s in counts:
        assert abs(taken[s] - want[s]) <= most[s] + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixture(df.repartition(5)).collect()))
    mixed = Counter(r.doc_id for r in mixing.mixed(df).collect())
    assert sum(mixed.values()) == sum(r["_copies"] for r in got)
    assert mixing.mixture(df.limit(0)).count() == 0


def test_line_templates(spark):
    rows = [(i, f"user {i} logged in from host{i}\n{chr(97 + i)} words of {i} own\n\nAll rights kept by the owner") for i in range(12)]
    rows += [(50, None), (51, ""), (52, "user 5 logged in from nowhere"), (53, "a line of its own")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, leaf string")
    got = {r.doc_id: (r.text, r["_lines"], r["_dropped"]) for r in line_templates.without_recurring_lines(df).collect()}
    for i in range(12):
        assert got[i] == (f"{chr(97 + i)} words of {i} own\n", 4, 2)
    assert got[50] == (None, 0, 0) and got[51] == ("", 1, 0)
    assert got[52] == ("", 1, 1) and got[53] == ("a line of its own", 1, 0)
    assert line_templates.without_recurring_lines(df.limit(0)).count() == 0


def test_several_templates_of_a_leaf(spark):
    """Against all sets of places: a line goes if it recurs, or if 8 documents agree with it on half of the tokens after its lead."""
    rng = random.Random(5)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.choice('klmnop')}{rng.choice('aeiou')}{rng.choice('rstuvw')}"
    notices = ["Click here to read our privacy notice now", "Click here to join the weekly mailing list", "Click here to see more posts like this"]
    rows = []
    for i in range(90):
        lines = [notices[i % 3]]
        lines += [f"Click here to {' '.join(word() for _ in range(5))}"]  # of this leaf, alike in the lead only
        if i % 5 == 0:
            lines += [f"Click here to reply as {word()} or {word()}"]
        if i % 40 == 0:
            lines += [f"Click here to read our {word()} notice now"]
        if i % 9 == 0:
            lines += ["Only twelve hold 7 x"[: 17 + i % 2], f"{i} {i} {i} all the same words"]
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_templates.without_recurring_lines(docs).collect()}
    held = {}
    for i, text in rows:
        for line in text.split("\n"):
            held.setdefault(line, set()).add(i)

    gone = plain_recurring(held)
    goes = gone.__contains__

    for i, text in rows:
        assert got[i] == "\n".join(x for x in text.split("\n") if not goes(x))
    assert goes(notices[0]) and not goes(rows[1][1].split("\n")[1])


def test_mix_without_ids_comes_near_its_targets(spark):
    """Equal rows without an id are taken one by one, and names of the results or helpers do not clash."""
    rows = [(None, s, "w w w w w", 7, "m", "r") for s, n in (("a", 200), ("b", 100)) for _ in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, _size int, _mark string, _row string").repartition(4)
    got = mixing.mixture(df)
    assert got.columns == ["doc_id", "source", "text", "_mark", "_row", "_size", "_source_size", "_target", "_copies"]
    taken, target = Counter(), {}
    for r in got.collect():
        taken[r.source] += r["_copies"] * r["_size"]
        target[r.source] = r["_target"]
    assert all(abs(taken[s] - target[s]) <= 5 for s in target)
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns and mixed.count() == sum(taken.values()) / 5
    again = Counter(map(str, mixing.mixture(df.repartition(3)).collect()))
    assert again == Counter(map(str, got.collect()))


def test_leaks_of_alternating_words(spark):
    """Items of few distinct shingles, whose SimHashes lie far apart, are found all the same; long repetitive texts end."""
    items = [(i, " ".join(f"{'ab'[k % 2]}{i}" for k in range(11))) for i in range(60)]
    docs = [(i, " ".join(f"{'ba'[k % 2]}{i}" for k in range(11))) for i in range(60)] + [(99, "z " * 20_000), (None, "a1 b1"), (98, None)]
    bench = spark.createDataFrame([*items, (77, "z " * 12)], "item_id long, text string")
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [*((i, i) for i in range(60)), (99, 77)]
    assert {round(r.similarity, 6) for r in got} == {0.75, 1.0}
