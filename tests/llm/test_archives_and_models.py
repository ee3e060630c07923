"""Archives, tokens, rollups and fitted models: round trips, brute force, held-out accuracy."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from kindred.llm import host_reputation, quality_forest, queries, rans_tokens, token_rollups, toxicity_fm, warc_store
from kindred.llm import words as W
from kindred.sources.staging import staged_path


def test_warc_round_trip(spark):
    html = ["<p>a</p>", "x\r\n\r\nWARC/1.1\r\n", None, "", "<p>a</p>", "é" * 5000, "<p>a</p>"]
    rows = [(i, None if i == 3 else f"http://h/{i}\r\nX: y", t, 1) for i, t in enumerate(html, 5)]
    rows += [(None, "u", "<p>a</p>", 1), (6, "again", html[1], 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    for least in (0, 3):
        path = staged_path(spark, "warc")
        warc_store.write_archive(df, path, least)
        got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in warc_store.read_archive(spark, path).collect())
        want = Counter()
        for page, _, text, _ in rows:
            data = (text or "").encode()
            first = min(p for p, _, t, _ in rows if p is not None and (t or "") == (text or "")) if len(data) >= least else None
            again = first is not None and page != first
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            want[page, len(data), digest, "revisit" if again else "response", first if again else None, data] += 1
        assert got == want
        stored = warc_store.read_payloads(spark, path).count()
        assert stored == len({t or "" for t in html})
    path = staged_path(spark, "warc")
    warc_store.write_archive(df.limit(0), path)
    assert warc_store.read_headers(spark, path).count() == 0


def test_block_code():
    rng = np.random.default_rng(4)
    for n, vocabulary in ((1, 2), (5, 3), (1024, 50), (3000, 40_000), (300_000, 49_000)):
        ids = (vocabulary * rng.random(n) ** 6).astype(np.uint32)
        table = rans_tokens.Table(np.bincount(ids, minlength=vocabulary))
        assert int(table.f.sum()) == 1 << rans_tokens.SCALE
        payload = rans_tokens.encode_block(ids, table)
        assert np.array_equal(rans_tokens.decode_block(payload, table), ids)
        rows = -(-n // rans_tokens.LANES)
        parts = [rans_tokens.decode_block(payload, table, k) for k in range(-(-rows // rans_tokens.STEPS))]
        assert np.array_equal(np.concatenate(parts), ids)
    payload = bytearray(payload)
    payload[-1] ^= 1
    with pytest.raises(ValueError, match="does not decode"):
        rans_tokens.decode_block(bytes(payload), table)


def test_tokens(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    odd = ["don't", "it's,", "<|endoftext|>x", "ÉTÉ,", "naïve…", "a1b22!!", "日本語", "e\u0301a", "x\u00a0y", "\x1cz", "İ", "ﬁ", "'s", "--", "\x00"]
    texts = [None, "", " \n", "end", *odd, " ".join(odd)]
    texts += [" ".join(rng.choice((*odd, "the", "Thing.", "of", f"w{rng.randrange(99)}")) for _ in range(rng.randrange(300))) for _ in range(40)]
    texts.append("long words " * 40_000)
    rows = [(3 * len(texts) - 3 * i, t, "b") for i, t in enumerate(texts)] + [(None, "no id", "b"), (3, "again", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(5)
    path = staged_path(spark, "tokens")
    rans_tokens.write_tokens(df, path, queries.tokenizer_path())
    got = sorted(rans_tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    encoder, at = Tokenizer.from_file(queries.tokenizer_path()), 0
    ids = {(i, t): [*encoder.encode(t or "", add_special_tokens=False).ids, 1] for i, t, _ in rows}
    want = Counter((i, len(v), zlib.crc32(np.array(v, "<u4").tobytes()), np.array(v, "<u4").tobytes()) for (i, _), v in ids.items())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got) == want
    for r in got:
        assert r.start == at
        at += r.n_tokens
    names = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert names == sorted(names)
    path = staged_path(spark, "tokens")
    rans_tokens.write_tokens(df.limit(0), path, queries.tokenizer_path())
    assert rans_tokens.read_tokens(spark, path).count() == 0


def test_whole_text_tokenizer(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    own, plain = rans_tokens.TextEncoder(path), Tokenizer.from_file(path)
    texts = ["Two  words", "", " lead\n\nlines"]
    data = [t.encode() for t in texts]
    given = W.Texts(np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(d) for d in data])])
    ids, lengths = own.encode(given)
    want = [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and lengths.tolist() == [len(w) for w in want]


def statistics_of(text):
    w = (text or "").encode().split()
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {k + j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
    chars = sum(len(x.decode()) for x in w)
    return len(w), chars, sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_quality_statistics_and_verdicts(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeéfgh") for _ in range(rng.randrange(1, 9)))
    texts = [" ".join(word() for _ in range(rng.randrange(25, 90))) + ".\n" + word() for _ in range(260)]
    bad = [" ".join(word() + "%%%&&$$" for _ in range(rng.randrange(25, 90))) for _ in range(60)]
    rows = list(enumerate(texts + bad + [None, "", "a b c d e f g h " * 9, "x\nx\nx\n\n\n y", "\n".join(["l i n e"] * 6)]))
    df = spark.createDataFrame([(i, t, 1.5) for i, t in rows], "doc_id long, text string, score double").repartition(4)
    labels = spark.createDataFrame([(i, int(i < 260), 0) for i in range(0, 320, 2)] + [(None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_forest.filtered(df, labels).collect()}
    for i, text in rows:
        r = got[i]
        want = statistics_of(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)
    unseen = [i for i in range(320) if i % 2]
    assert sum(got[i].kept for i in unseen if i < 260) >= 125 and sum(got[i].kept for i in unseen if i >= 260) <= 1
    alone = quality_forest.filtered(df, labels.limit(0))
    assert all(r.kept == (not r.base_failed) for r in alone.collect())
    assert quality_forest.filtered(df.limit(0), labels).count() == 0


def test_quality_kinds_of_bad_pages(spark):
    """Symbol-ridden and table-like pages go, though good pages hold no symbol and some repeat lines or hold digits."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9)))
    rows, labels = [], []
    for i in range(900):
        words = [word() for _ in range(rng.randrange(40, 120))]
        kind = i % 18
        if kind == 0:
            words = [w + rng.choice(("###", "$$$", "%%%")) for w in words]
        elif kind == 1:
            words = [x for w in words for x in (w, "|")]
        elif kind == 2:
            words[5:5] = [str(rng.randrange(10**6, 10**9)) for _ in range(4)]
        text = ". ".join(" ".join(words[k : k + 8]).capitalize() for k in range(0, len(words), 8))
        rows.append((i, text + ("\nSee also\nSee also" if kind == 3 else "")))
        labels.append((i, int(kind > 1), 0))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([r for r in labels if r[0] % 5], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality_forest.filtered(df, known).collect()}
    unseen = [r for r in labels if r[0] % 5 == 0]
    assert sum(kept[i] for i, q, _ in unseen if not q) <= 1
    assert sum(not kept[i] for i, q, _ in unseen if q) <= 5


def test_toxicity(spark):
    rng = random.Random(6)
    insult, group = ["moron", "idiot", "scum"], ["foos", "bars"]
    rows, labels = [], []
    for i in range(1500):
        kind = i % 5
        text = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 40))]
        text += [rng.choice(insult)] * (kind in (0, 1)) + [rng.choice(group)] * (kind in (0, 2))
        rng.shuffle(text)
        rows.append((i, " ".join(text).capitalize() + "!", 0.5))
        labels.append((i, 1, int(kind == 0)))  # toxic is an insult with a group only
    df = spark.createDataFrame(rows + [(5000, None, 0.0), (None, "", 0.0)], "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity_fm.toxicity(df, marks).withColumn("out", toxicity_fm.held_out("doc_id")).collect()
    assert len(got) == len(rows) + 2 and all(0 <= r["_toxicity"] <= 1 for r in got)
    truth = {i: y for i, _, y in labels}
    for r in got:
        if r.doc_id is not None:
            assert r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in got if r.out and r.doc_id in truth]
    right = sum((r["_toxicity"] >= 0.5) == truth[r.doc_id] for r in held)
    assert right >= 0.95 * len(held)
    assert toxicity_fm.toxicity(df, marks.limit(0)).count() == len(rows) + 2
    assert toxicity_fm.toxicity(df.limit(0), marks).count() == 0


def test_host_reputation(spark):
    urls = [f"http://bad.one.com:80/p{i}" for i in range(40)] + [f"http://u@good.one.com/p{i}" for i in range(200)]
    urls += ["HTTPS://A.B.co.uk/x?y#z", "no scheme", None, "x://", "http://www.Example.com/en/1", "http://example.com/en/1", "http://fresh.one.com"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, bad int")
    labels = spark.createDataFrame([(i, int(i >= 40), 0) for i in range(200)] + [(None, 0, 0), (0, None, None)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in host_reputation.judged(pages, labels, queries.URL_RULES[1:3]).collect()}
    assert len(got) == len(urls)
    assert {got[i].verdict for i in range(40)} == {"block"} and {got[i].verdict for i in range(40, 240)} == {"allow"}
    assert (got[240].host, got[240].path) == ("a.b.co.uk", "/x") and (got[241].host, got[242].path, got[243].host) == ("", "", "")
    assert (got[244].rule, got[244].verdict) == ("www.example.com/en/", "allow") and (got[245].rule, got[245].verdict) == ("example.com/en/", "block")
    assert got[246].path == "" and got[246].rule is None
    levels = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x",), ("",), ("u@h.d.com:8",)], "host string")
    told = [tuple(r) for r in levels.select("host", *(c.alias(n) for n, c in host_reputation.domain_levels("host").items())).collect()]
    assert [t[1:] for t in told] == [("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("x", "x"), ("", ""), ("d.com", "com")]
    assert host_reputation.judged(pages.limit(0), labels).count() == 0


def test_rollups(spark):
    rng = random.Random(12)
    path, state = staged_path(spark, "rollups"), {}
    schema = "doc_id long, version string, source string, lang string, tokens long, op string, seq long, docs string"

    def batch(n):
        rows = []
        for k in range(n):
            op = rng.choice(("insert", "insert", "delete", "revise"))
            rows.append((rng.randrange(25), rng.choice(("v1", "v2")), rng.choice(("a", "b", None)), rng.choice(("en", None)), rng.choice((None, 0, 5, 70)), op, k, "x"))
        return rows

    batches = [batch(60), batch(30), [], batch(40)]
    for number, rows in enumerate(batches, 1):
        token_rollups.commit_batch(spark.createDataFrame(rows, schema), path, number)
        for doc, version, source, lang, tokens, op, _, _ in rows:
            state.pop((doc, version), None)
            if op != "delete":
                state[doc, version] = (source, lang, tokens or 0)
    token_rollups.commit_batch(spark.createDataFrame(batches[1], schema), path, 2)
    want = Counter()
    for (_, version), (source, lang, tokens) in state.items():
        want[source, lang, version, "docs"] += 1
        want[source, lang, version, "tokens"] += tokens
    got = token_rollups.totals(spark, path).collect()
    assert {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in got} == {
        k[:3]: (n, want[(*k[:3], "tokens")]) for k, n in want.items() if k[3] == "docs"
    }
    assert token_rollups.totals(spark, path, upto=1).count() > 0


def test_rollups_of_null_ids_and_versions(spark, tmp_path):
    path = staged_path(spark, "rollups")
    schema = "doc_id long, version string, source string, lang string, tokens long, op string, seq long"
    first = [(None, "v", "a", "en", 5, "insert", 1), (None, "v", "a", "en", 5, "insert", 1), (1, None, "a", "en", 7, "insert", 1), (1, "v", "a", "en", 9, "insert", 1)]
    second = [(None, "v", "a", "en", 5, "delete", 1), (None, None, None, None, 3, "revise", 1), (1, None, "a", "en", 2, "revise", 1)]
    for number, rows in ((1, first), (2, second), (2, second)):
        token_rollups.commit_batch(spark.createDataFrame(rows, schema), path, number)
    got = {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in token_rollups.totals(spark, path).collect()}
    assert got == {("a", "en", "v"): (3, 19), ("a", "en", None): (1, 2), (None, None, None): (1, 3)}
    docs = [(None, "one two", "s", "en"), (None, "w " * 25, "s", "en"), (1, "w " * 30, "s", "en"), (2, "short", "s", "en")]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.version: (r.docs, r.tokens) for r in queries.op9_token_rollups(spark, str(tmp_path)).collect()}
    assert got == {"words-1": (3, 2 + 25 + 29), "pieces-1": (4, 2 + 25 + 30 + 1)}


def test_rollups_refuse_unknown_operations(spark, tmp_path):
    path = str(tmp_path / "counts")
    schema = "doc_id long, version string, seq long, op string, source string, lang string, tokens long"
    rows = [(1, "v", 1, "insert", "a", "en", 5), (1, "v", 2, None, "a", "en", 9), (2, "v", 1, "replace", "a", "en", 7), (None, "v", 1, None, "a", "en", 1)]
    for _ in range(2):
        token_rollups.commit_batch(spark.createDataFrame(rows, schema), path, 1)
    assert [tuple(r) for r in token_rollups.totals(spark, path).collect()] == [("a", "en", "v", 1, 5)]
    assert sorted((r.doc_id or 0, r.op or "") for r in token_rollups.rejected(spark, path).collect()) == [(0, ""), (1, ""), (2, "replace")]


def test_toxicity_with_clashing_names(spark):
    docs = spark.createDataFrame([(i, "bad words" if i % 2 else "good words", 3.0) for i in range(40)], "doc_id long, text string, _TOXICITY double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    got = toxicity_fm.toxicity(docs, labels)
    assert got.columns == ["doc_id", "text", "_toxicity"] and got.count() == 40
    assert toxicity_fm.toxicity(docs, labels, column="_s").columns == ["doc_id", "text", "_TOXICITY", "_s"]
