"""The pipeline on the small tables: each stage against what it must do to its own input."""

import os
from collections import Counter

import corpus_pipeline
import pytest
from kindred.llm import decontaminate, mixing
from kindred.llm.queries import read
from kindred.sources.staging import cut

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the small tables are absent")


def test_stages(spark):
    docs, kept = read(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SF))
        assert docs.columns == read(spark, SF, "documents").columns
        kept.append(docs)
    before, toxic_gone, once, clean, mixed = [read(spark, SF, "documents"), *kept]
    labels = {r.doc_id: r.toxic for r in read(spark, SF, "labels").collect()}
    ids = [Counter(r.doc_id for r in d.select("doc_id").collect()) for d in (before, toxic_gone, once, clean, mixed)]
    assert not [i for i in ids[0] - ids[1] if labels.get(i) == 0]
    leaked = {r.doc_id for r in decontaminate.leaks(once, read(spark, SF, "benchmark")).collect()}
    assert set(ids[2]) - set(ids[3]) == leaked and not set(ids[3]) - set(ids[2])
    copies = {r.doc_id: r["_copies"] for r in mixing.mixture(clean).collect()}
    assert ids[4] == Counter({i: n for i, n in copies.items() if n})
    out = corpus_pipeline.STAGES[-1][1](spark, mixed, SF).orderBy("start").collect()
    assert Counter(r.doc_id for r in out) == ids[4]
    at = 0
    for r in out:
        assert r.start == at
        at += r.n_tokens
