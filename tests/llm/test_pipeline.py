"""The pipeline's rows against its stages done by hand on sf0.001."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from strata.llm import op4_quality, op9_secrets, op10_bpe
from strata.llm.common import read
from test_llm import brute_components

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_pipeline(spark):
    docs, seen = read(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        seen[name] = docs
        if name != "tokens":
            assert docs.columns == before.columns
    text = {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect()}
    kept = [r["doc_id"] for r in seen["quality"].collect()]
    labels = {r["doc_id"]: r["quality"] for r in read(spark, SF, "labels").collect()}
    assert all(i in set(kept) for i, q in labels.items() if q == 1) and any(q == 0 and i not in set(kept) for i, q in labels.items())
    groups = brute_components([(i, text[i]) for i in kept], 5, 80)
    alone = sorted({c for _, c in groups.values()})
    assert sorted(r["doc_id"] for r in seen["near_duplicates"].collect()) == alone
    path = op10_bpe.vocabulary()
    count = lambda s: len(op9_secrets.encoder(path).encode_ordinary(s))
    clean = {r["doc_id"]: r["text"] for r in seen["secrets"].collect()}
    assert sorted(clean) == alone
    assert all(clean[i] == text[i] for i in alone if not op9_secrets.scan(text[i], count))
    assert all(clean[i] != text[i] for i in alone if op9_secrets.scan(text[i], count))
    assert {r["doc_id"] for r in seen["mixing"].collect()} <= set(alone)
    out = seen["tokens"].collect()
    own = op10_bpe.codec(path)
    assert sorted(r["doc_id"] for r in out) == sorted(r["doc_id"] for r in seen["mixing"].collect())
    assert all(r["n_tokens"] == len(own.encode(clean[r["doc_id"]])) for r in out)
    model = op4_quality.fit(read(spark, SF, "documents"), read(spark, SF, "labels"))
    scores = op4_quality.with_score(read(spark, SF, "documents"), model, "own_score").collect()
    assert sorted(kept) == sorted(r["doc_id"] for r in scores if r["own_score"] >= 0.7)
