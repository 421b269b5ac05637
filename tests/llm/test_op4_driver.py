"""The quality model is learnt in a task, not in the driver (pipeline: memory of the driver)."""

import numpy as np

from strata.llm import op4_quality as Q


def test_a_task_learns_the_model_that_the_sample_gives(spark, monkeypatch):
    rows = [(i, ("good words here " if i % 2 else "zzz qqq ") * (i % 9 + 1) if i else None, i % 2) for i in range(80)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(900, 1), (None, 0)], "doc_id long, quality int")
    sample = sorted(Q.training_sample(docs, labels.where(~Q.in_fold("doc_id", 4, 2))).collect(), key=lambda r: r["doc_id"])
    texts, marks = [r["text"].encode() for r in sample], [int(r["quality"]) for r in sample]
    pieces, more = Q.short_pieces(texts, marks)
    want = Q.train(texts + pieces, marks + more)
    here, train = [], Q.train
    monkeypatch.setattr(Q, "train", lambda *a, **k: here.append(len(a[0])) or train(*a, **k))
    got = Q.fit(docs, labels)
    assert not any(here)                                   # no text was learnt from in the driver
    for a, b in ((got.tables, want.tables), (got.bias, want.bias), (got.weight, want.weight), (got.offset, want.offset)):
        assert np.array_equal(a, b)
    assert not Q.fit(docs, labels.limit(0)).weight.any()
