"""Retrieval operators against brute force in Python on small fixtures."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.operators import retrieval as R

TEXTS = {1: "the cat sat on the mat", 2: "the dog sat", 3: "cats and dogs and the cat",
         4: "nothing to see here", 5: "the cat sat on the mat", 6: ""}
QUERIES = {10: "cat mat", 11: "dog", 12: "the sat here"}


def py_bm25(k=10, k1=1.2, b=0.75):
    toks = {d: re.findall(r"\w+", t.lower()) for d, t in TEXTS.items()}
    n = len(toks)
    avgdl = sum(len(t) for t in toks.values()) / n
    df = Counter(w for t in toks.values() for w in set(t))
    out = {}
    for qid, q in QUERIES.items():
        scores = {}
        for d, t in toks.items():
            tf = Counter(t)
            s = 0.0
            for w in set(q.lower().split()):
                if tf[w]:
                    idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                    s += idf * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(t) / avgdl))
            if s > 0:
                scores[d] = s
        ranked = sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
        out[qid] = [(d, round(s, 6)) for d, s in ranked]
    return out


def test_bm25_brute_force(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    qs = spark.createDataFrame(list(QUERIES.items()), "query_id long, query string")
    got = {}
    for r in R.bm25_top_k(docs, qs, k=3).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    want = {q: v[:3] for q, v in py_bm25().items()}
    assert got.keys() == want.keys()
    for q in want:
        assert [d for d, _ in got[q]] == [d for d, _ in want[q]]
        assert all(abs(a - b) < 1e-6 for (_, a), (_, b) in zip(got[q], want[q]))


def test_chunks(spark):
    words = [f"w{i}" for i in range(23)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "a b"), (3, "   ")], "id long, t string")
    got = [(r["id"], r["chunk_index"], r["start_word"], r["n_words"], r["chunk"])
           for r in R.chunk_text(df, "id", "t", size=10, overlap=3).orderBy("id", "chunk_index").collect()]
    starts = []
    s = 0
    while True:
        starts.append(s)
        if s + 10 >= len(words):
            break
        s += 7
    want = [(1, i, s, len(words[s:s + 10]), " ".join(words[s:s + 10])) for i, s in enumerate(starts)] + [(2, 0, 0, 2, "a b")]
    assert got == want


def test_vector_top_k(spark):
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(40, 8)).astype(np.float32)
    qs = rng.normal(size=(3, 8))
    vdf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "vec_id long, embedding array<float>")
    qdf = spark.createDataFrame([(100 + j, [float(x) for x in q]) for j, q in enumerate(qs)], "query_id long, vector array<double>")
    got = {}
    for r in R.vector_top_k(vdf, qdf, k=4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    v64 = vecs.astype(np.float64)
    for j, q in enumerate(qs):
        cos = v64 @ q / (np.linalg.norm(v64, axis=1) * np.linalg.norm(q))
        assert got[100 + j] == list(np.argsort(-cos, kind="stable")[:4])


def test_rrf(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3)], "query_id long, doc_id long, rank int")
    b = spark.createDataFrame([(1, 12, 1), (1, 10, 2)], "query_id long, doc_id long, rank int")
    got = [(r["doc_id"], r["score"], r["n_lists"]) for r in R.rrf([a, b], k=3).orderBy("rank").collect()]
    s = {10: 1 / 61 + 1 / 62, 11: 1 / 62, 12: 1 / 63 + 1 / 61}
    want = sorted(s, key=lambda d: -s[d])
    assert [g[0] for g in got] == want
    assert all(abs(g[1] - s[g[0]]) < 1e-9 for g in got)


def test_centroids(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 5.0])], "label int, embedding array<float>")
    got = {r["label"]: r["vector"] for r in R.centroids(df).collect()}
    assert got == {1: [2.0, 3.0], 2: [5.0, 5.0]}


def test_many_query_vectors_and_zero_vectors(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(1100)] + [(5000, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    got = R.vector_top_k(df, queries, k=1).collect()
    assert len(got) == 1100 and all(r["score"] == 1.0 and r["vec_id"] == r["query_id"] % 35 for r in got)


def test_no_job_runs_while_a_query_is_built(spark):
    import __spark_entry__ as E
    status = spark.sparkContext.statusTracker()
    for name in ("bm25", "vector_top_k", "rrf", "secured_documents", "visibility_check"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        E.queries()[name](spark, "/root/testdata/sf0.001")
        jobs = status.getJobIdsForGroup(f"build-{name}")
        spark.sparkContext.setJobGroup("", "")
        assert len(jobs) <= 5, (name, jobs)      # one per table: Parquet footers
