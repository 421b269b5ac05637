"""Bound-pruned retrieval (M2, M4, M5) equals the unpruned results."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import retrieval as R


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(8)
    rare = [f"rare{i}" for i in range(40)]
    rows = [(d, "the common the " + " ".join(rng.choice(rare) for _ in range(rng.choice([0, 0, 0, 1, 3]))) + " filler" * rng.randrange(9))
            for d in range(2000)]
    docs = spark.createDataFrame(rows + [(9000, None), (9001, ""), (9002, rows[5][1]), (9003, rows[5][1])], "doc_id long, text string")
    asked = [(1, "the common rare3 rare7"), (2, "the"), (3, "nothing here"), (4, "rare5 rare5 filler"), (5, ""), (6, None),
             (7, "rare1 rare2 rare3 rare4 common")]
    return docs, spark.createDataFrame(asked, "query_id long, query string")


def test_impact_bounds_change_no_row(texts):
    docs, queries = texts
    whole = R.bm25_top_k(docs, queries, k=None).filter("rank <= 10").collect()
    assert sorted(map(str, R.bm25_bounded(docs, queries, k=10).collect())) == sorted(map(str, whole))
    assert R.bm25_bounded(docs.limit(0), queries, k=10).count() == 0


def test_a_common_word_proposes_few_documents(texts):
    docs, queries = texts
    weights, qterms = R.bm25_weights(docs, queries.filter("query_id in (1, 7)"))
    found, idle = R.bm25_candidates(weights, qterms, 10)
    every = weights.join(qterms, "term").select("query_id", "doc_id").distinct().count()
    assert found.count() * 10 <= every
    assert {"the", "common"} <= {r.term for r in idle.collect()}


def as_list(spark, rows):
    return spark.createDataFrame(rows, "query_id long, doc_id long, s double")


@pytest.mark.parametrize("shape", ["apart", "alike", "short"])
def test_threshold_fusion_equals_whole_rankings(spark, shape):
    rng = random.Random(3)
    items = list(range(1200 if shape != "short" else 6))
    lists = []
    for n in range(2):
        rows = [(q, d, float(d % 50 if shape == "alike" else rng.randrange(400))) for q in (1, 2) for d in items
                if rng.random() < 0.8 or shape == "short"]
        lists.append(as_list(spark, rows + [(3 + n, 5, 1.0)]))
    whole = R.rrf([R.top_k_per(x.withColumn("rs", F.round("s", 9)), "query_id", "rs", "doc_id", None) for x in lists], k=10)
    got = R.rrf_top_k([R.scored_list(x) for x in lists], k=10)
    assert sorted(map(str, got.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_cluster_bounds_change_no_row_and_skip_pairs(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    x = np.concatenate([c + 0.05 * rng.normal(size=(50, 16)) for c in centres])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(2000, [0.0] * 16), (2001, None), (2002, [float("nan")] * 16), (2003, x[3].tolist()), (2004, [1.0] * 3)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    asked = spark.createDataFrame([(100 + i, centres[i].tolist()) for i in range(20)] + [(200, [0.0] * 16)],
                                  "query_id long, vector array<double>")
    got = R.vector_bounded(vectors, asked, k=5, clusters=40).collect()
    q = centres / np.linalg.norm(centres, axis=1)[:, None]
    full = {i: v for i, v in rows if v is not None and len(v) == 16 and np.isfinite(v).all() and any(v)}
    ids = np.array(sorted(full))
    unit = np.array([full[i] for i in ids])
    s = q @ (unit / np.linalg.norm(unit, axis=1)[:, None]).T
    want = {(100 + i, int(ids[j]), r + 1) for i in range(20) for r, j in enumerate(np.lexsort((ids, -np.round(s[i], 9)))[:5])}
    assert {(r.query_id, r.vec_id, r["rank"]) for r in got} == want
    usable = vectors.select("vec_id", F.col("embedding").alias("v")).filter("vec_id < 2000")
    dealt, found, shape = R.vector_clusters(usable, 40)
    first, rest = R.vector_visits(dealt, found, shape, asked.filter("query_id < 200").withColumnRenamed("vector", "v"), 5)
    size = {c: n for c, _, n in shape}
    scored = sum(size[r.cluster] for r in rest.collect())
    assert scored < 0.3 * 20 * len(x)                     # share of pairs scored beyond each first cluster
    assert R.vector_bounded(vectors.limit(0), asked, k=5).count() == 0
    assert R.vector_bounded(vectors, asked.limit(0), k=5).count() == 0
