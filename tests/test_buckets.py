"""Keyword scores by buckets of documents."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import retrieval as R


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    rows = [(f"{d}:{i}", "the " + " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(9)))) for d in range(300) for i in range(d % 4)]
    rows += [next(r for r in rows if r[0] == "5:0"), (None, "a b the"), ("900:0", None), ("901:0", ""), ("902:0", rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    asked = [(1, "the a b"), (2, "c"), (3, "nothing"), (None, "a j"), (5, ""), (6, None), (7, "the the d e f g")]
    return docs, spark.createDataFrame(asked, "query_id long, query string")


def summed(docs, queries):
    weights, qterms = R.bm25_weights(docs, queries)
    return weights.join(qterms, "term").groupBy("query_id", "doc_id").agg(F.sum("w").alias("s"))


def rows(df):
    return sorted((str(r.query_id), str(r.doc_id), round(r.s, 9)) for r in df.collect())


@pytest.mark.parametrize("cells", [1, 40, R.SCORE_CELLS])
def test_scores_by_buckets_are_the_sums_of_the_weights(texts, monkeypatch, cells):
    monkeypatch.setattr(R, "SCORE_CELLS", cells)
    assert rows(R.bm25_scores(*texts)) == rows(summed(*texts))
    assert R.bm25_scores(texts[0].limit(0), texts[1]).count() == 0


def test_left_out_scores_are_not_among_the_best(texts):
    scores, bound = summed(*texts), R.bm25_scores(*texts, k=3)
    assert set(rows(bound)) <= set(rows(scores)) and bound.count() < scores.count()
    ranked = [R._ranked(x, 3, 6).orderBy("query_id", "rank").collect() for x in (scores, bound)]
    assert ranked[0] == ranked[1]


def test_the_best_part_of_every_whole_stays(texts):
    whole = F.split_part(F.col("doc_id"), F.lit(":"), F.lit(1)).cast("long")
    best = lambda x: sorted(map(str, x.groupBy("query_id", whole.alias("w")).agg(F.round(F.max("s"), 9)).collect()))
    scores, bound = summed(*texts), R.bm25_scores(*texts, part_of=whole)
    assert best(scores) == best(bound) and bound.count() < scores.count()


def test_no_sum_is_shuffled(texts):
    plan = R.bm25_scores(*texts)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("CoGroups") < plan.index("Exchange")
