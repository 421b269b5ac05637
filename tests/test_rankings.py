"""Whole rankings that are neither stored nor sorted as a whole."""

import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from strata.operators import retrieval as R


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(6)
    rows = [(d, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(30)))) for d in range(700)]
    rows += [(d, "a b c " * 9) for d in range(1000, 1400)] + [rows[3], (2000, None), (2001, "")]      # copies: equal scores
    asked = [(1, "a b"), (2, "c"), (3, "nothing"), (None, "a j"), (5, ""), (7, "d e f g")]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(asked, "query_id long, query string")


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(7)
    rows = [(i, [float(rng.randrange(-2, 3)) for _ in range(4)]) for i in range(900)]
    rows += [(5, [1.0, 2.0, 0.0, 1.0]), rows[6], (1000, [0.0] * 4), (1001, None), (1002, [1.0, None, 0.0, 0.0]), (1003, [1.0]), (1004, [])]
    rows += [(1005, [float("nan"), 1.0, 1.0, 1.0])]
    asked = [(1, [1.0, 0.0, 2.0, 1.0]), (2, [0.0, -1.0, 1.0, 0.0]), (2, [1.0, 1.0, 0.0, 0.0]), (7, [0.0] * 4), (5, None)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>"), spark.createDataFrame(asked, "query_id long, vector array<float>")


def chunked(docs, queries):
    chunks = R.chunk_text(docs, "doc_id", "text", size=6, overlap=2)
    chunks = chunks.select(F.concat_ws(":", "doc_id", "chunk_index").alias("chunk_id"), "chunk")
    return chunks, F.split(F.col("doc_id"), ":")[0].cast("long"), dict(doc_id="chunk_id", doc_text="chunk")


def rows(df, *names):
    return sorted(str(tuple(r[n] for n in names)) for r in df.collect())


def both(texts, vectors):
    """(Ranking, whole list) of documents, of documents by chunk and of vectors."""
    chunks, of_chunk, names = chunked(*texts)
    by_chunk = R.parents_by_best_chunk(
        R.bm25_ranking(chunks, texts[1], **names), of_chunk, order=F.concat(F.col("item").cast("string"), F.lit(":")),
        tie=lambda ids: pc.binary_join_element_wise(ids.cast(pa.string()), "", ":"))
    by_chunk_whole = R.bm25_top_k(chunks, texts[1], k=None, **names)
    first = by_chunk_whole.select("query_id", of_chunk.alias("doc_id"), "rank").groupBy("query_id", "doc_id").agg(F.min("rank").alias("s"))
    return {"words": (R.bm25_ranking(*texts), R.bm25_top_k(*texts, k=None)),
            "chunks": (by_chunk, R.top_k_per(first.withColumn("s", -F.col("s")), "query_id", "s", "doc_id", None)),
            "vectors": (R.vector_ranking(*vectors), R.vector_top_k(*vectors, k=None).withColumnRenamed("vec_id", "doc_id"))}


@pytest.mark.parametrize("name", ["words", "chunks", "vectors"])
def test_heads_and_counted_ranks_are_those_of_the_whole_list(texts, vectors, monkeypatch, name):
    monkeypatch.setattr(R, "SCORE_CELLS", 50)
    ranking, whole = both(texts, vectors)[name]
    whole = whole.select("query_id", F.col("doc_id").alias("item"), "rank")
    want = rows(whole, "query_id", "item", "rank")
    assert rows(ranking.heads(37), "query_id", "item", "rank") == rows(whole.filter("rank <= 37"), "query_id", "item", "rank")
    some = whole.filter("item % 3 = 0 or item > 990").select("query_id", "item").distinct()
    extra = some.unionByName(some.limit(1).select("query_id", F.lit(-5).cast("long").alias("item")))       # not in any list
    got = rows(ranking.ranks(extra), "query_id", "item", "rank")
    assert got == rows(whole.filter("item % 3 = 0 or item > 990"), "query_id", "item", "rank") and set(got) <= set(want)


@pytest.mark.parametrize("pair", [("words", "chunks"), ("words", "vectors")])
def test_fusion_of_rankings_is_that_of_whole_lists(texts, vectors, pair):
    lists = both(texts, vectors)
    names = ("query_id", "doc_id", "rank", "score", "n_lists")
    assert rows(R.rrf([lists[n][0] for n in pair], k=10), *names) == rows(R.rrf([lists[n][1] for n in pair], k=10), *names)


def test_no_whole_list_is_sorted(spark):
    import __spark_entry__ as E
    for name in ("rrf", "hybrid_bounded"):
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        # rows leave their buckets as heads, found items or counts; a whole list had a row_number without limit
        assert plan.count("FlatMapCoGroupsInArrow") >= 6, name
        assert "WindowGroupLimit [query_id" in plan and "rrf_list" not in plan, name


def test_a_bucket_gives_only_its_head(texts):
    ranking = R.bm25_ranking(*texts)
    assert ranking._met(None, 3).count() <= 3 * ranking.buckets * 4 < R.bm25_scores(*texts).count()


def test_buckets_follow_the_queries_not_their_files(spark, scratch, monkeypatch):
    """Queries picked from the vectors by a join: the buckets grow with the vectors, not with their square."""
    monkeypatch.setattr(R, "BUCKET_BYTES", 8192)
    monkeypatch.setattr(R, "BUCKET_QUERY_BYTES", 2048)
    rng = random.Random(8)
    rows = [(i, [rng.random() for _ in range(64)]) for i in range(400)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{scratch}/vectors")
    stored = spark.read.parquet(f"{scratch}/vectors")
    size = R._bytes_of(stored)
    asked = (stored.join(spark.range(4).withColumnRenamed("id", "vec_id"), "vec_id", "left_semi")
             .select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")))
    ranking = R.vector_ranking(stored, asked)
    assert size > 64 * 1024 and ranking.buckets == max(8, -(-size * 2 // 8192))          # 4 queries: 2080 bytes, 2 shares
    whole = R.vector_top_k(stored, asked, k=9)
    assert rows_of(ranking.heads(9)) == rows_of(whole.withColumnRenamed("vec_id", "item"))


def test_a_document_is_one_row_of_its_places(spark, scratch, texts):
    """Places are dealt as a row of terms per document, formerly a row each; copies and null ids keep theirs."""
    docs = texts[0].unionByName(texts[0].limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    docs.write.parquet(f"{scratch}/docs")
    texts[1].write.parquet(f"{scratch}/asked")
    texts = docs, asked = spark.read.parquet(f"{scratch}/docs"), spark.read.parquet(f"{scratch}/asked")
    left = R.bm25_ranking(docs, asked).left
    assert left.count() < docs.count() < left.agg(F.sum(F.size("terms"))).first()[0]
    assert rows_of(R.bm25_top_k(docs, texts[1], k=5).withColumnRenamed("doc_id", "item")) == rows_of(
        R.bm25_ranking(docs, texts[1]).heads(5))
    weights, qterms = R.bm25_weights(docs, texts[1])                     # an exact sum by joins, row by row
    sums = weights.join(qterms, "term").groupBy("query_id", "doc_id").agg(F.round(F.sum("w"), 6).alias("s")).filter("doc_id is not null")
    got = R.bm25_scores(docs, texts[1]).withColumn("s", F.round("s", 6)).filter("doc_id is not null")
    assert rows(sums, "query_id", "doc_id", "s") == rows(got, "query_id", "doc_id", "s")


def rows_of(df):
    return rows(df, "query_id", "item", "rank")
