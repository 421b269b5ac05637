"""Batch text retrieval over document tables (M1-M5).

* M1 ``chunk_text``: overlapping word windows, one row per chunk.
* M2 ``bm25_top_k``: keyword ranking of many queries at once.
* M3 is ``strata.operators.access.match_all_search``.
* M4 ``vector_top_k``: exact cosine top-k of given vectors.
* M5 ``rrf``: reciprocal rank fusion of several rankings.

All scoring is expressed with Spark joins, aggregations and windows; top-k
uses ``row_number() <= k``, which Spark pre-filters per task
(``WindowGroupLimit``) so only k rows per query and task are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from strata.functions import text as T
from strata.functions.coerce import round_half_even
from strata.session import input_bytes, materialize

# --- fixed values -------------------------------------------------------
# Tokens for keyword ranking: runs of Unicode letters and digits, lower-cased.
TOKEN_RE = r"[\p{L}\p{N}]+"
# BM25 parameters (the common defaults) and the RRF constant.
BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60
# Scores are ranked after rounding to this many places (equal scores computed
# in a different order then tie exactly and fall back to the id order).
RANK_PLACES = 9
# Blocks of queries in :func:`vector_top_k`.
QUERY_BLOCKS = 16
# Queries and vectors that are scored together, and the salts that deal the
# vectors where every one meets every query.
QUERY_ROWS = 256
VECTOR_ROWS = 4096
VECTOR_SALTS = 64
# Clusters of the exact vector search.
VECTOR_CLUSTERS = 256
# -------------------------------------------------------------------------


NON_TOKEN_RE = r"[^\p{L}\p{N}]+"


def tokens(c) -> Column:
    """Lower-cased runs of letters/digits (split at everything else; the empty
    pieces a split leaves at the ends are dropped)."""
    low = F.lower(F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit("")))
    return F.filter(F.split(low, NON_TOKEN_RE, -1), lambda t: t != "")


def top_k_per(df: DataFrame, group: str, score: str, key: str, k: int | None, rank_col: str = "rank") -> DataFrame:
    """Rows with the ``k`` best ``score`` per ``group`` (ties -> smaller
    ``key``); ``k`` None: all rows, ranked."""
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(key).asc())
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    return ranked if k is None else ranked.filter(F.col(rank_col) <= k)


# --------------------------------------------------------------------- M1

def chunk_text(df: DataFrame, id_col: str, text_col: str, size: int = 200, overlap: int = 50) -> DataFrame:
    """M1: split every text into windows of ``size`` words that overlap by
    ``overlap`` words (the last window may be shorter; texts of at most
    ``size`` words give one chunk; empty texts none).

    Output: ``id_col``, ``chunk_index``, ``start_word``, ``n_words``, ``chunk``.
    Words are runs of non-white-space, as in ``str.split()``.
    """
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap
    w = df.select(id_col, T.words(text_col).alias("__w")).withColumn("__n", F.size("__w"))
    n_chunks = F.when(F.col("__n") <= size, F.lit(1)).otherwise(
        F.ceil((F.col("__n") - size) / F.lit(step)).cast("int") + 1)
    starts = F.sequence(F.lit(0), (n_chunks - 1) * step, F.lit(step))
    # chunk texts are built inside the row, so the word array is not copied
    # into every exploded chunk row
    chunks = F.transform(starts, lambda s: F.struct(
        s.alias("start_word"), F.least(F.lit(size), F.col("__n") - s).alias("n_words"),
        F.array_join(F.slice("__w", s + 1, size), " ").alias("chunk")))
    chunks = F.when(F.col("__n") > 0, chunks)
    exploded = (w.select(id_col, F.posexplode_outer(chunks).alias("chunk_index", "__c"))
                .filter(F.col("__c").isNotNull()))
    return exploded.select(
        id_col, F.col("chunk_index").cast("int").alias("chunk_index"),
        F.col("__c.start_word").cast("int").alias("start_word"),
        F.col("__c.n_words").cast("int").alias("n_words"),
        F.col("__c.chunk").alias("chunk"))


# --------------------------------------------------------------------- M2

def explode_nonempty(arr: Column, name: str) -> Column:
    """``explode`` without Spark's inferred ``size(arr) > 0`` filter: that
    filter would be pushed below the projection and evaluate the (costly) array
    expression a second time per row. ``explode_outer`` yields one null row for
    an empty array; callers drop it with ``filter(isNotNull)`` right after."""
    return F.explode_outer(arr).alias(name)


def bm25_weights(docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                 query_id: str = "query_id", query_text: str = "query",
                 k1: float = BM25_K1, b: float = BM25_B) -> tuple[DataFrame, DataFrame]:
    """((doc_id, term, w), (query_id, term)): the weight of every query term in
    every document that has it, and the distinct terms of every query.

    weight(t, d) = idf(t) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * |d| / avgdl)),
    idf(t) = ln(1 + (N - df + 0.5) / (df + 0.5)).

    N and avgdl are scalar subqueries (one global aggregate each); texts are
    tokenised where they are read, and only (document, length, term, count) rows
    of query terms are shuffled, by document, never a text. Document frequencies
    are a partial aggregate per term.
    """
    dtoks = (docs.select(F.col(doc_id).alias("doc_id"), tokens(doc_text).alias("__t"))
             .withColumn("__dl", F.size("__t")))
    n_docs = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    avgdl = dtoks.agg(F.avg("__dl")).scalar()
    qterms = (queries.select(F.col(query_id).alias("query_id"),
                             explode_nonempty(F.array_distinct(tokens(query_text)), "term"))
              .filter(F.col("term").isNotNull()).distinct())
    vocab = qterms.select("term").distinct()
    occ = (dtoks.select("doc_id", "__dl", explode_nonempty("__t", "term"))
           .filter(F.col("term").isNotNull())
           .join(vocab, "term", "left_semi"))
    tf = (occ.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("__dl").alias("dl"))
          .repartition("doc_id"))
    df_t = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idf_t = df_t.select("term", idf.alias("idf"))
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / avgdl)
    weight = F.col("idf") * F.col("tf") * F.lit(k1 + 1.0) / (F.col("tf") + norm)
    return tf.join(idf_t, "term").select("doc_id", "term", weight.alias("w")), qterms


# Bytes of documents, and of queries, whose pairs are scored together (one bucket of
# documents against all queries), and scores in memory at a time.
BUCKET_BYTES = 4 * 1024 * 1024
BUCKET_QUERY_BYTES = 256 * 1024
SCORE_CELLS = 1 << 21


def _bytes_of(df: DataFrame) -> int:
    """Size of the files that ``df`` reads (no job runs); 0 if it reads none."""
    files = df.inputFiles()
    return input_bytes(df.sparkSession, files) if files else 0


def _buckets(rows: DataFrame, queries: DataFrame, query_bytes: int | None = None) -> int:
    """Buckets that the rows are dealt into: their number follows the size of the files.
    ``query_bytes``: of the queries, where they are a part of what their files hold."""
    share = max(1, -(-(_bytes_of(queries) if query_bytes is None else query_bytes) // BUCKET_QUERY_BYTES))
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-_bytes_of(rows) * share // BUCKET_BYTES))


def _term_runs(batches):
    """Rows (bucket, document, length, terms) from rows of one term each: neighbours of
    one document become one row."""
    import pyarrow as pa
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, _ = _codes(pa.chunked_array([batch.column("doc_id")]))
        own = np.stack([batch.column("__bucket").to_numpy(zero_copy_only=False), doc, batch.column("__dl").to_numpy(zero_copy_only=False)])
        first = np.concatenate([[0], np.flatnonzero((np.diff(own) != 0).any(axis=0)) + 1])
        at, ends = pa.array(first), pa.array(np.append(first, batch.num_rows).astype(np.int32))
        term = batch.column("term")
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(at) for c in ("__bucket", "doc_id", "__dl")], pa.ListArray.from_arrays(ends, term)],
            ["__bucket", "doc_id", "__dl", "terms"])


def _bm25_places(docs: DataFrame, queries: DataFrame, doc_id: str, doc_text: str, query_id: str, query_text: str,
                 k1: float, b: float, part_of: Column | None) -> tuple[DataFrame, DataFrame, int]:
    """(places of query terms, query terms for every bucket, number of buckets) of :func:`bm25_scores`."""
    buckets = _buckets(docs, queries)
    dtoks = (docs.select(F.col(doc_id).alias("doc_id"), tokens(doc_text).alias("__t"))
             .withColumn("__dl", F.size("__t")))
    n_docs = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    avgdl = dtoks.agg(F.avg("__dl")).scalar()
    qterms = (queries.select(F.col(query_id).alias("query_id"),
                             explode_nonempty(F.array_distinct(tokens(query_text)), "term"))
              .filter(F.col("term").isNotNull()).distinct())
    whole = F.col("doc_id") if part_of is None else part_of
    found = (dtoks.select("doc_id", "__dl", explode_nonempty("__t", "term"))
             .filter(F.col("term").isNotNull())
             .join(qterms.select("term").distinct(), "term", "left_semi")
             .select(F.pmod(F.xxhash64(whole), F.lit(buckets)).cast("int").alias("__bucket"), "doc_id", "__dl", "term"))
    kind = found.schema["doc_id"].dataType.simpleString()
    places = (found.mapInArrow(_term_runs, f"__bucket int, doc_id {kind}, __dl int, terms array<string>")
              .repartition(buckets, "__bucket"))
    # the length is read here only so that both uses of the places share one shuffle
    df_t = (places.select("__bucket", "doc_id", "__dl", F.explode(F.array_distinct("terms")).alias("term"))
            .groupBy("__bucket", "doc_id", "term").agg(F.max("__dl").alias("dl"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("dl").alias("dl")).filter(F.col("dl") > 0))
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = (qterms.join(df_t, "term")
             .select("term", "query_id", idf.alias("idf"), F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("__bucket")))
    left = places.select("__bucket", "doc_id", "terms", (F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("__dl") / avgdl)).alias("norm"),
                         *([] if part_of is None else [whole.alias("whole")]))
    return left, asked, buckets


def _codes(column) -> tuple:
    """(code of each row, the values that codes stand for) of a column."""
    named = column.combine_chunks().dictionary_encode(null_encoding="encode")
    return named.indices.to_numpy(), named.dictionary


def _bm25_matrices(d, q, k1: float, parts: bool, tie=None) -> tuple:
    """(queries, documents, whole of each document, wholes, blocks) of a bucket. A block
    is (number of its first document, scores of a few documents for all queries;
    0: no common term). Parts of a whole are neighbours; with ``tie``, wholes follow its order."""
    import pyarrow as pa
    import pyarrow.compute as pc
    term, terms = _codes(q["term"])
    asker, askers = _codes(q["query_id"])
    idf_of = np.zeros(len(terms))
    idf_of[term] = q["idf"].to_numpy()
    asker = asker[np.argsort(term, kind="stable")]                   # the queries of term t: asker[at[t]:at[t + 1]]
    at = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))])
    doc, items = _codes(d["doc_id"])
    norm = np.zeros(len(items))
    np.maximum.at(norm, doc, d["norm"].to_numpy())                   # rows that share an id: the longest counts
    group, wholes = np.arange(len(items)), items
    if parts:
        code, wholes = _codes(d["whole"])
        group[doc] = code
    if tie is not None:
        by = pc.array_sort_indices(tie(wholes), null_placement="at_start").to_numpy()
        wholes, group = wholes.take(pa.array(by)), np.argsort(by)[group]
    if parts or tie is not None:
        order = np.argsort(group, kind="stable")                    # parts of a whole become neighbours
        group, norm, items = group[order], norm[order], items.take(pa.array(order))
        doc = np.argsort(order)[doc]
    doc = np.repeat(doc, pc.list_value_length(d["terms"].combine_chunks()).to_numpy(zero_copy_only=False))       # of each place
    word = pc.index_in(d["terms"].combine_chunks().flatten(), value_set=terms).to_numpy(zero_copy_only=False)
    pair, tf = np.unique(doc.astype(np.int64) * len(terms) + word.astype(np.int64), return_counts=True)
    doc, word = pair // len(terms), pair % len(terms)
    w = idf_of[word] * tf * (k1 + 1.0) / (tf + norm[doc])
    n = at[word + 1] - at[word]
    step = max(1, SCORE_CELLS // len(askers))

    def blocks():
        first = 0
        while first < len(doc):
            # whole documents, up to a bound of cells and of terms met
            upto = first + max(1, np.searchsorted(np.cumsum(n[first:first + 4 * SCORE_CELLS]), SCORE_CELLS, "right"))
            top = min(doc[first] + step, doc[upto] if upto < len(doc) and doc[upto] > doc[first] else doc[min(upto, len(doc)) - 1] + 1)
            last = np.searchsorted(doc, top)
            size = n[first:last]
            start = np.repeat(at[word[first:last]] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
            cell = np.repeat((doc[first:last] - doc[first]) * len(askers), size) + asker[start + np.arange(len(start))]
            s = np.bincount(cell, np.repeat(w[first:last], size), (top - doc[first]) * len(askers)).reshape(-1, len(askers))
            yield doc[first], s
            first = last
    return askers, items, group, wholes, blocks()


def bm25_scores(docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                query_id: str = "query_id", query_text: str = "query", k1: float = BM25_K1, b: float = BM25_B,
                k: int | None = None, part_of: Column | None = None) -> DataFrame:
    """(query_id, doc_id, s): the score of every document that shares a term
    with the query (the sum of its :func:`bm25_weights`). With ``k``, documents that
    ``k`` better ones of their bucket leave behind are left out; with ``part_of``
    (the whole that a document is part of), a query's better part of the same
    whole leaves the others out.

    Places of query terms are dealt by document (by whole, if given; a row holds
    neighbouring places of one document) into buckets, shuffled once and read by the document frequencies too; each bucket
    meets the query terms, and its sums are made as one matrix, a
    few documents at a time. No (query, document, term) row is built and no sum is
    shuffled. The number of buckets follows the size of the files, so that a
    bucket stays small however many documents there are.
    """
    import pyarrow as pa
    left, asked, _ = _bm25_places(docs, queries, doc_id, doc_text, query_id, query_text, k1, b, part_of)
    parts = part_of is not None

    def score(d: pa.Table, q: pa.Table) -> pa.Table:
        out = [pa.table({"query_id": q["query_id"].slice(0, 0), "doc_id": d["doc_id"].slice(0, 0), "s": pa.array([], pa.float64())})]
        if not d.num_rows or not q.num_rows:
            return out[0]
        askers, items, group, _, blocks = _bm25_matrices(d, q, k1, parts)
        best = np.zeros((0, len(askers)))
        for first, s in blocks:
            keep = s > 0                                                # weights are above zero
            if k is not None:
                rounded = np.rint(s * 10 ** RANK_PLACES)
                best = np.concatenate([best, rounded])
                if len(best) > k:
                    best = np.partition(best, len(best) - k, axis=0)[-k:]
                if len(best) >= k:
                    keep &= rounded >= best.min(axis=0)                 # equal scores stay: ids decide later
            if parts:
                edge = np.flatnonzero(np.diff(group[first:first + len(s)], prepend=-1))
                keep &= s >= np.repeat(np.maximum.reduceat(s, edge), np.diff(edge, append=len(s)), axis=0)
            row, column = np.nonzero(keep)
            out.append(pa.table({"query_id": askers.take(pa.array(column)), "doc_id": items.take(pa.array(row + first)),
                                 "s": pa.array(s[row, column])}))
        return pa.concat_tables(out)
    kinds = queries.schema[query_id].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString()
    return (left.groupBy("__bucket").cogroup(asked.groupBy("__bucket"))
            .applyInArrow(score, f"query_id {kinds[0]}, doc_id {kinds[1]}, s double"))


# Weights of a term are kept in blocks of this width; this many of the first
# postings look for a floor; scores closer than this are not told apart by a bound.
IMPACT_BLOCK = 0.25
HEAD = 200
IDLE_SHARE = 0.5
BOUND_MARGIN = 1e-7


def _exact(pairs: DataFrame, weights: DataFrame, qterms: DataFrame) -> DataFrame:
    """(query_id, doc_id, s) of some pairs: their whole scores."""
    return (pairs.join(qterms, "query_id").join(weights, ["doc_id", "term"])
            .groupBy("query_id", "doc_id").agg(F.sum("w").alias("s")))


def _kth(scores: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(the ``k`` best rows of each query, (query_id, floor): the k-th best
    score of queries with ``k`` rows)."""
    order = Window.partitionBy("query_id").orderBy(F.col("s").desc(), "doc_id")
    best = scores.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)
    return best.drop("r"), best.filter(F.col("r") == k).select("query_id", F.col("s").alias("floor"))


def bm25_candidates(weights: DataFrame, qterms: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """((query_id, doc_id, s), (query_id, term)): documents that may be among a
    query's ``k`` best, with the sum ``s`` of the terms that proposed them, and the
    query's idle terms, which are left to add. All other documents are proven
    not to be among the best.

    * ``top``: the largest weight of each block of a term's postings (weights
      between multiples of :data:`IMPACT_BLOCK`); ``most``: of the term.
    * ``floor``: the documents with the best sums over the first blocks of each
      term (up to :data:`HEAD` postings) are scored whole; the k-th best score
      is a floor under the final one. Any documents would do.
    * idle terms: those of smallest ``most`` (common words) that together
      (``idle``) stay below a share of the floor. Their postings propose nothing.
    * A posting of another term counts only if its weight plus ``most`` of all
      other terms reaches the floor; blocks whose ``top`` does not are skipped
      whole. A document stays if the sum of its counted weights plus ``idle``
      reaches the floor (one that lost a posting never does).
    """
    postings = weights.withColumn("block", F.floor(F.col("w") / IMPACT_BLOCK).cast("int"))
    blocks = materialize(postings.groupBy("term", "block").agg(F.max("w").alias("top"), F.count(F.lit(1)).alias("n")),
                         "bm25_blocks")
    most = blocks.groupBy("term").agg(F.max("top").alias("most"))
    down = Window.partitionBy("term").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = blocks.withColumn("upto", F.sum("n").over(down)).filter(F.col("upto") <= max(HEAD, 4 * k)).select("term", "block")
    heads = postings.join(first, ["term", "block"]).select("doc_id", "term", "w")
    probes, _ = _kth(heads.join(qterms, "term").groupBy("query_id", "doc_id").agg(F.sum("w").alias("s")), 2 * k)
    _, floor = _kth(_exact(probes.select("query_id", "doc_id"), weights, qterms), k)
    whole = Window.partitionBy("query_id")
    up = whole.orderBy("most", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_idle = F.col("reach") < F.col("floor") * IDLE_SHARE
    asked = (qterms.join(most, "term").join(floor, "query_id", "left")
             .withColumn("floor", F.coalesce("floor", F.lit(0.0)) - BOUND_MARGIN)
             .withColumns({"reach": F.sum("most").over(up), "others": F.sum("most").over(whole) - F.col("most")})
             .withColumn("idle", F.coalesce(F.max(F.when(is_idle, F.col("reach"))).over(whole), F.lit(0.0)))
             .select("query_id", "term", is_idle.alias("is_idle"),
                     (F.col("floor") - F.col("others") - BOUND_MARGIN).alias("need"),
                     (F.col("floor") - F.col("idle") - BOUND_MARGIN).alias("least")))
    asked = materialize(asked, "bm25_asked")
    visited = asked.filter(~F.col("is_idle")).join(blocks, "term").filter(F.col("top") >= F.col("need"))
    found = (postings.join(visited.select("query_id", "term", "block", "need", "least"), ["term", "block"])
             .filter(F.col("w") >= F.col("need"))
             .groupBy("query_id", "doc_id").agg(F.sum("w").alias("s"), F.max("least").alias("least"))
             .filter(F.col("s") >= F.col("least")).drop("least"))
    return found, asked.filter("is_idle").select("query_id", "term")


def bm25_top_k(docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
               query_id: str = "query_id", query_text: str = "query", k: int | None = 10,
               k1: float = BM25_K1, b: float = BM25_B, places: int = 6) -> DataFrame:
    """M2: BM25 ranking of every document for every query; the ``k`` best per
    query (None: all). Output: ``query_id``, ``doc_id``, ``rank``, ``score`` (the
    sum of :func:`bm25_weights` over the query's distinct terms).

    One lazy plan: :func:`bm25_scores` gives each bucket's best, and only ``k``
    rows per query and task cross the final exchange. Visibility filters (C5)
    belong on ``docs`` before the call. :func:`bm25_bounded` gives the same rows
    from fewer sums, at the price of stored tables.
    """
    scores = bm25_scores(docs, queries, doc_id=doc_id, doc_text=doc_text, query_id=query_id, query_text=query_text, k1=k1, b=b, k=k)
    return _ranked(scores, k, places)


def _ranked(scores: DataFrame, k: int | None, places: int) -> DataFrame:
    scores = scores.withColumn("__rs", round_half_even("s", RANK_PLACES))
    top = top_k_per(scores, "query_id", "__rs", "doc_id", k)
    return top.select("query_id", "doc_id", F.col("rank").cast("int").alias("rank"),
                      round_half_even("s", places).alias("score"))


def bm25_bounded(docs: DataFrame, queries: DataFrame, k: int = 10, places: int = 6, **columns) -> DataFrame:
    """The rows of :func:`bm25_top_k` for large tables: the weights are stored
    once, :func:`bm25_candidates` leaves documents out by upper bounds, and only
    the rest is scored whole. Its jobs run when it is called."""
    weights, qterms = bm25_weights(docs, queries, **columns)
    weights = materialize(weights, "bm25_weights")
    found, idle = bm25_candidates(weights, qterms, k)
    found = materialize(found, "bm25_found")
    more = found.select("query_id", "doc_id").join(idle, "query_id").join(weights, ["doc_id", "term"])
    scores = (found.unionByName(more.select("query_id", "doc_id", F.col("w").alias("s")))
              .groupBy("query_id", "doc_id").agg(F.sum("s").alias("s")))
    return _ranked(scores, k, places)


def parents_by_best_chunk(chunk_hits: "DataFrame | Ranking", parent_of: Column, parent: str = "doc_id", tie=None,
                          order: Column | None = None) -> "DataFrame | Ranking":
    """Chunk-level hits (``query_id``, ``doc_id`` = chunk id, ``rank``) ->
    document ranking by the best rank of any of its chunks (ties -> smaller
    document id). ``parent_of`` derives the document id from ``doc_id`` (the
    chunk id), so no join back to the chunk table is needed.

    A :class:`Ranking` of chunks gives one of documents. ``tie`` (of Arrow ids) and ``order``
    (of column ``item``) then order documents as the ids of their chunks do."""
    if isinstance(chunk_hits, Ranking):
        return chunk_hits.parents(parent_of, tie, order)
    best = (chunk_hits.select("query_id", parent_of.alias("__parent"), F.col("rank").alias("__r"))
            .groupBy("query_id", "__parent").agg(F.min("__r").alias("__best")))
    w = Window.partitionBy("query_id").orderBy(F.col("__best"), F.col("__parent"))
    return best.select("query_id", F.col("__parent").alias(parent), F.row_number().over(w).alias("rank"))


# --------------------------------------------------------------------- M4

def _cosine(v: Column, q: Column, q_norm: Column) -> Column:
    dot = F.aggregate(F.zip_with(v, q, lambda a, c: a * c), F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    v_norm = F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))
    return F.try_divide(dot, v_norm * q_norm)


def vector_top_k(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vec_col: str = "embedding",
                 query_id: str = "query_id", query_vec: str = "vector", k: int | None = 5,
                 places: int = 6) -> DataFrame:
    """M4: exact cosine similarity of every vector to every query vector; the
    ``k`` most similar per query (None: all, ranked). Output: ``query_id``,
    ``vec_id``, ``rank``, ``score``. Zero vectors have no cosine and are left out.

    Queries are dealt into :data:`QUERY_BLOCKS` rows, each an array of queries;
    vectors meet every block by an equi-join on its number, are scored in the
    JVM, and each task pre-limits to ``k`` per query before the only large
    shuffle. Nothing runs while the plan is built and no query set is refused.
    """
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))
    blocks = (q.withColumn("n", norm).groupBy(F.expr(f"cast(pmod(xxhash64(query_id), {QUERY_BLOCKS}) as int)").alias("__block"))
              .agg(F.collect_list(F.struct("query_id", "v", "n")).alias("__qs")))
    met = (vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("__v"),
                          F.explode(F.sequence(F.lit(0), F.lit(QUERY_BLOCKS - 1))).alias("__block"))
           .join(blocks, "__block"))
    scored = met.select("vec_id", F.explode(F.transform("__qs", lambda x: F.struct(
        x["query_id"].alias("query_id"), _cosine(F.col("__v"), x["v"], x["n"]).alias("s")))).alias("__m"))
    scored = (scored.select(F.col("__m.query_id").alias("query_id"), "vec_id", F.col("__m.s").alias("__s"))
              .filter(F.col("__s").isNotNull()).withColumn("__rs", round_half_even("__s", RANK_PLACES)))
    top = top_k_per(scored, "query_id", "__rs", "vec_id", k)
    return top.select("query_id", "vec_id", F.col("rank").cast("int").alias("rank"),
                      round_half_even("__s", places).alias("score"))


def vector_scores(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vec_col: str = "embedding",
                  query_id: str = "query_id", query_vec: str = "vector") -> DataFrame:
    """(query_id, vec_id, s): the cosine of every vector to every query. Zero
    vectors have no cosine and are left out.

    Queries are dealt into rows of about :data:`QUERY_ROWS`, each an array of
    queries; vectors meet every such row by an equi-join on its number (salted, so
    that all tasks take part) and are scored in the JVM.
    """
    blocks_n = max(1, -(-queries.count() // QUERY_ROWS))
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))
    blocks = (q.withColumn("n", norm).groupBy(F.expr(f"cast(pmod(xxhash64(query_id), {blocks_n}) as int)").alias("__block"))
              .agg(F.collect_list(F.struct("query_id", "v", "n")).alias("__qs"))
              .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(VECTOR_SALTS - 1)))))
    met = (vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("__v"),
                          F.expr(f"cast(pmod(xxhash64({vec_id}), {VECTOR_SALTS}) as int)").alias("__salt"),
                          F.explode(F.sequence(F.lit(0), F.lit(blocks_n - 1))).alias("__block"))
           .join(blocks, ["__block", "__salt"]))
    scored = met.select("vec_id", F.explode(F.transform("__qs", lambda x: F.struct(
        x["query_id"].alias("query_id"), _cosine(F.col("__v"), x["v"], x["n"]).alias("s")))).alias("__m"))
    return scored.select(F.col("__m.query_id").alias("query_id"), "vec_id", F.col("__m.s").alias("s")).filter("s is not null")


def _unit(batch, col: str) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, norms) of a list column."""
    raw = batch.column(col)
    flat = raw.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(batch.num_rows, -1)
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm == 0, 1, norm)[:, None], norm


def vector_clusters(vectors: DataFrame, clusters: int = VECTOR_CLUSTERS) -> tuple[DataFrame, np.ndarray, list]:
    """(vectors (vec_id, v, cluster), centres, [(cluster, radius, rows)]).

    Centres are the ``clusters`` vectors of smallest id hash: a fixed number
    (clusters x dimensions on the driver). A vector belongs to the centre of
    the smallest angle; the radius is the largest such angle of its members.
    """
    import pyarrow as pa
    picked = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(clusters).select("v").collect()
    if not picked:
        none = vectors.select("*", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("double").alias("angle"))
        return none, np.zeros((0, 0)), []
    centres = np.array([r[0] for r in picked], dtype=np.float64)
    centres = centres / np.sqrt((centres * centres).sum(axis=1))[:, None]

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit, _ = _unit(batch, "v")
            cosine = unit @ centres.T
            nearest = cosine.argmax(axis=1)
            angle = np.arccos(np.clip(cosine[np.arange(len(unit)), nearest], -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(angle)],
                                             [*batch.schema.names, "cluster", "angle"])
    schema = T_.StructType([*vectors.schema.fields, T_.StructField("cluster", T_.IntegerType()),
                            T_.StructField("angle", T_.DoubleType())])
    dealt = materialize(vectors.mapInArrow(assign, schema), "vector_clusters")
    shape = dealt.groupBy("cluster").agg(F.max("angle"), F.count(F.lit(1))).collect()     # at most ``clusters`` rows
    return dealt, centres, [tuple(r) for r in shape]


def _angles(queries: DataFrame, centres: np.ndarray, shape: list) -> DataFrame:
    """(query_id, cluster, bound, rows): the largest cosine that a member of the
    cluster can have to the query (triangle inequality on angles)."""
    import pyarrow as pa
    number = np.array([c for c, _, _ in shape], dtype=np.int32)
    radius, rows = np.array([r for _, r, _ in shape]), np.array([n for _, _, n in shape], dtype=np.int64)

    def bounds(batches):
        for batch in batches:
            if not batch.num_rows or not len(number):
                continue
            unit, _ = _unit(batch, "v")
            angle = np.arccos(np.clip(unit @ centres[number].T, -1, 1))
            bound = np.cos(np.maximum(0, angle - radius - 1e-7))
            at = np.repeat(np.arange(batch.num_rows), len(number))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id").take(pa.array(at)), pa.array(np.tile(number, batch.num_rows)),
                 pa.array(bound.ravel()), pa.array(angle.ravel()), pa.array(np.tile(rows, batch.num_rows))],
                ["query_id", "cluster", "bound", "angle", "rows"])
    kind = queries.schema["query_id"].dataType.simpleString()
    return queries.mapInArrow(bounds, f"query_id {kind}, cluster int, bound double, angle double, rows bigint")


def _best_in_clusters(dealt: DataFrame, visits: DataFrame, queries: DataFrame, shape: list, k: int) -> DataFrame:
    """(query_id, vec_id, s): the ``k`` best of each query in each block of the
    clusters it visits. A block has about :data:`VECTOR_ROWS` vectors and
    meets at most about :data:`QUERY_ROWS` queries at a time: one matrix product."""
    import pyarrow as pa
    splits = {c: max(1, -(-n // VECTOR_ROWS)) for c, _, n in shape}
    split = F.create_map(*[F.lit(x) for c, n in splits.items() for x in (c, n)]) if splits else None
    asked = visits.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).select(
        "cluster", F.ceil(F.col("n") / QUERY_ROWS).cast("int").alias("groups"))           # a row per cluster
    left = (dealt.join(asked, "cluster")
            .withColumn("block", F.pmod(F.xxhash64("vec_id"), split[F.col("cluster")]).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
            .select("cluster", "block", "part", "vec_id", "v"))
    right = (visits.join(asked, "cluster").join(queries, "query_id")
             .withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), split[F.col("cluster")] - 1)))
             .select("cluster", "block", "part", "query_id", "v"))
    kinds = dealt.schema["vec_id"].dataType.simpleString(), queries.schema["query_id"].dataType.simpleString()

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "s"]
        if not a.num_rows or not b.num_rows:
            return pa.table({"query_id": b["query_id"].slice(0, 0), "vec_id": a["vec_id"].slice(0, 0),
                             "s": pa.array([], pa.float64())})
        a = a.sort_by("vec_id").combine_chunks().to_batches()[0]
        b = b.combine_chunks().to_batches()[0]
        (x, _), (y, _) = _unit(a, "v"), _unit(b, "v")
        s = y @ x.T
        take = np.argsort(-np.rint(s * 10 ** RANK_PLACES), axis=1, kind="stable")[:, :k]    # ties: smaller vec_id
        rows = np.repeat(np.arange(len(y)), take.shape[1])
        return pa.table([b.column("query_id").take(pa.array(rows)), a.column("vec_id").take(pa.array(take.ravel())),
                         pa.array(s[rows, take.ravel()])], names=names)
    key = ["cluster", "block", "part"]
    return (left.groupBy(*key).cogroup(right.groupBy(*key))
            .applyInArrow(best, f"query_id {kinds[1]}, vec_id {kinds[0]}, s double"))


def vector_bounded(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vec_col: str = "embedding",
                   query_id: str = "query_id", query_vec: str = "vector", k: int = 5, places: int = 6,
                   clusters: int = VECTOR_CLUSTERS) -> DataFrame:
    """M4 for large tables: the rows of :func:`vector_top_k` from fewer pairs. Its
    jobs run when it is called. Zero vectors and
    vectors with null or non-finite components, or of other dimensions than the
    first query, have no cosine and are left out.

    Vectors lie in clusters with a centre and a radius. A query first scores its
    nearest cluster of ``k`` vectors or more; its k-th best there is a floor, and
    other clusters are scored only where the triangle inequality leaves a
    member that reaches it. Nothing is approximated.
    """
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("v"))
    dims = q.select(F.size("v")).limit(1).collect()
    dims = dims[0][0] if dims else 0
    fit = ((F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
           & F.exists("v", lambda x: x != 0))
    q = materialize(q.filter(fit), "vector_queries")
    x = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).filter(fit)
    dealt, centres, shape = vector_clusters(x, clusters)
    first, rest = vector_visits(dealt, centres, shape, q, k)
    found = first.unionByName(_best_in_clusters(dealt, rest, q, shape, k)) if shape else first
    scored = found.withColumn("__rs", round_half_even("s", RANK_PLACES))
    top = top_k_per(scored, "query_id", "__rs", "vec_id", k)
    return top.select("query_id", "vec_id", F.col("rank").cast("int").alias("rank"),
                      round_half_even("s", places).alias("score"))


def vector_visits(dealt: DataFrame, centres: np.ndarray, shape: list, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(scores of each query's first cluster, the other clusters it must visit
    as (query_id, cluster))."""
    bounds = materialize(_angles(queries, centres, shape), "vector_bounds")
    near = Window.partitionBy("query_id").orderBy((F.col("rows") < k).cast("int"), "angle", "cluster")
    ranked = bounds.withColumn("r", F.row_number().over(near))
    start = ranked.filter("r = 1").select("query_id", "cluster")
    if not shape:
        return queries.select("query_id", F.lit(None).cast(dealt.schema["vec_id"].dataType).alias("vec_id"),
                              F.lit(0.0).alias("s")).limit(0), start
    first = materialize(_best_in_clusters(dealt, start, queries, shape, k), "vector_first")
    order = Window.partitionBy("query_id").orderBy(F.col("s").desc(), "vec_id")
    floor = (first.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).filter(F.col("r") == k)
             .select("query_id", F.col("s").alias("floor")))
    rest = (ranked.filter("r > 1").join(floor, "query_id", "left")
            .filter(F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - 1e-8)).select("query_id", "cluster"))
    return first, rest


def centroids(vectors: DataFrame, group: str = "label", vec_col: str = "embedding") -> DataFrame:
    """Mean vector per group (element-wise), e.g. as query vectors for M4."""
    pe = vectors.select(group, F.posexplode(F.col(vec_col).cast("array<double>")).alias("pos", "x"))
    means = pe.groupBy(group, "pos").agg(F.avg("x").alias("m"))
    return (means.groupBy(group)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("__pm"))
            .select(F.col(group), F.transform("__pm", lambda s: s["m"]).alias("vector")))


# --------------------------------------------------------------------- M5

def rrf(rankings: Sequence["DataFrame | Ranking"], query_id: str = "query_id", item: str = "doc_id", rank: str = "rank",
        k: int = 10, c: int = RRF_K, places: int = 9) -> DataFrame:
    """M5: reciprocal rank fusion: score = sum over rankings of 1 / (c + rank)
    (an item missing from a ranking adds nothing); the ``k`` best per query.

    The rankings are unioned and summed per (query, item): an aggregation
    instead of a chain of full outer joins. :class:`Ranking` lists are not ranked as a
    whole but stopped early (:func:`rrf_top_k`).
    """
    if all(isinstance(r, Ranking) for r in rankings):
        return rrf_top_k(rankings, k=k, item=item, c=c, places=places)
    parts = [r.select(F.col(query_id).alias("query_id"), F.col(item).alias("item"),
                      (F.lit(1.0) / (F.lit(float(c)) + F.col(rank))).alias("__c")) for r in rankings]
    allr = parts[0]
    for p in parts[1:]:
        allr = allr.unionByName(p)
    fused = allr.groupBy("query_id", "item").agg(F.sum("__c").alias("__s"),
                                                 F.count(F.lit(1)).alias("n_lists"))
    fused = fused.withColumn("__rs", round_half_even("__s", RANK_PLACES))
    top = top_k_per(fused, "query_id", "__rs", "item", k)
    return top.select("query_id", F.col("item").alias(item), F.col("rank").cast("int").alias("rank"),
                      round_half_even("__s", places).alias("score"), F.col("n_lists").cast("long").alias("n_lists"))


def scored_list(scores: DataFrame, item: str = "doc_id", score: str = "s", query_id: str = "query_id") -> DataFrame:
    """A list for :func:`rrf_top_k` from scores: best (rounded) score first,
    ties to the smaller item."""
    return scores.select(F.col(query_id).alias("query_id"), F.col(item).alias("item"),
                         F.struct((-round_half_even(score, RANK_PLACES)).alias("less"), F.col(item).alias("tie")).alias("place"))


def best_part_list(scores: DataFrame, parent: Column, tie: Column, score: str = "s") -> DataFrame:
    """A list of parents from scores of their parts: a parent stands where its
    best part does. ``tie`` orders the parts of different parents as their ids
    do, from the parent alone (column ``item``)."""
    best = (scores.select("query_id", parent.alias("item"), (-round_half_even(score, RANK_PLACES)).alias("less"))
            .groupBy("query_id", "item").agg(F.min("less").alias("less")))
    return best.select("query_id", "item", F.struct("less", tie.alias("tie")).alias("place"))


def _ties(values):
    return values


def _item_spots(items, wanted) -> tuple[np.ndarray, np.ndarray]:
    """First and last place (end exclusive) of each wanted value among sorted items."""
    import pyarrow as pa
    import pyarrow.compute as pc
    code, names = _codes(pa.chunked_array([items, wanted]))
    code = np.argsort(pc.array_sort_indices(names, null_placement="at_start").to_numpy())[code]
    own, code = code[:len(items)], code[len(items):]
    return np.searchsorted(own, code, "left"), np.searchsorted(own, code, "right")


def _best_of(blocks, columns: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, less) of each query's ``depth`` smallest; equal ones by row."""
    less, row = [np.zeros(0) for _ in columns], [np.zeros(0, dtype=np.int64) for _ in columns]
    for first, m in blocks:
        m = np.ascontiguousarray(m.T)
        for i, own in enumerate(columns):
            x = m[own].T.ravel()
            at = np.flatnonzero(x < less[i][-1]) if len(less[i]) == depth else np.flatnonzero(~np.isnan(x))
            both, rows = np.concatenate([less[i], x[at]]), np.concatenate([row[i], first + at // len(own)])
            order = np.argsort(both, kind="stable")[:depth]
            less[i], row[i] = both[order], rows[order]
    return np.repeat(np.arange(len(columns)), [len(x) for x in less]), np.concatenate(row), np.concatenate(less)


def _found_at(blocks, columns: list[np.ndarray], who: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
    """(wanted item, less) of all entries of some wanted items (rows low to high of query ``who``)."""
    n = high - low
    which = np.repeat(np.arange(len(who)), n)
    row = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(which))
    n = np.array([len(x) for x in columns])[who[which]]
    column = np.concatenate([columns[i] for i in who[which]] or [np.zeros(0, dtype=np.int64)])
    which, row = np.repeat(which, n), np.repeat(row, n)
    found, less = [which[:0]], [np.zeros(0)]
    for first, m in blocks:
        at = np.flatnonzero((row >= first) & (row < first + len(m)))
        x = m[row[at] - first, column[at]]
        found.append(which[at][~np.isnan(x)])
        less.append(x[~np.isnan(x)])
    return np.concatenate(found), np.concatenate(less)


def _counted_before(blocks, columns: list[np.ndarray], who: np.ndarray, low: np.ndarray, less: np.ndarray) -> np.ndarray:
    """Number of entries before each mark: smaller, or equal in a row before ``low``."""
    n = np.zeros(len(who), dtype=np.int64)
    marks = [np.flatnonzero(who == i) for i in range(len(columns))]
    for first, m in blocks:
        m = np.ascontiguousarray(m.T)
        for own, mine in zip(columns, marks):
            if not len(mine):
                continue
            x = m[own].T.ravel()
            at = np.flatnonzero(~np.isnan(x))
            at = at[np.argsort(x[at], kind="stable")]
            x, row = x[at], first + at // len(own)
            a, b = np.searchsorted(x, less[mine], "left"), np.searchsorted(x, less[mine], "right")
            n[mine] += a
            for j in np.flatnonzero(b > a):
                n[mine[j]] += np.searchsorted(row[a[j]:b[j]], low[mine[j]], "left")
    return n


class Ranking:
    """Every query's whole list, neither stored nor sorted as a whole: rows are
    dealt into buckets that meet all queries, and a bucket gives the head of
    its own list, the scores of named items or the number of entries before
    given places. Only those are shuffled.

    ``left`` (rows) and ``asked`` (queries) hold ``__bucket``; ``matrices`` makes of a bucket
    (query of each column, items in their order, blocks of (first item, items x
    queries)); a value is the smaller the better, NaN where the item is not in the list.
    ``tie`` and ``order`` name what orders items of one value, for Arrow and Spark. An item
    comes up to ``times`` times in a list.
    """

    def __init__(self, left: DataFrame, asked: DataFrame, buckets: int, kinds: tuple[str, str], matrices,
                 tie=_ties, order: Column | None = None, times: int = 1, parents=None):
        self.left, self.asked, self.buckets, self.kinds, self.matrices = left, asked, buckets, kinds, matrices
        self.tie, self.order, self.times, self.parents = tie, F.col("item") if order is None else order, times, parents

    def _met(self, extra: DataFrame | None, depth: int = 0) -> DataFrame:
        """(query_id, item, less, n, m) of all buckets: without ``extra`` the heads; for
        ``extra`` rows of m = 0 the entries of the items, else the entries before ``less``."""
        import pyarrow as pa
        import pyarrow.compute as pc
        matrices, tie, some = self.matrices, self.tie, extra is not None
        right = self.asked
        if some:
            dealt = extra.withColumn("__bucket", F.explode(F.sequence(F.lit(0), F.lit(self.buckets - 1))))
            right = right.unionByName(dealt, allowMissingColumns=True)
        schema = f"query_id {self.kinds[0]}, item {self.kinds[1]}, less double, n bigint, m bigint"

        def table(query_id, item, less, n, m) -> pa.Table:
            return pa.table([query_id, item, pa.array(less, pa.float64()), pa.array(n, pa.int64()), pa.array(m, pa.int64())],
                            names=["query_id", "item", "less", "n", "m"])

        def picked(d: pa.Table, q: pa.Table) -> pa.Table:
            wanted = q.filter(pc.is_valid(q["m"])) if some else None
            asked = q.filter(pc.is_null(q["m"])) if some else q
            if not d.num_rows or not asked.num_rows or some and not wanted.num_rows:
                return table(q["query_id"].slice(0, 0), (d["whole"] if "whole" in d.column_names else d["doc_id"]).slice(0, 0), [], [], [])
            askers, items, blocks = matrices(d, asked)
            code, names = _codes(pa.chunked_array([askers]))
            columns = [np.flatnonzero(code == i) for i in range(len(names))]
            if not some:
                who, row, less = _best_of(blocks, columns, depth)
                return table(names.take(pa.array(who)), items.take(pa.array(row)), less, np.zeros(len(who)), np.zeros(len(who)))
            who = pc.fill_null(pc.index_in(wanted["query_id"].combine_chunks(), value_set=names), -1).to_numpy(zero_copy_only=False)
            wanted, who = wanted.filter(pa.array(who >= 0)).combine_chunks(), who[who >= 0]
            if not len(who):
                return table(q["query_id"].slice(0, 0), items.slice(0, 0), [], [], [])
            low, high = _item_spots(tie(items), tie(wanted["item"].combine_chunks()))
            m = wanted["m"].to_numpy()
            if not m.any():
                found, less = _found_at(blocks, columns, who, low, high)
                wanted = wanted.take(pa.array(found))
                return table(wanted["query_id"], wanted["item"], less, np.zeros(len(found)), np.zeros(len(found)))
            n = _counted_before(blocks, columns, who, low, wanted["less"].to_numpy())
            return table(wanted["query_id"], wanted["item"], wanted["less"].to_numpy(), n, m)
        return self.left.groupBy("__bucket").cogroup(right.groupBy("__bucket")).applyInArrow(picked, schema)

    def heads(self, depth: int) -> DataFrame:
        """(query_id, item, rank) of the first ``depth`` entries of each list."""
        window = Window.partitionBy("query_id").orderBy("less", self.order)
        return (self._met(None, depth).withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= depth)
                .select("query_id", "item", F.col("rank").cast("long").alias("rank")))

    def ranks(self, wanted: DataFrame) -> DataFrame:
        """(query_id, item, rank) of the wanted items that are in the lists."""
        found = self._met(wanted.select("query_id", "item", F.lit(None).cast("double").alias("less"), F.lit(0).cast("long").alias("m")))
        marks = found.groupBy("query_id", "item", "less").agg(F.count(F.lit(1)).alias("m"))
        counted = self._met(marks).groupBy("query_id", "item", "less").agg(F.sum("n").alias("n"), F.max("m").alias("m"))
        return counted.select("query_id", "item", F.explode(F.sequence(F.col("n") + 1, F.col("n") + F.col("m"))).alias("rank"))


class PlacedRows:
    """A list for :func:`rrf_top_k` from rows (query_id, item, place); within a query
    a smaller ``place`` is better, and no two are equal."""
    times = 1

    def __init__(self, rows: DataFrame):
        self.rows = materialize(rows.select("query_id", "item", "place"), "rrf_list")

    def heads(self, depth: int) -> DataFrame:
        window = Window.partitionBy("query_id").orderBy("place")
        return (self.rows.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= depth)
                .select("query_id", "item", F.col("rank").cast("long").alias("rank")))

    def ranks(self, wanted: DataFrame) -> DataFrame:
        return _counted_ranks(self.rows, wanted)


def _by_whole(blocks, group: np.ndarray):
    """Blocks of (first whole, places of wholes) from blocks of scores: the best
    part counts. A whole whose parts may go on in the next block is held back."""
    held = None
    for first, s in blocks:
        own = group[first:first + len(s)]
        best = np.maximum.reduceat(s, np.flatnonzero(np.diff(own, prepend=-1)), axis=0)
        if held is not None:
            if held[0] == own[0]:
                best[0] = np.maximum(best[0], held[1][0])
            else:
                yield held
        if len(best) > 1:
            yield own[0], best[:-1]
        held = own[-1], best[-1:]
    if held is not None:
        yield held


def bm25_ranking(docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                 query_id: str = "query_id", query_text: str = "query", k1: float = BM25_K1, b: float = BM25_B,
                 part_of: Column | None = None, tie=_ties, order: Column | None = None) -> Ranking:
    """M2: the rows of :func:`bm25_top_k` with k None, as a :class:`Ranking`. With
    ``part_of``, the list holds wholes, each where its best part stands."""
    left, asked, buckets = _bm25_places(docs, queries, doc_id, doc_text, query_id, query_text, k1, b, part_of)
    parts = part_of is not None

    def matrices(d, q) -> tuple:
        askers, _, group, wholes, blocks = _bm25_matrices(d, q, k1, parts, tie)
        placed = ((first, np.where(s > 0, -np.rint(s * 10 ** RANK_PLACES), np.nan)) for first, s in _by_whole(blocks, group))
        return askers, wholes, placed
    kinds = queries.schema[query_id].dataType.simpleString(), left.schema["whole" if parts else "doc_id"].dataType.simpleString()
    return Ranking(left, asked, buckets, kinds, matrices, tie, order, parents=lambda part_of, tie, order: bm25_ranking(
        docs, queries, doc_id, doc_text, query_id, query_text, k1, b, part_of, tie, order))


def _most_alike(df: DataFrame, key: str) -> int:
    """Rows of the most frequent key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1


def _query_load(queries: DataFrame, query_id: str, query_vec: str) -> tuple[int, int]:
    """(rows of the most frequent id, bytes of all vectors) of the queries."""
    size = F.greatest(F.size(query_vec), F.lit(0)) * 8 + 8
    n, size = (queries.groupBy(query_id).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size"))
               .agg(F.max("n"), F.sum("size")).first())
    return n or 1, size or 0


def vector_ranking(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vec_col: str = "embedding",
                   query_id: str = "query_id", query_vec: str = "vector") -> Ranking:
    """M4: the rows of :func:`vector_top_k` with k None, as a :class:`Ranking`. A bucket's
    cosines are matrix products. Two jobs run when it is called: ids that come
    several times are counted, and the bytes of the queries. (Queries are often picked
    from the vectors; by the size of their files the buckets would grow with its square.)"""
    import pyarrow as pa
    import pyarrow.compute as pc
    alike, query_bytes = _query_load(queries, query_id, query_vec)
    buckets = _buckets(vectors, queries, query_bytes)
    whole = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull())
    left = (vectors.select(F.pmod(F.xxhash64(vec_id), F.lit(buckets)).cast("int").alias("__bucket"), F.col(vec_id).alias("doc_id"),
                           F.col(vec_col).cast("array<double>").alias("v"))
            .filter(whole).repartition(buckets, "__bucket"))
    asked = (queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("v")).filter(whole)
             .withColumn("__bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))))

    def rows_of(lists, size: int) -> tuple[np.ndarray, np.ndarray]:
        x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        return x, np.sqrt((x * x).sum(axis=1))

    def matrices(d, q) -> tuple:
        d, q = d.combine_chunks(), q.combine_chunks()
        d = d.take(pc.array_sort_indices(d["doc_id"].combine_chunks(), null_placement="at_start"))
        v, asker = d["v"].combine_chunks(), q["v"].combine_chunks()
        wide = pc.list_value_length(asker).to_numpy()

        def blocks():
            step = max(1, SCORE_CELLS // len(asker))
            for first in range(0, len(v), step):
                some = v.slice(first, step)
                m = np.full((len(some), len(asker)), np.nan)
                size_of = pc.list_value_length(some).to_numpy()
                for size in np.unique(wide):                             # other dimensions have no cosine
                    row, column = np.flatnonzero(size_of == size), np.flatnonzero(wide == size)
                    (x, x_norm), (y, y_norm) = rows_of(some.take(pa.array(row)), size), rows_of(asker.take(pa.array(column)), size)
                    with np.errstate(all="ignore"):
                        norm = np.outer(x_norm, y_norm)
                        s = x @ y.T / norm
                        place = -np.rint(s * 10 ** RANK_PLACES)
                    place[np.isnan(s)] = -np.inf                         # as Spark sorts NaN, largest
                    place[norm == 0] = np.nan
                    m[np.ix_(row, column)] = place
                yield first, m
        return q["query_id"].combine_chunks(), d["doc_id"].combine_chunks(), blocks()
    kinds = queries.schema[query_id].dataType.simpleString(), vectors.schema[vec_id].dataType.simpleString()
    return Ranking(left, asked, buckets, kinds, matrices, times=_most_alike(vectors, vec_id) * alike)


def rrf_top_k(lists: Sequence[DataFrame | Ranking], k: int = 10, item: str = "doc_id", c: int = RRF_K, places: int = 9) -> DataFrame:
    """M5 with an early stop: the rows of :func:`rrf` without ranking whole
    lists. ``lists`` are :class:`Ranking` (one lazy plan) or rows of :class:`PlacedRows`
    (stored when it is called).

    An item below rank r in each of n lists scores at most n / (c + r + 1). The
    first k items of any list score at least 1 / (c + k), so with
    r >= n * (c + k) - c no item outside the first r of all lists can be among the k
    best (an item that comes several times in a list counts as often): only
    heads are ranked. A longer head leaves fewer places open; of the items whose
    bound still reaches the k-th best, the missing ranks are found by counting
    the entries before them.
    """
    stored = not all(isinstance(x, Ranking) for x in lists)
    lists = [x if isinstance(x, Ranking) else PlacedRows(x) for x in lists]
    depth = 2 * (sum(x.times for x in lists) * (c + k * max(x.times for x in lists)) - c)
    head = None
    for number, x in enumerate(lists):
        own = x.heads(depth).withColumn("list", F.lit(number))
        head = own if head is None else head.unionByName(own)
    known = head.groupBy("query_id", "item").agg(F.sum(F.lit(1.0) / (c + F.col("rank"))).alias("low"),
                                                 F.collect_list(F.struct("list", "rank")).alias("seen"))
    seen_in = F.transform("seen", lambda s: s["list"])
    missing = [F.lit(x.times) - F.size(seen_in) + F.size(F.array_remove(seen_in, n)) for n, x in enumerate(lists)]
    whole = Window.partitionBy("query_id")
    known = known.withColumn("r", F.row_number().over(whole.orderBy(F.col("low").desc(), "item")))
    known = known.withColumn("kth", F.max(F.when(F.col("r") == k, F.col("low"))).over(whole))
    high = F.col("low") + sum(missing) / F.lit(float(c + depth + 1))
    kept = known.filter(F.col("kth").isNull() | (high >= F.col("kth") - 1e-8)).select(
        "query_id", "item", "seen", F.array(*missing).alias("missing"))
    if stored:
        kept = materialize(kept, "rrf_open")
    parts = kept.select("query_id", "item", F.explode(F.filter(
        "seen", lambda s: F.get("missing", s["list"]) == 0)).alias("s")).select("query_id", "item", F.col("s.rank").alias("rank"))
    for number, x in enumerate(lists):
        parts = parts.unionByName(x.ranks(kept.filter(F.get("missing", F.lit(number)) > 0)).select("query_id", "item", "rank"))
    return rrf([parts], item="item", k=k, c=c, places=places).withColumnRenamed("item", item)


def _counted_ranks(x: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query_id, item, rank) of the ``wanted`` items that are in the list, by
    counting the rows with a smaller place."""
    found = x.join(wanted, ["query_id", "item"], "left_semi")
    marks = (found.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("place", "item"))).alias("marks")))
    # a row counts for all marks behind it: from the first mark with a larger place on
    first = F.size(F.filter("marks", lambda m: m["place"] <= F.col("place")))
    counts = (x.join(marks, "query_id").select("query_id", first.alias("at"))
              .groupBy("query_id", "at").agg(F.count(F.lit(1)).alias("n")))
    spots = marks.select("query_id", F.posexplode("marks").alias("at", "m")).select(
        "query_id", "at", F.col("m.item").alias("item"), F.lit(0).cast("long").alias("n"))
    both = spots.unionByName(counts.select("query_id", "at", F.lit(None).cast(x.schema["item"].dataType).alias("item"), "n"))
    ordered = Window.partitionBy("query_id").orderBy("at", F.col("item").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (both.withColumn("rank", F.sum("n").over(ordered) + 1).filter(F.col("item").isNotNull())
            .select("query_id", "item", "rank"))


# functions that run in Python workers travel with the job: workers need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
