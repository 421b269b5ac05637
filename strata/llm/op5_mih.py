"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes of ``BITS`` bits from rotations learned by iterative
quantisation (signs of the rotated, centred vector; as many rotations side by
side as fill the code). A code is cut into 16-bit substrings, and a block of
the index holds one table per substring from value to rows. By the pigeonhole
principle a code within Hamming radius R of the query's lies within
floor(R / m) of it in one of m substrings (in all but R mod m + 1 of them one
bit less), so probing the values in those small balls retrieves every code
within R. All rows so retrieved (those within R and others that share a
substring's ball) are ranked by the exact distance of the original vectors.

R grows per query until the distance of its k-th found row is settled: with
the rotations a radius is learned for each range of distances, the smallest
whose probes retrieve ``COVER`` of the sample's true neighbours at such
distances. A query stops when its radius reaches that of its k-th distance in
the block (and goes on to all rows where a block has fewer than k).

Only the rotations and R come from a bounded sample (``SAMPLE`` vectors with
the smallest hash of the id). Every valid row is indexed. Blocks of at most
``BLOCK`` rows and ``BLOCK_BYTES`` of vectors meet blocks of queries; each pair
of blocks is one group of bounded size, and k results per query and block go
on to the merge.

Vectors that are null, zero or hold null or non-finite components, rows
without an id, and vectors of another length than the most frequent one take
no part. Repeated ids are separate rows. Ties go to the smaller id. Extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm.common import map_batches, read, stored

BITS, WIDE = 512, 16         # bits of a code, and of a substring
SAMPLE = 4096
TRIALS = 256                # sample vectors that serve as queries to learn R
COVER = 0.95
RANGES = 8                  # ranges of distances that have a radius each
BLOCK, BLOCK_BYTES = 65536, 32_000_000
QUERY_BLOCK = 2048

_BY_COUNT = np.argsort(np.bitwise_count(np.arange(1 << WIDE, dtype=np.uint16)), kind="stable")
_SIZES = np.cumsum(np.bincount(np.bitwise_count(np.arange(1 << WIDE, dtype=np.uint16)), minlength=WIDE + 1))


def ball(reach: int) -> np.ndarray:
    """All substring values with at most ``reach`` bits."""
    return _BY_COUNT[:_SIZES[min(reach, WIDE)]]


@dataclass
class Codes:
    mean: np.ndarray
    rotations: np.ndarray       # (dim, BITS)
    edges: np.ndarray           # upper ends of the ranges of distances but the last
    radii: np.ndarray           # radius of each range, growing

    def radius(self, distance: float) -> int:
        return int(self.radii[np.searchsorted(self.edges, distance)])

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, bits / 8) code bytes."""
        return np.packbits((vectors - self.mean) @ self.rotations > 0, axis=1)


def learn(sample: np.ndarray, k: int) -> Codes:
    """Rotations by iterative quantisation, and the radius of each range of distances."""
    dim = sample.shape[1]
    mean = sample.mean(axis=0)
    x = sample - mean
    out = []
    for i in range(-(-BITS // dim)):
        rng = np.random.default_rng(i)
        r = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        for _ in range(20):
            u, _, vt = np.linalg.svd(np.where(x @ r > 0, 1.0, -1.0).T @ x)
            r = (u @ vt).T
        out.append(r)
    codes = Codes(mean, np.concatenate(out, axis=1)[:, :BITS], np.empty(0), np.array([BITS]))
    own = codes.of(sample).view(np.uint16)
    m = own.shape[1]
    far, need = [np.empty(0)], [np.empty(0)]
    for i in range(min(TRIALS, len(sample))):
        d = np.sqrt(((sample - sample[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(sample) - 1)]
        far.append(d[near])
        # a row that is b bits away in substring j is probed from radius b * m + j on
        need.append((np.bitwise_count(own[near] ^ own[i]).astype(np.int64) * m + np.arange(m)).min(axis=1))
    far, need = np.concatenate(far), np.concatenate(need)
    if len(need):
        ranges = np.array_split(np.argsort(far, kind="stable"), min(RANGES, len(need)))
        codes.edges = np.array([far[r[-1]] for r in ranges[:-1]])
        codes.radii = np.maximum.accumulate([int(np.ceil(np.quantile(need[r], COVER))) for r in ranges])
    return codes


class Tables:
    """The substring tables of one block of codes (rows of bytes, an even number)."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.ascontiguousarray(codes)
        parts = self.codes.view(np.uint16)
        self.m = parts.shape[1]
        self.rows = np.argsort(parts, axis=0, kind="stable").T.ravel()
        values = parts.astype(np.int64) + (np.arange(self.m) << WIDE)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(values.ravel(), minlength=self.m << WIDE))])

    def probe(self, query: np.ndarray, radius: int) -> np.ndarray:
        """All rows that the probes for ``radius`` retrieve: every code within
        it, and those that share a substring's ball."""
        part, rest = divmod(radius, self.m)
        value = query.view(np.uint16).astype(np.int64)
        hit = np.zeros(len(self.codes), dtype=bool)
        for reach, tables in ((part, range(0, rest + 1)), (part - 1, range(rest + 1, self.m))):
            for j in tables if reach >= 0 else ():
                at = (value[j] ^ ball(reach)) + (j << WIDE)
                start, end = self.first[at], self.first[at + 1]
                some = end > start
                start, size = start[some], (end - start)[some]
                hit[self.rows[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]] = True
        return np.flatnonzero(hit)

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code lies within ``radius`` of the query's."""
        found = self.probe(query, radius)
        return found[np.bitwise_count(self.codes[found] ^ query).sum(axis=1) <= radius]


def nearest(codes: Codes, tables: Tables, query_code: np.ndarray, query: np.ndarray, k: int, vectors: np.ndarray,
            skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, distances) of all rows that a query's probes retrieve, but those of ``skip``."""
    reach, last = int(codes.radii[0]), WIDE * tables.m
    while True:
        found = tables.probe(query_code, reach)
        found = found[~skip[found]]
        d = np.sqrt(((vectors[found] - query) ** 2).sum(axis=1))
        want = codes.radius(np.partition(d, k - 1)[k - 1]) if len(found) >= k else last
        if reach >= want:
            return found, d
        reach = min(reach + max(1, tables.m // 8), want) if len(found) >= k else min(reach + tables.m, last)


def search_block(codes: Codes, k: int, rows, ids, own, vectors, query_rows, query_codes, queries):
    """(query index, row index, distance) of each query's k nearest found in a block."""
    tables = Tables(own)
    out = []
    for i in range(len(query_rows)):
        found, d = nearest(codes, tables, query_codes[i], queries[i], k, vectors, rows == query_rows[i])
        best = np.lexsort((ids[found], d))[:k]
        out += [(i, found[b], d[b]) for b in best]
    return out


def valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).alias("id"), v.alias("v")).where(
        "id is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        "and exists(v, x -> x <> 0)")
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    top = size.first()
    return rows.where(F.size("v") == (top["n"] if top else 0))


def index(df: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, Codes | None]:
    """The stored index (row, id, code, v) of every valid row, and its codes."""
    rows = valid(df, id_col, vec_col)
    sample = [r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()]
    codes = learn(np.array(sample), k) if sample else None
    kind = rows.schema["id"].dataType.simpleString()

    def make():
        def fn(batch):
            v = np.array(batch.column("v").to_pylist(), dtype=np.float64)
            code = codes.of(v)
            return pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array([c.tobytes() for c in code], pa.binary()),
                 pa.array([x.tobytes() for x in v], pa.binary())], ["row", "id", "code", "v"])
        return fn
    coded = map_batches(rows.withColumn("row", F.monotonically_increasing_id()), make, f"row bigint, id {kind}, code binary, v binary")
    return stored(coded, "mih"), codes


def search(base: DataFrame, codes: Codes | None, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows of ``queries`` (rows of the
    index) against all rows of the index ``base``."""
    kind = base.schema["id"].dataType.simpleString()
    n, q = base.count(), queries.count()
    most = max(1, min(BLOCK, BLOCK_BYTES // (8 * codes.rotations.shape[0]))) if codes else BLOCK
    blocks, query_blocks = max(1, -(-n // most)), max(1, -(-q // min(most, QUERY_BLOCK)))
    left = (base.withColumn("block", F.expr(f"pmod(xxhash64(row), {blocks})"))
            .withColumn("against", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    right = (queries.select(*[F.col(c).alias(f"q_{c}") for c in ("row", "id", "code", "v")])
             .withColumn("against", F.expr(f"cast(pmod(xxhash64(q_row), {query_blocks}) as int)"))
             .withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)"))))
    ids = to_arrow_type(base.schema["id"].dataType)

    def matrix(table, name, kind):
        return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind).reshape(table.num_rows, -1)

    def block(key, rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.table({"query_row": pa.array([], pa.int64()), "query_id": pa.array([], ids), "row": pa.array([], pa.int64()),
                             "vec_id": pa.array([], ids), "score": pa.array([], pa.float64())})
        found = search_block(codes, k, rows.column("row").to_numpy(), rows.column("id").to_numpy(), matrix(rows, "code", np.uint8),
                                 matrix(rows, "v", np.float64), asked.column("q_row").to_numpy(), matrix(asked, "q_code", np.uint8),
                                 matrix(asked, "q_v", np.float64))
        a, b = pa.array([i for i, _, _ in found], pa.int64()), pa.array([j for _, j, _ in found], pa.int64())
        return pa.table({"query_row": asked.column("q_row").take(a), "query_id": asked.column("q_id").take(a),
                         "row": rows.column("row").take(b), "vec_id": rows.column("id").take(b),
                         "score": pa.array([float(d) for _, _, d in found], pa.float64())})
    found = (left.groupBy("block", "against").cogroup(right.groupBy("block", "against"))
             .applyInArrow(block, f"query_row bigint, query_id {kind}, row bigint, vec_id {kind}, score double"))
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy("score", "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, codes = index(read(spark, sf_dir, "embeddings"), 10)
    return search(base, codes, base.where("id % 100 = 0"), 10)
