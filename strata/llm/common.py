"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_root

# ASCII white space that separates words: x20 and x09 to x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table under ``spark.checkpoint.dir`` and read it back
    (cuts the lineage; a lost executor never recomputes what lies before)."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ordered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """``df`` written in runs: column ``run`` numbers the ranges of the total
    order ``by`` (end it with a unique column, so that a frequent value is
    split among runs)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(parts, *by).withColumn("run", F.spark_partition_id()), name)


def before(runs: DataFrame, value, group: list[str] | None = None) -> DataFrame:
    """(group..., run, before): sum of ``value`` over the earlier runs (one
    row per run and group goes through the window)."""
    group = group or []
    sums = runs.groupBy(*group, "run").agg(F.sum(value).alias("own"))
    window = Window.partitionBy(*group).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*group, "run", F.coalesce(F.sum("own").over(window), F.lit(0)).cast("bigint").alias("before"))


def numbered(runs: DataFrame, by: list[str], out: str = "rank") -> DataFrame:
    """Rows of ``ordered(..., by)`` with their position (from 0) in the order."""
    inside = F.row_number().over(Window.partitionBy("run").orderBy(*by))
    return (runs.join(F.broadcast(before(runs, F.lit(1))), "run")      # one row per run
            .withColumn(out, F.col("before") + inside - 1).drop("before", "run"))


def in_fold(col: str, modulus: int, remainder: int):
    """crc32 of the id as text, modulo; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % F.lit(modulus) == F.lit(remainder), F.lit(False))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
                schema, most: int = 8_000_000) -> DataFrame:
    """``mapInArrow`` with a function built once per task by ``make`` and
    applied to slices of about ``most`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        try:
            for batch in batches:
                for part in pieces(batch, most):
                    out = fn(part)
                    if out is not None and out.num_rows:
                        yield out
        finally:
            release()
    return df.mapInArrow(run, schema)


def release() -> None:
    """Give freed memory back to the system at the end of a task: workers outlive
    their tasks, and idle ones count among an executor's memory."""
    pa.default_memory_pool().release_unused()
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # not in every C library
    if trim:
        trim(0)


def pieces(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes each (at least one row), so
    that working memory is bounded by that size or by one row."""
    if batch.nbytes <= most or batch.num_rows <= 1:
        yield batch
        return
    half = batch.num_rows // 2
    yield from pieces(batch.slice(0, half), most)
    yield from pieces(batch.slice(half), most)


def texts_of(batch: pa.RecordBatch, col: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return ["" if t is None else t for t in batch.column(col).to_pylist()]


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS["p"] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
        _POWERS["q"] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]), dtype=np.uint64)
    return _POWERS["p"], _POWERS["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word (run of non-space bytes) of ``raw``.
    The 64-bit hash is a polynomial over the word's bytes from prefix sums,
    mixed with the word's length: equal words hash equally wherever they stand."""
    none = np.empty(0, dtype=np.int64)
    if not raw:
        return none.astype(np.uint64), none, none
    buf = np.frombuffer(raw, dtype=np.uint8)
    solid = np.zeros(len(buf) + 2, dtype=np.int8)
    np.logical_not(SPACE[buf], out=solid[1:-1].view(bool))
    edge = np.flatnonzero(np.diff(solid))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return none.astype(np.uint64), none, none
    p, q = _powers(len(buf))
    total = np.empty(len(buf) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * p[:len(buf)], out=total[1:])
    return (mix((total[end] - total[start]) * q[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)),
            start, end)


def word_hashes(raw: bytes) -> np.ndarray:
    return hashed_words(raw)[0]


def column_like(names: list[str], want: str) -> str:
    """A column name that does not clash with ``names`` (case-insensitively)."""
    taken = {n.lower() for n in names}
    while want.lower() in taken:
        want = "_" + want
    return want
