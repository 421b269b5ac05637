"""Sharding along a Hilbert curve.

Metadata columns are quantised to ``BITS`` bits each (text columns by the rank
of their value, sizes by logarithm), the cell's index on the Hilbert curve is
the sort key, and the sorted rows are cut into shards of equally many rows
(law ``rows``: counts at most one apart). Neighbours on the curve are
neighbours in every dimension, so a shard's file holds narrow ranges of all
of them and a reader can skip files by any.

Equal texts stand together: where their rows have different cells, all take the
smallest of them (their files hold a few more sources and languages for it), and
rows of one cell follow by crc32 and hash of the text, id and row. So only a
shard's border can part them. Runs come from range partitioning on the whole
key, so a frequent cell or text is spread over tasks. Null metadata has code 0; a null text has
size 8 and crc32 0; rows that share an id are separate rows; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import column_like, map_batches, numbered, ordered, read, stored

BITS = 8
SHARDS = 24
SALT = 64       # a repeated text's rows meet its cell in as many parts


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer cells (rows, dimensions)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    # undo the rotations of the nested curves, from the largest cell down
    for level in range(bits - 1, 0, -1):
        bit, below = np.int64(1 << level), np.int64((1 << level) - 1)
        for d in range(dims):
            upper = (x[d] & bit) != 0
            swap = np.where(upper, 0, (x[0] ^ x[d]) & below)
            x[0] = np.where(upper, x[0] ^ below, x[0] ^ swap)
            if d:
                x[d] ^= swap
    # Gray code over the dimensions
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[d] >> level) & 1)
    return out


def with_code(rows: DataFrame, col: str, out: str) -> DataFrame:
    """The rank of a text column's value among its values, scaled to BITS bits."""
    values = rows.select(F.col(col).alias("value")).where("value is not null").distinct()
    ranks = numbered(ordered(values, ["value"], "values"), ["value"])
    n = max(ranks.count(), 1)
    codes = ranks.select("value", F.expr(f"cast((rank * {1 << BITS}) div {n} as int)").alias(out))
    return rows.join(codes, F.col(col) == F.col("value"), "left").drop("value").fillna(0, [out])


def common_cells(cells: DataFrame) -> DataFrame:
    """``cells`` (stored rows with size, text_crc32, text_hash, d0, d1) with one
    (d0, d1) for all rows of a text: their smallest. Only texts that stand in
    several cells are joined, one row each; the join is salted by row, since one
    text may hold a third of all rows."""
    text = ["size", "text_crc32", "text_hash"]
    torn = (cells.groupBy(*text).agg(F.min(F.struct("d0", "d1")).alias("least"), F.max(F.struct("d0", "d1")).alias("most"))
            .where("least <> most").select(*text, "least", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")))
    salted = cells.withColumn("salt", F.expr(f"cast(pmod(xxhash64(row), {SALT}) as int)"))
    return (salted.join(torn, [*text, "salt"], "left").withColumns({d: F.coalesce(f"least.{d}", d) for d in ("d0", "d1")})
            .drop("least", "salt"))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(row, doc_id, size, text_crc32, hilbert, shard, slot) of every row of
    ``docs`` (doc_id, text, source, lang)."""
    return assign_rows(docs.select("doc_id", "text", "source", "lang", F.monotonically_increasing_id().alias("row")), shards)


def assign_rows(docs: DataFrame, shards: int) -> DataFrame:
    """``assign`` of rows (doc_id, text, source, lang, row) numbered by the caller."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "source", "lang", (F.octet_length(text) + 8).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"), "row")
    coded = with_code(with_code(rows, "source", "d0"), "lang", "d1").withColumn(
        "d2", F.least(F.floor(F.log2("size") * 8), F.lit((1 << BITS) - 1)).cast("int"))
    keep = ["row", "doc_id", "size", "text_crc32", "text_hash"]
    coded = common_cells(stored(coded.select(*keep, "d0", "d1", "d2"), "shard-cells"))

    def make():
        def fn(batch):
            cells = np.stack([batch.column(d).to_numpy(zero_copy_only=False) for d in ("d0", "d1", "d2")], axis=1)
            return pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(hilbert_index(cells, BITS))],
                                              [*keep, "hilbert"])
        return fn
    kind = rows.schema["doc_id"].dataType.simpleString()
    placed = map_batches(coded.select(*keep, "d0", "d1", "d2"), make,
                         f"row bigint, doc_id {kind}, size bigint, text_crc32 bigint, text_hash bigint, hilbert bigint")
    by = ["hilbert", "text_crc32", "text_hash", "doc_id", "row"]
    runs = ordered(placed, by, "shard-rows")
    n = runs.count()
    first = F.ceil(F.col("shard").cast("decimal(20,0)") * n / shards).cast("bigint")
    return (numbered(runs, by).withColumn("shard", F.expr(f"cast((rank * {shards}) div {max(n, 1)} as int)"))
            .withColumn("slot", F.col("rank") - first).drop("rank", "text_hash"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the rows of ``docs`` as one folder per shard, in curve order."""
    row, doc = column_like(docs.columns, "row"), column_like(docs.columns, "doc")
    # row numbers hold only within one read (they follow the splits), so the rows are written with theirs
    whole = stored(docs.select(F.monotonically_increasing_id().alias(row), F.struct(*docs.columns).alias(doc)), "shard-docs")
    placed = assign_rows(whole.select(*[f"{doc}.{c}" for c in ("doc_id", "text", "source", "lang")], F.col(row).alias("row")), shards).select(F.col("row").alias(row), "shard", "slot")
    (whole.join(placed, row).select(f"{doc}.*", "shard", "slot").repartitionByRange(shards, "shard", "slot")
     .sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
