"""K1: incremental ingest of a landing folder with Structured Streaming.

The reference re-reads every source file on each scheduled run. Here each
run is a streaming query with ``trigger(availableNow=True)``: it processes
exactly the files that arrived since the previous run (the file-source
checkpoint remembers what was read), appends them to the bronze table and
stops. Each micro-batch is written with ``foreachBatch`` into its own
partition ``ingest_stream=<stream id>/ingest_batch=<batch id>`` in overwrite
mode: if a batch is run again after a failure it replaces its own earlier
output, so the append is exactly-once. The stream id lives in the checkpoint
(by default beside the table), so a new checkpoint, whose batch numbers start
at 0 again, never overwrites what another one wrote.

``merge_changes`` carries a batch on into silver without reading earlier batches:
the last raw copy per key is stored in key buckets (``bronze/<table>__latest``),
and a batch rewrites only the buckets of its keys there, in silver, and in the
partial sums of gold. Every step computes a bucket from what is stored and
the batch, so a batch that is run again after a failure gives the same buckets.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import keep_last
from strata.session import input_bytes, lean_writes
from strata.sources.ingest import ORDERS_RAW_SCHEMA, stamp_lineage
from strata.sources.lake import Lake


STREAM_COL, BATCH_COL = "ingest_stream", "ingest_batch"


def ingest_new_files(lake: Lake, landing_dir: str, table: str, schema: T.StructType = ORDERS_RAW_SCHEMA,
                     fmt: str = "csv", checkpoint: str | None = None, ingested_at: str | None = None,
                     max_files_per_trigger: int | None = None,
                     on_batch: Callable[[DataFrame], None] | None = None) -> int:
    """Append the files of ``landing_dir`` not seen by earlier runs to
    ``bronze/<table>``; returns the number of rows added by this run.
    ``on_batch`` gets the stored rows of each micro-batch (run again with the
    same rows if it fails)."""
    spark = lake.spark
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing_dir).withColumns({
        "_source_file": F.col("_metadata.file_name"), "_source_path": F.col("_metadata.file_path")})
    target = lake.path("bronze", table)

    started, stream_id, added = threading.Event(), [], []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        path = f"{target}/{STREAM_COL}={stream_id[0]}/{BATCH_COL}={batch_id}"
        with lean_writes(batch.sparkSession):
            stamp_lineage(batch, ingested_at=ingested_at).write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path)
        added.append(stored.count())
        if on_batch is not None and added[-1]:
            on_batch(stored)

    query = (stream.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint or f"{lake.root}/_streams/{table}")
             .trigger(availableNow=True)
             .start())
    stream_id.append(query.id)
    started.set()
    query.awaitTermination()
    return sum(added)


def read_bronze(lake: Lake, table: str, schema: T.StructType = ORDERS_RAW_SCHEMA) -> DataFrame:
    """The incrementally built bronze table (empty, with ``schema``, before the
    first file); stream and batch become the lineage columns
    ``_ingest_stream`` and ``_ingest_batch``."""
    lineage = [T.StructField(STREAM_COL, T.StringType()), T.StructField(BATCH_COL, T.IntegerType())]
    empty = T.StructType([*schema.fields, *lineage])
    return (lake.read_or_empty("bronze", table, empty).withColumnRenamed(STREAM_COL, "_ingest_stream")
            .withColumnRenamed(BATCH_COL, "_ingest_batch"))


LATEST = "__latest"
# Groups that the keys of a bucket are dealt to.
SALTS, _SALT = 64, "__strata_salt"
# Bytes of stored rows that are merged at a time (or one bucket), rounds up to which each
# reads the whole batch, and bucket files that a task writes side by side.
ROUND_BYTES = 2 << 30
SCAN_ROUNDS = 8
WRITERS = 64


def bucket_column(buckets: int) -> str:
    """Name of the partition column (it holds the number of buckets, so that
    a table is never read or written with another number)."""
    return f"bucket_of_{buckets}"


def merge_changes(lake: Lake, table: str, batch: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                  tidy: Callable[[DataFrame], DataFrame], buckets: int,
                  partials: Callable[[DataFrame, list[str]], dict[str, DataFrame]] | None = None) -> list[int]:
    """Merge raw rows into ``silver/<table>`` by key (K1, D1); returns the
    buckets that were rewritten. Files of other buckets are not touched.

    ``tidy`` makes silver rows from rows that are the last copy of their key;
    ``partials(silver, [bucket column])`` gives partial sums that are stored per
    bucket as ``gold/<name>__partial``. Choose ``buckets`` so that one is about
    1 GB (it is fixed with the first batch).

    Buckets are merged in rounds of about ROUND_BYTES of stored rows, so that only
    one round's shuffle files are on disk at a time. A bucket is replaced as a
    whole, so a batch that stopped between two rounds can be run again. For more
    than SCAN_ROUNDS rounds the batch is dealt into bucket files first.
    """
    spark, bucket, target = lake.spark, bucket_column(buckets), lake.path("bronze", f"{table}{LATEST}")
    tagged = batch.withColumn(bucket, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    with lean_writes(spark):
        changed = sorted(r[0] for r in tagged.select(bucket).distinct().collect())     # at most ``buckets`` numbers
    if not changed:
        return []
    if lake.exists("bronze", f"{table}{LATEST}") and bucket not in lake.read_parquet("bronze", f"{table}{LATEST}").columns:
        raise ValueError(f"{table}{LATEST} is stored with another number of buckets")
    share = input_bytes(spark, [unquote(f) for f in batch.inputFiles()]) / len(changed)
    rounds = _rounds({b: share + input_bytes(spark, f"{target}/{bucket}={b}") for b in changed})
    dealt = f"{lake.root}/_staged/{table}-{uuid.uuid4().hex}"
    with lean_writes(spark, WRITERS if buckets <= WRITERS else 0):
        if len(rounds) > SCAN_ROUNDS:
            tagged.write.partitionBy(bucket).parquet(dealt)
            tagged = spark.read.schema(tagged.schema).parquet(dealt)
        for some in rounds:
            _merge_buckets(lake, table, tagged.filter(F.col(bucket).isin(some)), keys, order_by, tidy, bucket, some, partials)
            for b in some:
                lake.delete_path(f"{dealt}/{bucket}={b}")
    lake.delete_path(dealt)
    return changed


def _rounds(sizes: dict[int, float]) -> list[list[int]]:
    """Buckets in groups of up to ROUND_BYTES (or of one bucket)."""
    out, room = [], 0
    for b, n in sorted(sizes.items()):
        if not out or n > room:
            out.append([])
            room = ROUND_BYTES
        out[-1].append(b)
        room -= n
    return out


def _merge_buckets(lake: Lake, table: str, tagged: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                   tidy: Callable[[DataFrame], DataFrame], bucket: str, changed: list[int],
                   partials: Callable[[DataFrame, list[str]], dict[str, DataFrame]] | None) -> None:
    """Merge the rows of some buckets."""
    spark, latest = lake.spark, f"{table}{LATEST}"
    if lake.exists("bronze", latest):
        old = lake.read_parquet("bronze", latest)
        tagged = old.filter(F.col(bucket).isin(changed)).unionByName(tagged, allowMissingColumns=True)
    # A bucket's keys are dealt to SALTS groups, so that no task holds a whole bucket; the window and the
    # writes keep that dealing. The last copies are stored once, beside the buckets they then replace.
    salted = tagged.withColumn(_SALT, F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(SALTS)).cast("int")).repartition(bucket, _SALT)
    last = keep_last(salted, [bucket, _SALT, *keys], order_by).drop(_SALT)
    _replace_buckets(lake, last, "bronze", latest, bucket, changed)
    stored = spark.read.schema(last.schema).parquet(lake.path("bronze", latest)).filter(F.col(bucket).isin(changed))
    tidied = tidy(stored)
    _replace_buckets(lake, tidied, "silver", table, bucket, changed)
    if partials is not None:
        silver = spark.read.schema(tidied.schema).parquet(lake.path("silver", table)).filter(F.col(bucket).isin(changed))
        for name, sums in partials(silver, [bucket]).items():
            _replace_buckets(lake, sums.repartition(bucket), "gold", f"{name}__partial", bucket, changed)


def _stored_buckets(lake: Lake, path: str, bucket: str) -> list[int]:
    """Numbers of the buckets that have a folder under ``path``."""
    return sorted(int(n.partition("=")[2]) for n in lake.folders(path) if n.startswith(f"{bucket}="))


def _replace_buckets(lake: Lake, df: DataFrame, layer: str, table: str, bucket: str, changed: list[int]) -> None:
    """Store the rows beside the table, then move each bucket into place; a changed
    bucket without rows (all of them filtered out) is removed."""
    staged, target = f"{lake.root}/_staged/{table}-{uuid.uuid4().hex}", lake.path(layer, table)
    df.write.partitionBy(bucket).parquet(staged)
    filled = set(_stored_buckets(lake, staged, bucket))
    lake.make_folder(target)
    for b in changed:
        if b in filled:
            lake.replace_path(f"{staged}/{bucket}={b}", f"{target}/{bucket}={b}")
        else:
            lake.delete_path(f"{target}/{bucket}={b}")
    lake.delete_path(staged)


def read_silver(lake: Lake, table: str, buckets: int) -> DataFrame:
    """The merged silver table, without its bucket column."""
    return lake.read_parquet("silver", table).drop(bucket_column(buckets))
