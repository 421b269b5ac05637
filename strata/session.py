"""Spark session defaults used by the library, tests and the bench."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that ``to_date`` of an ISO-8601 time
# with an offset gives the UTC day, ANSI on (Spark 4 default; bad casts must be
# explicit ``try_*``), adaptive execution for runtime re-planning of joins,
# partition counts and skewed shuffle partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "strata") -> SparkSession:
    """Return (or create) a session with the library defaults.

    On a cluster the session already exists and only the defaults that are
    not set yet are applied. ``master``/``shuffle_partitions`` are for local
    runs (tests, bench).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
        # Local runs only: a scratch checkpoint folder when none is configured.
        if (master.startswith("local") and not SparkSession.getActiveSession()
                and not builder._options.get("spark.checkpoint.dir")):
            builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strata-ckpt-"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's session settings to an existing session
    (idempotent): results depend on the session time zone being UTC."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The setting is read from the session (on a cluster the platform points it
    at a shared file system). Where it is unset, a local session (tests) gets a
    scratch folder and any other session an error: executors cannot share a
    folder of one machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    if sc is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return root
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def materialize(df, name: str = "table"):
    """Cut the lineage of ``df`` by writing it as Parquet under the shared
    checkpoint folder and reading it back (a new folder per call). Columnar,
    compressed and pruned on read, unlike an RDD checkpoint; recomputation
    after a lost executor starts from these files."""
    import uuid
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def set_for(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the jobs of a ``with`` block; the former ones come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def lean_writes(spark: SparkSession, writers: int = 0):
    """For jobs that store tables of the input's size one after another: each one's
    shuffle files go as it ends (Spark otherwise keeps them until the driver's
    garbage collection finds them unused), and what is stored is packed
    closer. Up to ``writers`` partitions are written side by side, without a sort."""
    return set_for(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                           "spark.sql.parquet.compression.codec": "zstd",
                           "spark.sql.maxConcurrentOutputFileWriters": str(writers)})


# Target bytes of input per shuffle partition / scan split at scale.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (Hadoop content summary: a
    metadata call, no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += int(fs.getContentSummary(hp).getLength())
    return total


@contextmanager
def tuned_for(spark: SparkSession, paths, target_bytes: int = TARGET_PARTITION_BYTES):
    """:func:`tune_for_input` for the jobs of a ``with`` block; the session's
    own settings come back afterwards."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        yield tune_for_input(spark, paths, target_bytes)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def tune_for_input(spark: SparkSession, paths, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Size shuffles for the input: ``spark.sql.shuffle.partitions`` becomes
    about input bytes / ``target_bytes`` (never lowered below its current
    value), so no shuffle partition outgrows executor memory and spills at
    100 TB; AQE then coalesces small partitions back to
    ``advisoryPartitionSizeInBytes``. Returns the partition count in use."""
    import math
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, math.ceil(input_bytes(spark, paths) / target_bytes))
    if wanted != current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    return wanted
