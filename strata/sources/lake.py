"""Medallion lake layout and table I/O.

A table is a directory: ``<root>/<layer>/<table>/v<number>/`` for Parquet that
is replaced as a whole (the last version with a commit mark counts),
``<root>/<layer>/<table>/`` for Parquet written in parts, and ``<root>/<layer>/<table>__csv/`` for its CSV twin (the two
formats cannot share one directory). ``root`` may be any Hadoop file system
URI (``s3a://``, ``abfss://``, ``hdfs://``, ``file:``); existence checks,
listing and deletes go through the Hadoop ``FileSystem`` of the session, so
they work the same on a cluster as locally.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")
CSV_SUFFIX = "__csv"
# Versions of a table that is replaced as a whole, and the mark of a complete one.
VERSION_RE = re.compile(r"v\d{9}")
COMMITTED = "_COMMITTED"


class Lake:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str, fmt: str = "parquet") -> str:
        """``(layer, table)`` -> table directory."""
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{table}" + (CSV_SUFFIX if fmt == "csv" else "")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return hpath.getFileSystem(conf), hpath

    def _versions(self, path: str) -> list[str]:
        """Committed versions of a table, oldest first."""
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        jvm = self.spark.sparkContext._jvm
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return sorted(n for n in names if VERSION_RE.fullmatch(n)
                      and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/{COMMITTED}")))

    def current(self, layer: str, table: str) -> str:
        """The folder that holds the table's rows now: its last committed
        version, or the table's own folder where it is written in parts
        (stream batches, key buckets)."""
        path = self.path(layer, table)
        versions = self._versions(path)
        return f"{path}/{versions[-1]}" if versions else path

    def write_parquet(self, df: DataFrame, layer: str, table: str,
                      partition_by: list[str] | None = None) -> str:
        """A5: replace the whole table; returns its folder. The rows go into a
        version folder of their own, which counts from the moment its
        commit mark is there: a write that fails half-way leaves the former
        rows in place, and a reader keeps the version it was planned on (one
        former version is kept)."""
        path = self.path(layer, table)
        fs, p = self._fs(path)
        taken = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        numbers = [int(n[1:]) for n in taken if VERSION_RE.fullmatch(n)]
        if taken and not numbers:
            raise ValueError(f"{path} is written in parts; it cannot be replaced as a whole")
        target = f"{path}/v{max(numbers, default=0) + 1:09d}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(target)
        fs.create(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/{COMMITTED}"), True).close()
        keep = set(self._versions(path)[-2:])
        for name in taken:                         # older versions, and what failed writes left
            if VERSION_RE.fullmatch(name) and name not in keep:
                self.delete_path(f"{path}/{name}")
        return path

    def write_csv(self, df: DataFrame, layer: str, table: str) -> str:
        """CSV twin with header; array columns become comma-joined text."""
        out = df.select(*[
            F.array_join(F.col(f.name), ",").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in df.schema.fields])
        path = self.path(layer, table, "csv")
        out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        return path

    def read_parquet(self, layer: str, table: str) -> DataFrame:
        """A7."""
        return self.spark.read.parquet(self.current(layer, table))

    def read_csv(self, layer: str, table: str) -> DataFrame:
        """The CSV twin, every column as text (texts may hold line breaks)."""
        return (self.spark.read.option("header", True).option("escape", '"').option("multiLine", True)
                .csv(self.path(layer, table, "csv")))

    def read_or_empty(self, layer: str, table: str, schema: str | T.StructType) -> DataFrame:
        """A missing table reads as an empty frame with the declared schema."""
        if self.exists(layer, table):
            return self.read_parquet(layer, table)
        return self.spark.createDataFrame([], schema)

    def exists(self, layer: str, table: str) -> bool:
        """A9."""
        fs, p = self._fs(self.path(layer, table))
        return bool(fs.exists(p))

    def list_tables(self, layer: str) -> list[str]:
        """A10: table directories of a layer (CSV twins not listed)."""
        fs, p = self._fs(f"{self.root}/{layer}")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return sorted(n for n in names if not n.endswith(CSV_SUFFIX))

    def delete_table(self, layer: str, table: str) -> bool:
        """Remove the Parquet table (its CSV twin stays)."""
        fs, p = self._fs(self.path(layer, table))
        return bool(fs.delete(p, True)) if fs.exists(p) else False

    def folders(self, path: str) -> list[str]:
        """Names of the folders in a folder of the lake."""
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []

    def make_folder(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.mkdirs(p)

    def delete_path(self, path: str) -> bool:
        """Remove a folder of the lake (a partition, a run's scratch)."""
        fs, p = self._fs(path)
        return bool(fs.delete(p, True)) if fs.exists(p) else False

    def replace_path(self, source: str, path: str) -> None:
        """Move a folder or file of the lake to ``path``, in place of what is there."""
        fs, src = self._fs(source)
        dst = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs.mkdirs(dst.getParent())
        if fs.exists(dst):
            fs.delete(dst, True)
        if not fs.rename(src, dst):
            raise OSError(f"{source} could not be moved to {path}")

    def move_files(self, source: str, path: str, prefix: str = "") -> None:
        """Move the files of a folder into the folder ``path``, with ``prefix``
        before their names; a file that is already there is an error."""
        fs, src = self._fs(source)
        new = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(new(path))
        for status in fs.listStatus(src) if fs.exists(src) else []:
            target = new(f"{path}/{prefix}{status.getPath().getName()}")
            if fs.exists(target) or not fs.rename(status.getPath(), target):
                raise OSError(f"{status.getPath()} could not be moved to {path}")
