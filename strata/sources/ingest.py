"""Bronze ingestion (A1-A4, A17): raw files or frames -> bronze with lineage."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.lake import Lake

# The columns of raw order records, in file order. Every column is
# text; the silver step does the typing.
ORDERS_RAW_COLUMNS = [
    "order_id",
    "customer_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "order_date",
    "shipping_city",
    "shipping_country",
    "payment_method",
    "status",
]
ORDERS_RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ORDERS_RAW_COLUMNS])


def run_timestamp() -> str:
    """One UTC ISO-8601 stamp per run (a literal, so recomputation after an
    executor loss yields the same value)."""
    return datetime.now(timezone.utc).isoformat()


def stamp_lineage(df: DataFrame, source: str | None = None, ingested_at: str | None = None) -> DataFrame:
    """A4: ``_ingested_at`` (run stamp), ``_source_file`` (``source``, else an
    existing ``_source_file`` column, else the file base name from the scan
    metadata), ``_source_path`` (its whole path, so that equal base names in two
    folders stay apart), ``_ingest_seq`` (position of the row in its source:
    increases with the file offset inside one file).
    """
    ts = ingested_at or run_timestamp()
    if source is not None:
        src = path = F.lit(source)
    elif "_source_file" in df.columns:
        src = F.col("_source_file")
        path = F.col("_source_path") if "_source_path" in df.columns else src
    else:
        src, path = F.col("_metadata.file_name"), F.col("_metadata.file_path")
    return df.withColumns({
        "_ingested_at": F.lit(ts),
        "_source_file": src,
        "_source_path": path,
        "_ingest_seq": F.monotonically_increasing_id(),
    })


def read_csv(spark: SparkSession, path: str, schema: T.StructType = ORDERS_RAW_SCHEMA) -> DataFrame:
    """A1 scan: header CSV with a declared schema (never inferred at scale).
    Quotes inside a field that is not quoted as a whole are kept as data."""
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("multiLine", False).csv(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """A2 scan: a JSON array of records (``multi_line``) or JSON Lines, which
    split across tasks and are preferred for large inputs."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def ingest_csv(lake: Lake, path: str, table: str, schema: T.StructType = ORDERS_RAW_SCHEMA,
               ingested_at: str | None = None) -> DataFrame:
    """A1: CSV -> bronze table (full overwrite); returns the stored table."""
    df = stamp_lineage(read_csv(lake.spark, path, schema), ingested_at=ingested_at)
    lake.write_parquet(df, "bronze", table)
    return lake.read_parquet("bronze", table)


def ingest_json(lake: Lake, path: str, table: str, schema: T.StructType, multi_line: bool = True,
                ingested_at: str | None = None) -> DataFrame:
    """A2: JSON -> bronze table."""
    df = stamp_lineage(read_json(lake.spark, path, schema, multi_line), ingested_at=ingested_at)
    lake.write_parquet(df, "bronze", table)
    return lake.read_parquet("bronze", table)


def ingest_dataframe(lake: Lake, df: DataFrame, table: str, source_label: str = "api",
                     ingested_at: str | None = None) -> DataFrame:
    """A3: an existing frame -> bronze table, labelled with ``source_label``."""
    lake.write_parquet(stamp_lineage(df, source_label, ingested_at), "bronze", table)
    return lake.read_parquet("bronze", table)


def ingest_all(lake: Lake, tables: dict[str, DataFrame | None], source_label: str = "api",
               ingested_at: str | None = None) -> dict[str, int]:
    """Land several tables; absent or empty ones are skipped (not
    written). Returns rows written per table, counted by the write job itself
    (``observe``), not by a second pass."""
    from strata.plans.metrics import StepMetrics
    metrics = StepMetrics()
    written = []
    for name, df in tables.items():
        if df is None or df.isEmpty():
            continue
        stamped = metrics.tap(stamp_lineage(df, source_label, ingested_at), name)
        lake.write_parquet(stamped, "bronze", name)
        written.append(name)
    values = metrics.values()
    return {name: values[name]["rows"] for name in written}
