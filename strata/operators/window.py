"""Running totals without a single-partition window over the rows; H1/H2:
positions of the rows of a sorted table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.common import as_col
from strata.session import materialize


def running_total(df: DataFrame, order_col: str, value_col: str, out_col: str,
                  bucket: Column | None = None) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` over all rows with ``order_col``
    up to and including the current one (``order_col`` must be unique).

    Two-level prefix sum: a running sum inside each bucket (a window
    partitioned by the bucket, so it runs in parallel) plus the total of all
    earlier buckets. Only the per-bucket totals, one row per bucket, pass
    through a global window. ``bucket`` defaults to the calendar month of a
    date/timestamp ``order_col``.
    """
    if bucket is None:
        bucket = F.trunc(F.col(order_col).cast("date"), "month")
    b = "__bucket"
    with_b = df.withColumn(b, as_col(bucket))
    inner = Window.partitionBy(b).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = with_b.groupBy(b).agg(F.sum(value_col).alias("__bt"))
    offsets = totals.select(
        b, F.coalesce(F.sum("__bt").over(Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0)).alias("__off"))
    return (with_b.withColumn("__in", F.sum(value_col).over(inner))
            .join(offsets, b, "left")
            .withColumn(out_col, F.col("__off") + F.col("__in"))
            .drop(b, "__off", "__in"))


def positions(ordered: DataFrame, out_col: str = "position") -> DataFrame:
    """Add ``out_col`` = place of the row (from 1) in the order that the plan of
    ``ordered`` gives its rows.

    The sort is the only shuffle of the rows: each row is stored with its
    partition and its place in it, and the sizes of the earlier partitions, one
    row per partition, are added. Runs jobs (the rows are stored once, so that both
    reads see one numbering). An empty table stays empty.
    """
    part, place = "__part", "__place"
    rows = materialize(ordered.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id()}), "ordered")
    rows = rows.withColumn(place, F.col(place).bitwiseAND(F.lit((1 << 33) - 1)))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias("__n")).select(
        part, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    return (rows.join(sizes, part)
            .withColumn(out_col, (F.col("__before") + F.col(place) + 1).cast("long"))
            .drop(part, place, "__before"))
