"""Aggregation helpers (F1-F5) with exact, order-independent results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.common import as_col


def exact_sum_double(c, scale: int = 6) -> Column:
    """Sum of doubles through ``decimal(28, scale)``: the same result whatever
    order the tasks add in (float sums drift in the last bits). Values that do
    not fit or are not finite are left out; see :func:`exact_mean`."""
    return F.sum(as_col(c).try_cast(f"decimal(28,{scale})")).cast("double")


def exact_mean(c, scale: int = 6) -> Column:
    """mean of the values that :func:`exact_sum_double` adds up (the same
    rule for sum and count)."""
    d = as_col(c).try_cast(f"decimal(28,{scale})")
    return F.try_divide(F.sum(d).cast("double"), F.count(d))


def distinct_count(c, approx: bool = False, rsd: float = 0.05) -> Column:
    """number of distinct non-null values (``nunique``). ``approx=True``
    uses HyperLogLog++ (``approx_count_distinct``, relative standard deviation
    ``rsd``): fixed-size buffers and no extra shuffle for very large groups."""
    c = as_col(c)
    return F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)


def mode_by_group(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """most frequent non-null ``value`` per ``key``; ties go to the smallest
    value. Keys whose values are all null are absent (callers left-join and
    fill their default, e.g. ``"Unknown"``).

    Counted as ``groupBy(key, value).count()`` (map-side partial aggregation,
    so a hot key is reduced before the shuffle), then top-1 per key over at
    most (distinct values of that key) rows.
    """
    out = out or f"mode_{value}"
    counts = (df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
              .groupBy(key, value).agg(F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy(key).orderBy(F.col("__n").desc(), F.col(value).asc())
    return (counts.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
            .select(key, F.col(value).alias(out)))


__all__ = ["distinct_count", "exact_mean", "exact_sum_double", "mode_by_group"]
