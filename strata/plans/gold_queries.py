"""Parameterised queries over the gold tables.

Each query filters a gold table with literal parameters (pushed into the
Parquet scan when the table is read from storage) and returns a DataFrame;
:func:`to_json_records` turns any result into JSON records without collecting
it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import orders as orders_plan

ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS"
# ISO dates and times; null fields written as null (not left out).
JSON_OPTIONS = {"timestampFormat": ISO_TIMESTAMP, "timestampNTZFormat": ISO_TIMESTAMP, "dateFormat": "yyyy-MM-dd",
                "ignoreNullFields": "false"}
# Money columns of the gold tables: written to JSON as decimals with two
# places (plain digits, e.g. 17533562241.92, rather than a double's 1.75E10).
MONEY_COLUMNS = ("total_revenue", "avg_order_value", "avg_unit_price", "daily_revenue", "cumulative_revenue",
                 "total_spend")

# Sort order that defines "the first rows" of each gold table.
# (column, descending) pairs.
GOLD_ORDER = {
    "revenue_by_country": [("total_revenue", True), ("shipping_country", False)],
    "revenue_by_category": [("total_revenue", True), ("category", False)],
    "daily_revenue": [("order_day", False)],
    "top_customers": [("total_spend", True), ("customer_id", False)],
}


def gold_order(name: str, columns: list[str]):
    spec = GOLD_ORDER.get(name, [(c, False) for c in columns])
    return [F.col(c).desc() if desc else F.col(c).asc() for c, desc in spec]


class UnknownTable(KeyError):
    pass


def gold_table(store: Mapping[str, DataFrame], name: str) -> DataFrame:
    """A gold table from a name -> DataFrame store; an unknown name raises
    :class:`UnknownTable` (see :func:`error_record`)."""
    if name not in store:
        raise UnknownTable(name)
    return store[name]


def error_record(name: str) -> str:
    # fixed value: the text of the error record
    return json.dumps({"error": f"{name} data not loaded"})


def answer(spark: SparkSession, store: Mapping[str, DataFrame], name: str,
           query: Callable[[DataFrame], DataFrame] = lambda gold: gold, col: str = "record") -> DataFrame:
    """L4: the records of ``query`` over a gold table as JSON, one per row; an
    unknown table gives the error record as the only row."""
    if name not in store:
        return spark.createDataFrame([(error_record(name),)], f"{col} string")
    return to_json_records(query(store[name]), col)


def query_revenue_by_country(gold: DataFrame, country: str | None = None) -> DataFrame:
    """Optional country code, compared upper-cased; none = all rows."""
    return gold if not country else gold.filter(F.col("shipping_country") == F.lit(country.upper()))


def query_revenue_by_category(gold: DataFrame, category: str | None = None) -> DataFrame:
    """Optional category, compared case-insensitively; none = all rows."""
    if not category:
        return gold
    return gold.filter(F.lower(F.col("category")) == F.lit(category.lower()))


def query_daily_revenue(gold: DataFrame, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """C4: days in [start_date, end_date], both ends optional and inclusive."""
    out = gold
    if start_date:
        out = out.filter(F.col("order_day") >= F.lit(start_date).cast("date"))
    if end_date:
        out = out.filter(F.col("order_day") <= F.lit(end_date).cast("date"))
    return out


def query_top_customers(silver_or_gold: DataFrame, top_n: int = 10, unique_orders: bool = False) -> DataFrame:
    """H4: the first ``top_n`` (1..50) customers by spend. Given silver orders
    the ranking is computed for exactly ``top_n``; given a stored gold table it
    is re-sorted and cut (so at most the stored rows come back)."""
    if not 1 <= top_n <= 50:
        raise ValueError("top_n must be in 1..50")
    if "total_amount" in silver_or_gold.columns:
        return orders_plan.top_customers(silver_or_gold, top_n, unique_orders)
    return silver_or_gold.orderBy(*gold_order("top_customers", silver_or_gold.columns)).limit(top_n)


def json_fields(df: DataFrame) -> list:
    """The columns of ``df`` as JSON fields: money columns as two-place
    decimals, the rest as they are."""
    out = []
    for f in df.schema.fields:
        if f.name in MONEY_COLUMNS and isinstance(f.dataType, T.DoubleType):
            out.append(F.col(f.name).cast("decimal(38,2)").alias(f.name))
        else:
            out.append(F.col(f.name))
    return out


def to_json_records(df: DataFrame, col: str = "record") -> DataFrame:
    """One JSON object per row (ISO dates, money with two places),
    computed on the executors."""
    return df.select(F.to_json(F.struct(*json_fields(df)), JSON_OPTIONS).alias(col))


def data_summary(store: Mapping[str, DataFrame], sample_rows: int = 3) -> DataFrame:
    """One row per gold table: name, row count, column names, and the
    first ``sample_rows`` rows (by the table's defined order) as a JSON array.

    Per table: one count aggregate and one bounded top-``sample_rows``; the
    two one-row parts are unioned and folded into one row.
    """
    parts = []
    for name, df in store.items():
        order = gold_order(name, df.columns)
        top = df.orderBy(*order).limit(sample_rows)
        ranked = top.withColumn("__i", F.row_number().over(Window.orderBy(*order)))
        sample = ranked.agg(
            F.lit(None).cast("long").alias("row_count"),
            F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("__i", F.struct(*json_fields(df)).alias("r")))),
                                  lambda x: x["r"]), JSON_OPTIONS).alias("sample"))
        count = df.agg(F.count(F.lit(1)).alias("row_count"), F.lit(None).cast("string").alias("sample"))
        parts.append(count.unionByName(sample).agg(
            F.lit(name).alias("table_name"), F.max("row_count").alias("row_count"),
            F.lit(",".join(df.columns)).alias("column_names"), F.max("sample").alias("sample")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
