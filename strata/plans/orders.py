"""Orders: bronze -> silver cleaning and the four gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import coerce as C
from strata.functions import text as T
from strata.operators.dedup import drop_meta, keep_last, lineage_order
from strata.operators.window import running_total
from strata.plans.metrics import StepMetrics



def clean_orders(bronze: DataFrame, order_by: Sequence[Column | str] | None = None,
                 metrics: StepMetrics | None = None) -> DataFrame:
    """Silver orders.

    * keep the last row per ``order_id`` (D1; before the cancelled filter, so
      an order whose last copy is cancelled disappears),
    * drop lineage columns, coerce types (bad quantity -> 0, bad price -> 0.0,
      bad date -> null), ``total_amount = round(quantity * unit_price, 2)``,
    * standardise country (upper), category (title case), status (lower),
    * drop cancelled rows (null status stays).

    ``metrics`` (L3) gets rows in (``bronze``) and rows after keep-last with the
    number of cancelled rows (``deduped``), counted by the job that
    materialises the result; see :func:`order_step_counts`.
    """
    order_by = list(order_by) if order_by is not None else lineage_order(bronze)
    src = bronze if metrics is None else metrics.tap(bronze, "bronze")
    return tidy_orders(keep_last(src, ["order_id"], order_by), metrics)


def tidy_orders(deduped: DataFrame, metrics: StepMetrics | None = None) -> DataFrame:
    """The row-wise part of :func:`clean_orders`, for rows that are already the
    last of their ``order_id``."""
    typed = drop_meta(deduped).withColumns({
        "order_date": C.to_timestamp_or_null("order_date"),
        "quantity": C.to_long_or_zero("quantity"),
        "unit_price": C.to_double_or_zero("unit_price"),
    })
    std = typed.withColumns({
        "total_amount": C.round_half_even(F.col("quantity") * F.col("unit_price"), 2),
        "shipping_country": T.upper_strip("shipping_country"),
        "category": T.strip_title("category"),
        "status": T.lower_strip("status"),
    })
    cancelled = F.col("status").eqNullSafe("cancelled")
    if metrics is not None:
        std = metrics.tap(std, "deduped", cancelled=cancelled)
    return std.filter(~cancelled)


def order_step_counts(metrics: StepMetrics) -> dict[str, int]:
    """Rows in, duplicates removed, cancelled removed, rows out."""
    v = metrics.values()
    rows_in, rows_dedup = v["bronze"]["rows"], v["deduped"]["rows"]
    cancelled = v["deduped"]["cancelled"]
    return {"rows_in": rows_in, "duplicates_removed": rows_in - rows_dedup,
            "cancelled_removed": cancelled, "rows_out": rows_dedup - cancelled}


# What each gold table F10-F12 sums per key: all of it adds up over any split of
# the orders, so partial sums can be stored and merged.
_KEYS = {"revenue_by_country": "shipping_country", "revenue_by_category": "category", "daily_revenue": "order_day"}


def _sums(name: str, unique_orders: bool) -> dict[str, Column]:
    price = F.col("unit_price").try_cast("decimal(28,6)")
    sums = {"_cents": C.sum_cents("total_amount"),
            "_orders": (F.count("order_id") if unique_orders else F.count_distinct("order_id")).cast("long")}
    if name == "revenue_by_country":
        sums["_n"] = F.count(C.to_cents("total_amount"))
    elif name == "revenue_by_category":
        sums |= {"_units": F.sum("quantity"), "_price": F.sum(price), "_prices": F.count(price)}
    return sums


def _summed(silver: DataFrame, name: str, unique_orders: bool, by: Sequence[str] = ()) -> DataFrame:
    key = _KEYS[name]
    if name == "daily_revenue":
        silver = silver.withColumn(key, F.to_date("order_date"))
    aggs = [c.alias(n) for n, c in _sums(name, unique_orders).items()]
    return silver.filter(F.col(key).isNotNull()).groupBy(*by, key).agg(*aggs)


def _finished(name: str, t: DataFrame) -> DataFrame:
    """The gold table from its sums per key."""
    orders = F.col("_orders").cast("long").alias("order_count")
    revenue = C.cents_to_money("_cents").alias("total_revenue")
    if name == "revenue_by_country":
        mean = C.round_half_even(F.try_divide(C.cents_to_money("_cents"), F.col("_n")), 2)
        return (t.select("shipping_country", revenue, orders, mean.alias("avg_order_value"))
                .orderBy(F.col("total_revenue").desc(), F.col("shipping_country")))
    if name == "revenue_by_category":
        mean = C.round_half_even(F.try_divide(F.col("_price").cast("double"), F.col("_prices")), 2)
        return (t.select("category", revenue, orders, F.col("_units").cast("long").alias("total_units"),
                         mean.alias("avg_unit_price"))
                .orderBy(F.col("total_revenue").desc(), F.col("category")))
    return (running_total(t, "order_day", "_cents", "_cum_cents")
            .select("order_day", C.cents_to_money("_cents").alias("daily_revenue"), orders,
                    C.cents_to_money("_cum_cents").alias("cumulative_revenue"))
            .orderBy("order_day"))


def gold_partials(silver: DataFrame, by: Sequence[str]) -> dict[str, DataFrame]:
    """Partial sums of F10-F12 per value of the columns ``by`` (for silver with
    one row per order whose copies never lie in two values of ``by``)."""
    return {name: _summed(silver, name, True, by) for name in _KEYS}


def gold_from_partials(partials: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """F10-F12 from stored partial sums, without reading any order."""
    out = {}
    for name, t in partials.items():
        measures = list(_sums(name, True))
        out[name] = _finished(name, t.groupBy(_KEYS[name]).agg(*[F.sum(c).alias(c) for c in measures]))
    return out


def revenue_by_country(silver: DataFrame, unique_orders: bool = False) -> DataFrame:
    """per country total revenue, distinct orders, mean order value.
    ``unique_orders``: the rows are known to have one row per order (as
    :func:`clean_orders` leaves them), so no order id is shuffled."""
    return _finished("revenue_by_country", _summed(silver, "revenue_by_country", unique_orders))


def revenue_by_category(silver: DataFrame, unique_orders: bool = False) -> DataFrame:
    """per category revenue, distinct orders, units, mean unit price."""
    return _finished("revenue_by_category", _summed(silver, "revenue_by_category", unique_orders))


def daily_revenue(silver: DataFrame, unique_orders: bool = False) -> DataFrame:
    """F12 + G1: revenue and orders per day, with the running total of the
    (rounded) daily revenue in day order."""
    return _finished("daily_revenue", _summed(silver, "daily_revenue", unique_orders))


def top_customers(silver: DataFrame, top_n: int = 10, unique_orders: bool = False) -> DataFrame:
    """the ``top_n`` customers by total spend, with order count, first and
    last order and favourite category (F5: most frequent, ties -> smallest,
    none -> ``Unknown``).

    Plan: silver is read once. Sums per (customer, category) come from the
    partial aggregation before the shuffle; a second aggregation per customer
    adds them up and takes the most frequent category, and the ``top_n`` best are
    kept per task first. On frames where an order may have several rows
    (``unique_orders`` false) the distinct order ids are counted beside.
    """
    if top_n < 1:
        raise ValueError("top_n must be at least 1")
    known = silver.filter(F.col("customer_id").isNotNull())
    parts = known.groupBy("customer_id", "category").agg(
        C.sum_cents("total_amount").alias("_cents"), F.count("order_id").alias("_orders"), F.count(F.lit(1)).alias("_rows"),
        F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"))
    rank = F.when(F.col("category").isNotNull(), F.struct((-F.col("_rows")).alias("less"), "category"))
    totals = parts.groupBy("customer_id").agg(
        F.sum("_cents").alias("_cents"), F.sum("_orders").alias("_orders"), F.min("first_order").alias("first_order"),
        F.max("last_order").alias("last_order"), F.min(rank)["category"].alias("_fav"))
    top = totals.orderBy(F.col("_cents").desc(), F.col("customer_id")).limit(top_n)
    if not unique_orders:
        ids = (known.join(top.select("customer_id"), "customer_id", "left_semi")
               .groupBy("customer_id").agg(F.count_distinct("order_id").alias("_orders")))
        top = top.drop("_orders").join(ids, "customer_id", "left")
    return (top.select("customer_id",
                       C.cents_to_money("_cents").alias("total_spend"),
                       F.col("_orders").cast("long").alias("order_count"),
                       "first_order", "last_order",
                       F.coalesce(F.col("_fav"), F.lit("Unknown")).alias("favorite_category"))
            .orderBy(F.col("total_spend").desc(), F.col("customer_id")))


def build_gold(silver: DataFrame, top_n: int = 10, unique_orders: bool = False) -> dict[str, DataFrame]:
    """The four gold tables of the orders pipeline."""
    return {
        "revenue_by_country": revenue_by_country(silver, unique_orders),
        "revenue_by_category": revenue_by_category(silver, unique_orders),
        "daily_revenue": daily_revenue(silver, unique_orders),
        "top_customers": top_customers(silver, top_n, unique_orders),
    }
