"""Orders pipeline: golden values of the 30-row sample (FIXTURES §1), traps, properties."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.plans import orders as P
from strata.plans.metrics import StepMetrics
from strata.sources import ingest
from strata.sources import testdata as TD

@pytest.fixture(scope="module")
def sample_silver(spark, sample_csv):
    bronze = ingest.stamp_lineage(ingest.read_csv(spark, sample_csv), ingested_at="2024-02-01T00:00:00")
    return P.clean_orders(bronze).cache()


def test_sample_silver(sample_silver):
    got = {r["order_id"]: r["total_amount"] for r in sample_silver.collect()}
    assert got == {"O1": 21.0, "O2": 100.0, "O3": 21.0, "O5": 100.0, "O6": 10.5}   # O3 twice, O4 cancelled


def test_sample_revenue(sample_silver):
    assert [tuple(r) for r in P.revenue_by_country(sample_silver).collect()] == [
        ("DE", 200.0, 2, 100.0), ("US", 52.5, 3, 17.5)]
    assert [tuple(r) for r in P.revenue_by_category(sample_silver).collect()] == [
        ("Furniture", 200.0, 2, 5, 62.5), ("Electronics", 52.5, 3, 7, 8.75)]


def test_sample_daily_revenue(sample_silver):
    got = [(str(r[0]), *r[1:]) for r in P.daily_revenue(sample_silver).collect()]
    assert got == [("2024-01-01", 121.0, 2, 121.0), ("2024-01-02", 21.0, 1, 142.0), ("2024-01-03", 110.5, 2, 252.5)]


def test_sample_top_customers(sample_silver):
    got = [(r["customer_id"], r["total_spend"], r["order_count"], r["favorite_category"])
           for r in P.top_customers(sample_silver, 10).collect()]
    assert got == [("C1", 131.5, 3, "Electronics"), ("C3", 100.0, 1, "Furniture"), ("C2", 21.0, 1, "Electronics")]
    assert P.top_customers(sample_silver, 200_000).count() == 3


def test_metrics_from_one_job(spark, sample_csv):
    bronze = ingest.stamp_lineage(ingest.read_csv(spark, sample_csv), ingested_at="t")
    m = StepMetrics()
    P.clean_orders(bronze, metrics=m).write.format("noop").mode("overwrite").save()
    assert P.order_step_counts(m) == {"rows_in": 7, "duplicates_removed": 1, "cancelled_removed": 1, "rows_out": 5}


def test_absurd_prices_do_not_fail_the_job(spark):
    rows = [("A", "C1", "p", "a", "1", "1e30", "2024-01-01", "x", "us", "m", "completed", 1),
            ("B", "C1", "p", "a", "1", "5.0", "2024-01-01", "x", "us", "m", "completed", 2),
            ("C", "C1", "p", "a", "1", "Infinity", "2024-01-01", "x", "us", "m", "completed", 3)]
    silver = P.clean_orders(rows_frame(spark, rows), order_by=["_seq"])
    category = P.revenue_by_category(silver).first()
    assert (category["avg_unit_price"], category["order_count"]) == (5.0, 3)   # one rule for sum and count
    assert P.revenue_by_country(silver.where("order_id <> 'A'")).first()["avg_order_value"] == 5.0


def rows_frame(spark, rows):
    cols = "order_id customer_id product_name category quantity unit_price order_date shipping_city " \
           "shipping_country payment_method status _seq"
    return spark.createDataFrame(rows, ", ".join(f"{c} string" if c != "_seq" else "_seq int" for c in cols.split()))


def test_keep_last_before_cancel_filter(spark):
    rows = [("O1", "C1", "p", "a", "1", "10", "2024-01-01", "x", "us", "m", "completed", 1),
            ("O1", "C1", "p", "a", "2", "10", "2024-01-01", "x", "us", "m", " Cancelled ", 2),
            ("O2", "C1", "p", "a", "1", "10", "2024-01-01", "x", "us", "m", None, 1),
            ("O3", "C1", "p", "a", "1", "10", "2024-01-01", "x", "us", "m", "shipped", 2),
            ("O3", "C1", "p", "a", "3", "10", "2024-01-01", "x", "us", "m", "shipped", 1)]
    out = {r["order_id"]: r for r in P.clean_orders(rows_frame(spark, rows), order_by=["_seq"]).collect()}
    assert set(out) == {"O2", "O3"}       # last copy of O1 is cancelled -> order gone; null status kept (T2)
    assert out["O3"]["quantity"] == 1     # the later copy wins
    assert "_seq" not in out["O3"].asDict()


def test_mode_tie_goes_to_smallest(spark):
    rows = [("O1", "C9", "p", "Furniture", "1", "10", "2024-01-01", "x", "us", "m", "completed", 1),
            ("O2", "C9", "p", "Electronics", "1", "10", "2024-01-02", "x", "us", "m", "completed", 1),
            ("O3", "C8", "p", None, "1", "10", "2024-01-02", "x", "us", "m", "completed", 1)]
    out = {r["customer_id"]: r["favorite_category"] for r in P.top_customers(
        P.clean_orders(rows_frame(spark, rows), order_by=["_seq"]), 5).collect()}
    assert out == {"C9": "Electronics", "C8": "Unknown"}


def test_null_keys_dropped_from_groups(spark):
    rows = [("O1", None, "p", "a", "1", "10", "2024-01-01", "x", None, "m", "completed", 1),
            ("O2", "C1", "p", "a", "1", "10", "bad-date", "x", "us", "m", "completed", 1)]
    silver = P.clean_orders(rows_frame(spark, rows), order_by=["_seq"])
    assert [r["shipping_country"] for r in P.revenue_by_country(silver).collect()] == ["US"]
    days = P.daily_revenue(silver).collect()          # O2's unparseable date drops out of the days
    assert [(str(r["order_day"]), r["order_count"]) for r in days] == [("2024-01-01", 1)]
    assert [r["customer_id"] for r in P.top_customers(silver, 3).collect()] == ["C1"]


def test_keep_last_idempotent_and_partition_independent(spark):
    raw = TD.raw_orders(spark, SF_SMALL)
    once = P.clean_orders(raw, order_by=TD.ORDER_LINE_SEQUENCE)
    assert once.count() == once.select("order_id").distinct().count()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = sorted(map(tuple, P.revenue_by_country(P.clean_orders(raw, order_by=TD.ORDER_LINE_SEQUENCE)).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    eight = sorted(map(tuple, P.revenue_by_country(once).collect()))
    assert one == eight


def test_cumulative_equals_total(spark):
    silver = P.clean_orders(TD.raw_orders(spark, SF_SMALL), order_by=TD.ORDER_LINE_SEQUENCE)
    daily = P.daily_revenue(silver).collect()
    cents = silver.filter(F.col("order_date").isNotNull()).agg(F.sum(F.rint(F.col("total_amount") * 100))).first()[0]
    assert round(daily[-1]["cumulative_revenue"] * 100) == int(cents)
    running = 0
    for r in daily:
        running += round(r["daily_revenue"] * 100)
        assert round(r["cumulative_revenue"] * 100) == running


def test_distinct_count_options(spark):
    from strata.operators.aggregate import distinct_count
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("a", None)], "k string, v int")
    row = df.groupBy("k").agg(distinct_count("v").alias("e"), distinct_count("v", approx=True).alias("a")).first()
    assert (row["e"], row["a"]) == (2, 2)


def test_money_sums_beyond_long_range(spark):
    """Three lines of 5e16 each are 1.5e19 cents: past the range of a long."""
    rows = [(f"O{i}", "C1", "p", "a", "1", "50000000000000000", "2024-01-01", "x", "us", "m", "completed", 1)
            for i in range(3)]
    silver = P.clean_orders(rows_frame(spark, rows), order_by=["_seq"])
    got = P.revenue_by_country(silver).first()
    assert got["total_revenue"] == 1.5e17 and got["order_count"] == 3
    assert P.daily_revenue(silver).first()["cumulative_revenue"] == 1.5e17


def test_gold_query_functions(spark):
    import json as _json

    from strata.plans import gold_queries as GQ
    silver = P.clean_orders(TD.raw_orders(spark, SF_SMALL), order_by=TD.ORDER_LINE_SEQUENCE)
    store = P.build_gold(silver)
    with pytest.raises(GQ.UnknownTable):
        GQ.gold_table(store, "nope")
    assert _json.loads(GQ.error_record("nope")) == {"error": "nope data not loaded"}
    rbc = GQ.gold_table(store, "revenue_by_country")
    assert GQ.query_revenue_by_country(rbc, None).count() == rbc.count()
    one = GQ.query_revenue_by_country(rbc, "nation_1").collect()
    assert [r["shipping_country"] for r in one] == ["NATION_1"]
    days = GQ.query_daily_revenue(store["daily_revenue"], "1996-01-01", None)
    assert days.agg(F.min("order_day")).first()[0].isoformat() >= "1996-01-01"
    assert GQ.query_top_customers(store["top_customers"], 50).count() == 10      # stored table has 10
    assert GQ.query_top_customers(silver, 50).count() == 50                       # computed for n
    rec = _json.loads(GQ.to_json_records(one_df := GQ.query_revenue_by_country(rbc, "nation_1")).first()["record"])
    assert set(rec) == set(one_df.columns)
    with pytest.raises(ValueError):
        GQ.query_top_customers(silver, 51)
