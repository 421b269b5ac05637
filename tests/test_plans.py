"""Plan-shape checks for the scale properties claimed in the README."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from strata.operators.dedup import keep_last, keep_last_late
from strata.operators.retrieval import top_k_per


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_last_prelimits_a_hot_key(spark):
    # one key holds a third of the rows, spread over all input partitions
    df = spark.range(0, 30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("seq"))
    out = keep_last(df, ["k"], ["seq"])
    plan = final_plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the partial limit runs before the exchange on the key
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning(k")
    assert out.filter("k = 'hot'").first()["seq"] == 29997


def test_top_k_prelimits_per_task(spark):
    df = spark.range(0, 20000, numPartitions=8).select((F.col("id") % 2).alias("q"), F.col("id").alias("d"),
                                                       (F.col("id") * 7 % 1000).cast("double").alias("s"))
    plan = final_plan(top_k_per(df, "q", "s", "d", 5))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", ["top_customers", "bm25", "vector_top_k", "visibility_pairs", "rrf"])
def test_no_nested_loop_or_python(spark, name):
    plan = final_plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython", "InPandas"):
        assert bad not in plan, (name, bad)


def test_late_bodies_stay_out_of_keep_last(spark, scratch):
    rows = spark.range(0, 4000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 97 == 1, F.lit(None)).otherwise(
            (F.col("id") % 500).cast("string")).alias("k"),
        (F.col("id") * 7919 % 4001).alias("seq"), F.repeat(F.col("id").cast("string"), 50).alias("body"))
    rows.unionByName(rows.where("seq % 5 = 0")).write.parquet(f"{scratch}/wide")
    wide = spark.read.parquet(f"{scratch}/wide")
    late = keep_last_late(wide, ["k"], ["seq"])
    want = keep_last(wide, ["k"], ["seq"])
    assert late.columns == wide.columns
    assert sorted(map(str, late.collect())) == sorted(map(str, want.collect()))
    plan = final_plan(late)
    # the exchange and sort below keep-last's window hold no body
    window = plan[plan.index("WindowGroupLimit"):]
    keep = window[:window.index("Scan parquet") if "Scan parquet" in window else None]
    assert "Exchange hashpartitioning(k" in keep and "body" not in keep
    # other splits than at write time give the same rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert sorted(map(str, keep_last_late(wide, ["k"], ["seq"]).collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
