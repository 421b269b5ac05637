"""Lake I/O, end-to-end runs (L1, L2) and incremental ingest (K1)."""

import os

import pytest
from pyspark.sql import functions as F

from strata.plans import pipeline
from strata.sources.lake import Lake
from strata.streaming.incremental import ingest_new_files, read_bronze
from test_content import bronze



def test_table_management(spark, scratch):
    lake = Lake(spark, scratch)
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "k int, g array<string>")
    assert not lake.exists("silver", "t")
    lake.write_parquet(df, "silver", "t")
    lake.write_csv(df, "silver", "t")
    assert lake.exists("silver", "t") and lake.list_tables("silver") == ["t"]
    assert sorted(r["k"] for r in lake.read_parquet("silver", "t").collect()) == [1, 2]
    csv = spark.read.option("header", True).csv(lake.path("silver", "t", "csv"))
    assert sorted((r["k"], r["g"]) for r in csv.collect()) == [("1", "a,b"), ("2", None)]
    lake.write_parquet(df.filter("k = 1"), "silver", "t")            # overwrite replaces
    assert lake.read_parquet("silver", "t").count() == 1
    assert lake.delete_table("silver", "t") and not lake.exists("silver", "t")
    assert os.path.isdir(lake.path("silver", "t", "csv"))           # the CSV twin stays
    empty = lake.read_or_empty("silver", "t", "k int")
    assert empty.count() == 0 and empty.columns == ["k"]
    with pytest.raises(ValueError):
        lake.path("platinum", "t")


def test_run_orders_etl(spark, scratch, sample_csv):
    lake = Lake(spark, scratch)
    out = pipeline.run_orders_etl(lake, sample_csv, ingested_at="2024-02-01T00:00:00+00:00")
    m = out["metrics"]
    assert {k: m[k] for k in ("rows_in", "duplicates_removed", "cancelled_removed", "rows_out")} == \
        {"rows_in": 7, "duplicates_removed": 1, "cancelled_removed": 1, "rows_out": 5}
    assert m["groups_out"] == {"gold_revenue_by_country": 2, "gold_revenue_by_category": 2,
                               "gold_daily_revenue": 3, "gold_top_customers": 3}
    assert set(lake.list_tables("gold")) == {"revenue_by_country", "revenue_by_category", "daily_revenue", "top_customers"}
    top = out["gold"]["top_customers"].orderBy(F.col("total_spend").desc()).first()
    assert (top["customer_id"], top["total_spend"]) == ("C1", 131.5)
    bronze_t = lake.read_parquet("bronze", "orders")
    assert {"_ingested_at", "_source_file", "_ingest_seq"} <= set(bronze_t.columns)
    assert {r[0] for r in bronze_t.select("_source_file").distinct().collect()} == {"orders.csv"}
    assert "_ingested_at" not in lake.read_parquet("silver", "orders").columns


def test_run_content_etl(spark, scratch):
    s, p, c = bronze(spark, scratch)
    lake = Lake(spark, f"{scratch}/lake")
    counts = {}
    gold = pipeline.run_content_etl(lake, s, p, c.limit(0), ingested_at="t", step_counts=counts)
    assert counts == {"wiki_spaces": {"rows_in": 2, "rows_out": 2, "duplicates_removed": 0},
                      "wiki_pages": {"rows_in": 3, "rows_out": 2, "duplicates_removed": 1}}
    assert "wiki_comments" not in lake.list_tables("bronze")   # empty input skipped
    assert set(gold) == {"wiki_content_by_space", "wiki_author_activity",
                         "wiki_most_discussed", "wiki_content_timeline"}
    assert os.path.isdir(lake.path("gold", "wiki_most_discussed", "csv"))


def write_csv(path, rows):
    header = "order_id,customer_id,product_name,category,quantity,unit_price,order_date,shipping_city," \
             "shipping_country,payment_method,status"
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")


def test_incremental_ingest(spark, scratch):
    from strata.plans import orders as P
    landing = f"{scratch}/landing"
    os.makedirs(landing)
    lake = Lake(spark, f"{scratch}/lake")
    ckpt = f"{scratch}/ckpt"
    write_csv(f"{landing}/a.csv", ["O1,C1,p,a,1,10,2024-01-01,x,us,m,completed",
                                   "O2,C1,p,a,2,10,2024-01-01,x,us,m,completed"])
    assert ingest_new_files(lake, landing, "orders", checkpoint=ckpt, ingested_at="2024-01-01T00:00:00") == 2
    assert ingest_new_files(lake, landing, "orders", checkpoint=ckpt, ingested_at="2024-01-02T00:00:00") == 0
    write_csv(f"{landing}/b.csv", ["O2,C1,p,a,5,10,2024-01-01,x,us,m,completed"])   # re-delivered key
    assert ingest_new_files(lake, landing, "orders", checkpoint=ckpt, ingested_at="2024-01-03T00:00:00") == 1
    bronze_t = read_bronze(lake, "orders")
    assert bronze_t.count() == 3
    silver = {r["order_id"]: r["quantity"] for r in P.clean_orders(bronze_t).collect()}
    assert silver == {"O1": 1, "O2": 5}                                 # the later delivery wins


def test_a_new_checkpoint_overwrites_nothing(spark, scratch):
    lake = Lake(spark, f"{scratch}/lake")
    for name, ids in (("one", range(105)), ("two", range(200, 201))):
        os.makedirs(f"{scratch}/{name}")
        for i in ids:
            write_csv(f"{scratch}/{name}/{i}.csv", [f"O{i},C1,p,a,1,10,2024-01-01,x,us,m,completed"])
    assert read_bronze(lake, "orders").count() == 0                     # no file yet
    assert ingest_new_files(lake, f"{scratch}/one", "orders", checkpoint=f"{scratch}/c1", max_files_per_trigger=1) == 105
    assert ingest_new_files(lake, f"{scratch}/two", "orders", checkpoint=f"{scratch}/c2") == 1
    assert read_bronze(lake, "orders").select("order_id").distinct().count() == 106
    assert ingest_new_files(lake, f"{scratch}/two", "orders") == 1      # default checkpoint, beside the table
    assert ingest_new_files(lake, f"{scratch}/two", "orders") == 0


def test_checkpoint_dir_from_session(spark):
    from strata.session import checkpoint_root
    root = checkpoint_root(spark)
    assert root and spark.sparkContext.getCheckpointDir()


def test_tune_for_input(spark, scratch):
    from strata.session import input_bytes, tune_for_input
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert input_bytes(spark, "/root/testdata/sf0.01/lineitem.parquet") > 0
    assert input_bytes(spark, f"{scratch}/missing") == 0
    try:
        n = tune_for_input(spark, "/root/testdata/sf0.01/lineitem.parquet", target_bytes=64 * 1024)
        assert n > before and int(spark.conf.get("spark.sql.shuffle.partitions")) == n
        assert tune_for_input(spark, "/root/testdata/sf0.001/region.parquet") == n   # never lowered
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))


def test_ingest_json_array(spark, scratch):
    """A2: a JSON array of records lands in bronze with lineage columns."""
    import json as _json

    from pyspark.sql import types as T

    from strata.sources import ingest
    path = f"{scratch}/orders.json"
    with open(path, "w") as f:
        _json.dump([{"order_id": "O1", "quantity": "2"}, {"order_id": "O2", "quantity": "x"}], f)
    schema = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("quantity", T.StringType())])
    lake = Lake(spark, f"{scratch}/lake")
    out = ingest.ingest_json(lake, path, "orders_json", schema, ingested_at="t")
    rows = sorted((r["order_id"], r["quantity"], r["_source_file"], r["_ingested_at"]) for r in out.collect())
    assert rows == [("O1", "2", "orders.json", "t"), ("O2", "x", "orders.json", "t")]
