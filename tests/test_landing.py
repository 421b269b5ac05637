"""Order lines land without a sort of all of them."""

import glob
import gzip
import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.session import checkpoint_root


def test_copies_of_a_line_lie_in_one_file_in_order(spark, tmp_path):
    lines = [(o, n, 1 + (o + i) % 3, 1, 2.0 + i, 10.0, 0.0, 0.0, "N", "O", f"1996-01-0{1 + i}")
             for o in range(40) for n in (1, 2, None) for i in range(3)]
    li = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                               "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string")
    more = ["l_commitdate", "l_receiptdate", "l_shipinstruct", "l_shipmode", "l_comment"]
    frames = {
        "lineitem": li.withColumn("l_shipdate", F.to_date("l_shipdate")).withColumns({c: F.lit("x") for c in more}),
        "orders": spark.range(40).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
                                         F.lit("1996-01-01").cast("date").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")),
        "customer": spark.range(7).select(F.col("id").alias("c_custkey"), F.lit(1).cast("long").alias("c_nationkey")),
        "nation": spark.range(1, 2).select(F.col("id").alias("n_nationkey"), F.lit("PERU").alias("n_name")),
        "part": spark.range(1, 4).select(F.col("id").alias("p_partkey"), F.lit("bolt").alias("p_name"), F.lit("STEEL").alias("p_type"))}
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    root = checkpoint_root(spark).removeprefix("file://").removeprefix("file:")
    before = set(glob.glob(f"{root}/l1-*"))
    got = {r.step: r.n for r in E.q_etl_orders(spark, str(tmp_path)).collect()}
    assert got["rows_in"] == 360 and got["rows_out"] == 81      # 80 line ids, and the lines without one as a group
    landed = (set(glob.glob(f"{root}/l1-*")) - before).pop() + "/landing"
    files = sorted(f for f in os.listdir(landed) if f.startswith("part-"))
    assert all(f.endswith(".csv.gz") for f in files)            # every row once, and small
    copies = {}
    for at, name in enumerate(files):
        with gzip.open(f"{landed}/{name}", "rt") as f:
            for line in list(f)[1:]:
                cells = line.rstrip("\n").split(",")
                copies.setdefault(cells[0], []).append((at, int(cells[4])))
    for order_id, found in copies.items():
        assert [q for _, q in found] == sorted(q for _, q in found), order_id
        assert len({at for at, _ in found}) == 1 or order_id in ("", '""'), order_id
