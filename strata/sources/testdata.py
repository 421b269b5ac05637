"""Raw (bronze-shaped) views derived from the generated test tables.

The generated tables are a TPC-H-like star schema plus web pages and
conversations. These views reshape them into the raw records the pipelines
ingest: order lines with messy text fields, wiki pages with HTML bodies and
versions, and comments. Every view is a lazy Spark plan over the Parquet
files, so it grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Columns that define which copy of a duplicated order line is the "last"
# one (all descending). They stand in for ingest time / file position and are
# prefixed with ``_`` so they stay in bronze.
ORDER_LINE_SEQUENCE = ["_l_shipdate", "_l_partkey", "_l_suppkey", "_l_quantity", "_l_extendedprice",
                       "_l_discount", "_l_tax", "_l_returnflag", "_l_linestatus"]

BASE_DAY = "2024-01-01 00:00:00"


# Tables that grow with the data and are scanned as the probe side; the others
# are small here and end up broadcast, so they are read as they are.
FACT_TABLES = {"lineitem", "events", "documents", "embeddings", "pages", "conversations"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in FACT_TABLES else df


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that came out in fewer splits than the cluster has task
    slots (a small file with a single row group is one split). Large inputs
    already have far more splits than slots and are returned unchanged, so
    this never adds a shuffle at scale.

    Rows are hash-partitioned on the table's leading id column: deterministic
    on retry without the per-task sort that round-robin partitioning needs."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (Spark Connect): leave the scan as it is
        return df
    if splits >= slots:
        return df
    return df.repartition(slots, df.columns[0])


def raw_orders(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """Order lines as raw text records (one row per lineitem). ``by_order``: the
    lines of an order lie in one partition, where the last join leaves them."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                             "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    # the small sides meet first, so that a line is shuffled for two joins, not three
    orders = (o.join(c, F.col("o_custkey") == c.c_custkey)
              # nation has 25 rows by definition of the schema: a proven bound
              .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
              .drop("c_custkey", "c_nationkey", "n_nationkey"))
    lines = li.drop("l_commitdate", "l_receiptdate", "l_shipinstruct", "l_shipmode", "l_comment")
    of_order, of_part = F.col("l_orderkey") == orders.o_orderkey, F.col("l_partkey") == p.p_partkey
    if by_order:
        joined = lines.join(p, of_part).repartition("l_orderkey").join(orders, of_order)
    else:
        joined = lines.join(orders, of_order).join(p, of_part)
    text = lambda c: F.col(c).cast("string")
    return joined.select(
        F.concat(F.lit("ORD-"), text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("order_id"),
        F.concat(F.lit("C-"), text("o_custkey")).alias("customer_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit(" "), F.lower("p_type"), F.lit(" ")))
         .otherwise(F.col("p_type")).alias("category"),
        F.when(F.col("l_suppkey") % 97 == 0, F.lit("n/a"))
         .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("unit_price"),
        text("o_orderdate").alias("order_date"),
        F.concat(F.lit("city-"), (F.col("o_custkey") % 50).cast("string")).alias("shipping_city"),
        F.when(F.col("l_partkey") % 5 == 0, F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")))
         .otherwise(F.col("n_name")).alias("shipping_country"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(F.col("o_orderstatus") == "P", F.lit(" Cancelled "))
         .when(F.col("o_orderstatus") == "F", F.lit("completed"))
         .otherwise(F.lit("shipped")).alias("status"),
        *[F.col(c[1:]).alias(c) for c in ORDER_LINE_SEQUENCE],
    )


def _day(e) -> F.Column:
    """2024-01-01 plus ``e`` days, as an ISO-8601 UTC text like the wiki API."""
    ts = F.lit(BASE_DAY).cast("timestamp") + F.make_dt_interval(days=e.cast("int"))
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wiki pages, each delivered twice: the original (version 1) and a
    revision (another body, updated a day later) whose version number is
    ``page_id % 3``. Keep-last therefore keeps the original where the revision
    has version 0, and the revision otherwise (higher version, or the same
    version and a later update)."""
    pg = table(spark, sf_dir, "pages")

    def copy(body, version, updated_by, updated_day):
        return pg.select(
            F.col("page_id").cast("string").alias("page_id"),
            F.concat(F.lit(" "), F.split_part(F.col("url"), F.lit("/"), F.lit(3))).alias("space_key"),
            F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
            F.lit("current").alias("status"),
            body.alias("body_html"),
            version.cast("int").alias("version_number"),
            F.concat(F.lit("u"), (F.col("page_id") % 25).cast("string")).alias("created_by"),
            _day(F.col("page_id") % 60).alias("created_date"),
            F.concat(F.lit("u"), (updated_by % 25).cast("string")).alias("last_updated_by"),
            _day(updated_day).alias("last_updated_date"),
        )

    original = copy(F.col("html"), F.lit(1), F.col("page_id"), F.col("page_id") % 60)
    revised = copy(F.concat(F.lit("<h2>Revised</h2>"), F.col("html")), F.col("page_id") % 3,
                   F.col("page_id") + 1, F.col("page_id") % 60 + 1)
    return original.unionByName(revised)


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments: one per conversation turn, on page ``conv_id``."""
    cv = table(spark, sf_dir, "conversations")
    return cv.select(
        (F.col("conv_id") * 1000 + F.col("turn")).cast("string").alias("comment_id"),
        F.col("conv_id").cast("string").alias("page_id"),
        F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>")).alias("body_html"),
        F.concat(F.lit(" u"), ((F.col("conv_id") * 7 + F.col("turn")) % 40).cast("string")).alias("author"),
        _day((F.col("conv_id") + F.col("turn")) % 60).alias("created_date"),
    )


def raw_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spaces: one per host that has pages."""
    hosts = (table(spark, sf_dir, "pages")
             .select(F.split_part(F.col("url"), F.lit("/"), F.lit(3)).alias("host")).distinct())
    return hosts.select(
        F.col("host").alias("space_id"),
        F.concat(F.lit(" "), F.col("host"), F.lit(" ")).alias("space_key"),
        F.concat(F.lit("\t"), F.col("host")).alias("space_name"),
        F.lit(" Global").alias("space_type"),
        F.concat(F.lit("<p>Pages of <b>"), F.col("host"), F.lit("</b> &amp; more</p>")).alias("description"),
    )


def space_groups(spaces_or_pages: DataFrame, key: str = "space_key") -> DataFrame:
    """Space -> groups for row visibility: hosts ending ``.COM`` are
    ``[team-a, all]``, ``.NET`` are ``[team-b]``; others are not mapped (and so
    default to ``[all]``). Keys are upper-case like silver ``space_key``."""
    keys = spaces_or_pages.select(F.upper(F.col(key)).alias("space_key")).distinct()
    groups = (F.when(F.col("space_key").endswith(".COM"), F.array(F.lit("team-a"), F.lit("all")))
              .when(F.col("space_key").endswith(".NET"), F.array(F.lit("team-b"))))
    return keys.select("space_key", groups.alias("allowed_groups")).filter(F.col("allowed_groups").isNotNull())


def space_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spaces as API responses: one result each."""
    return raw_spaces(spark, sf_dir).select(F.array(F.struct(
        F.col("space_id").alias("id"), F.col("space_key").alias("key"), F.col("space_name").alias("name"),
        F.col("space_type").alias("type"),
        F.struct(F.struct(F.col("description").alias("value")).alias("plain")).alias("description"))).alias("results"))


def page_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as API responses, one per space."""
    by = lambda c: F.struct(F.col(c).alias("displayName"))
    result = F.struct(
        F.col("page_id").alias("id"), "title", "status",
        F.struct(F.struct(F.col("body_html").alias("value")).alias("storage")).alias("body"),
        F.struct(F.col("version_number").alias("number"), F.col("last_updated_date").alias("when"),
                 by("last_updated_by").alias("by")).alias("version"),
        F.struct(F.col("created_date").alias("createdDate"), by("created_by").alias("createdBy")).alias("history"))
    return raw_pages(spark, sf_dir).groupBy("space_key").agg(F.collect_list(result).alias("results"))


def comment_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments as API responses, one per page."""
    result = F.struct(
        F.col("comment_id").alias("id"), F.struct(F.struct(F.col("body_html").alias("value")).alias("storage")).alias("body"),
        F.struct(F.col("created_date").alias("when"), F.struct(F.col("author").alias("displayName")).alias("by")).alias("version"))
    return raw_comments(spark, sf_dir).groupBy("page_id").agg(F.collect_list(result).alias("results"))
