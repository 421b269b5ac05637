"""Wiki content: silver spaces/pages/comments and the four gold tables
(L2, F14-F17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import coerce as C
from strata.functions import text as T
from strata.operators.dedup import drop_meta, keep_last, keep_last_late, lineage_order
from strata.operators.window import running_total

# Declared shapes of the silver tables, used for absent (empty) inputs.
SILVER_PAGES_SCHEMA = (
    "page_id string, space_key string, title string, status string, body_html string, "
    "version_number long, created_by string, created_date timestamp_ntz, last_updated_by string, "
    "last_updated_date timestamp_ntz, body_text string, word_count long, content_length long")
SILVER_COMMENTS_SCHEMA = (
    "comment_id string, page_id string, body_html string, author string, created_date timestamp_ntz, "
    "comment_text string, word_count long")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """An absent table is an empty frame with the declared schema."""
    return spark.createDataFrame([], schema)


def clean_spaces(bronze: DataFrame) -> DataFrame:
    """Silver spaces: name stripped, key upper, type lower, description as
    plain text. Spaces are not de-duplicated."""
    return drop_meta(bronze).withColumns({
        "space_name": T.strip("space_name"),
        "space_key": T.upper_strip("space_key"),
        "space_type": T.lower_strip("space_type"),
        "description": T.html_to_text("description"),
    })


def page_order(bronze: DataFrame) -> list[Column]:
    """"Last" copy of a page: highest version, then latest update, then
    lineage (ingest time, file, row)."""
    return [F.col("version_number").cast("long"),
            C.to_timestamp_or_null("last_updated_date"), *lineage_order(bronze)]


def clean_pages(bronze: DataFrame, order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """Silver pages: keep the last copy per ``page_id``; body as text, word
    count, text length; dates parsed (bad -> null); title stripped, key upper,
    status lower. ``created_by`` is kept as it is (not stripped).

    Keep-last runs first so that the HTML of replaced copies is never parsed.
    """
    order_by = list(order_by) if order_by is not None else page_order(bronze)
    return tidy_pages(keep_last(bronze, ["page_id"], order_by))


def clean_stored_pages(bronze: DataFrame, order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """:func:`clean_pages` for bronze read from Parquet: the bodies stay out of
    keep-last and join its winners afterwards."""
    order_by = list(order_by) if order_by is not None else page_order(bronze)
    return tidy_pages(keep_last_late(bronze, ["page_id"], order_by))


def tidy_pages(last: DataFrame) -> DataFrame:
    """The row-wise part of :func:`clean_pages`, for rows that are already the
    last copy of their page."""
    with_text = drop_meta(last).withColumn("body_text", T.html_to_text("body_html"))
    return with_text.withColumns({
        "version_number": F.col("version_number").cast("long"),
        "word_count": T.word_count("body_text"),
        "content_length": T.text_length("body_text"),
        "created_date": C.to_timestamp_or_null("created_date"),
        "last_updated_date": C.to_timestamp_or_null("last_updated_date"),
        "title": T.strip("title"),
        "space_key": T.upper_strip("space_key"),
        "status": T.lower_strip("status"),
    })


def comment_order(bronze: DataFrame) -> list[Column]:
    return [C.to_timestamp_or_null("created_date"), *lineage_order(bronze)]


def clean_comments(bronze: DataFrame, order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """Silver comments: keep the last copy per ``comment_id``; body as text,
    word count; date parsed; author stripped."""
    order_by = list(order_by) if order_by is not None else comment_order(bronze)
    last = drop_meta(keep_last(bronze, ["comment_id"], order_by))
    with_text = last.withColumn("comment_text", T.html_to_text("body_html"))
    return with_text.withColumns({
        "word_count": T.word_count("comment_text"),
        "created_date": C.to_timestamp_or_null("created_date"),
        "author": T.strip("author"),
    })


def content_by_space(pages: DataFrame) -> DataFrame:
    """per space: pages, words, mean words (rounded, half even), text
    length, latest update; most pages first."""
    return (pages.filter(F.col("space_key").isNotNull())
            .groupBy("space_key")
            .agg(F.count_distinct("page_id").alias("page_count"),
                 F.sum("word_count").alias("total_words"),
                 F.avg("word_count").alias("_avg"),
                 F.sum("content_length").alias("total_content_length"),
                 F.max("last_updated_date").alias("latest_update"))
            .select("space_key", F.col("page_count").cast("long").alias("page_count"),
                    F.coalesce(F.col("total_words"), F.lit(0)).cast("long").alias("total_words"),
                    C.round_to_long("_avg").alias("avg_word_count"),
                    F.coalesce(F.col("total_content_length"), F.lit(0)).cast("long").alias("total_content_length"),
                    "latest_update")
            .orderBy(F.col("page_count").desc(), "space_key"))


def author_activity(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """pages by ``created_by`` and comments by ``author``, each aggregated
    first, then full outer join on the author; missing counts are 0."""
    page_agg = (pages.filter(F.col("created_by").isNotNull())
                .groupBy(F.col("created_by").alias("author"))
                .agg(F.count_distinct("page_id").alias("pages_created"),
                     F.sum("word_count").alias("pages_total_words")))
    comment_agg = (comments.filter(F.col("author").isNotNull())
                   .groupBy("author")
                   .agg(F.count_distinct("comment_id").alias("comments_made"),
                        F.sum("word_count").alias("comments_total_words")))
    counts = ["pages_created", "pages_total_words", "comments_made", "comments_total_words"]
    joined = page_agg.join(comment_agg, "author", "full_outer")
    out = joined.select("author", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts])
    return (out.withColumn("total_contributions", F.col("pages_created") + F.col("comments_made"))
            .orderBy(F.col("total_contributions").desc(), "author"))


def content_timeline(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """F16: pages and comments created per day (full outer join on the day),
    their sum, and the running total of pages in day order."""
    page_days = (pages.withColumn("day", F.to_date("created_date")).filter(F.col("day").isNotNull())
                 .groupBy("day").agg(F.count_distinct("page_id").alias("pages_created")))
    comment_days = (comments.withColumn("day", F.to_date("created_date")).filter(F.col("day").isNotNull())
                    .groupBy("day").agg(F.count_distinct("comment_id").alias("comments_created")))
    days = (page_days.join(comment_days, "day", "full_outer")
            .select("day",
                    F.coalesce(F.col("pages_created"), F.lit(0)).cast("long").alias("pages_created"),
                    F.coalesce(F.col("comments_created"), F.lit(0)).cast("long").alias("comments_created")))
    days = days.withColumn("total_activity", F.col("pages_created") + F.col("comments_created"))
    return (running_total(days, "day", "pages_created", "cumulative_pages")
            .withColumn("cumulative_pages", F.col("cumulative_pages").cast("long"))
            .orderBy("day"))


def most_discussed(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """every page with its number of comments (0 when none); comments on
    unknown pages are dropped; most discussed first."""
    counts = (comments.filter(F.col("page_id").isNotNull())
              .groupBy(F.col("page_id").cast("string").alias("page_id"))
              .agg(F.count_distinct("comment_id").alias("comment_count")))
    base = pages.select(F.col("page_id").cast("string").alias("page_id"), "title", "space_key", "word_count")
    return (base.join(counts, "page_id", "left")
            .withColumn("comment_count", F.coalesce(F.col("comment_count"), F.lit(0)).cast("long"))
            .orderBy(F.col("comment_count").desc(), "page_id"))


def build_gold(pages: DataFrame | None, comments: DataFrame | None,
               spark: SparkSession | None = None) -> dict[str, DataFrame]:
    """The gold tables that the available inputs allow: without pages only the
    timeline (from comments) is built; without comments they count 0."""
    if pages is None and comments is None:
        return {}
    spark = spark or (pages if pages is not None else comments).sparkSession
    comments_in = comments if comments is not None else empty(spark, SILVER_COMMENTS_SCHEMA)
    out: dict[str, DataFrame] = {}
    if pages is not None:
        out["wiki_content_by_space"] = content_by_space(pages)
        out["wiki_author_activity"] = author_activity(pages, comments_in)
        out["wiki_most_discussed"] = most_discussed(pages, comments_in)
    pages_in = pages if pages is not None else empty(spark, SILVER_PAGES_SCHEMA)
    out["wiki_content_timeline"] = content_timeline(pages_in, comments_in)
    return out
