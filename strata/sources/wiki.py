"""Landed wiki API responses -> bronze-shaped tables.

Fetching is done elsewhere; each landed record is one API response page
(``results`` array), with the request key (space key for pages, page id for
comments) stored beside it. Flattening is ``explode`` + nested field access,
so every response page is processed where it was read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.lake import Lake

_S = T.StringType()


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_BY = _st(("displayName", _S))
_BODY = _st(("storage", _st(("value", _S))))

SPACES_RESPONSE = _st(
    ("results", T.ArrayType(_st(("id", _S), ("key", _S), ("name", _S), ("type", _S),
                                ("description", _st(("plain", _st(("value", _S)))))))),
    ("size", T.IntegerType()))
PAGES_RESPONSE = _st(
    ("space_key", _S),
    ("results", T.ArrayType(_st(("id", _S), ("title", _S), ("status", _S), ("body", _BODY),
                                ("version", _st(("number", T.IntegerType()), ("when", _S), ("by", _BY))),
                                ("history", _st(("createdDate", _S), ("createdBy", _BY)))))))
COMMENTS_RESPONSE = _st(
    ("page_id", _S),
    ("results", T.ArrayType(_st(("id", _S), ("body", _BODY),
                                ("version", _st(("when", _S), ("by", _BY)))))))


def _text(path: str) -> F.Column:
    """A text field that defaults to ``''`` when any part of the path is missing."""
    return F.coalesce(F.col(path), F.lit(""))


CORRUPT = "_corrupt_record"


def _parsed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(line, _source_path, r): every non-blank line and its parsed response."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, _S)])
    lines = (spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("_source_path"))
             .filter(F.trim("line") != ""))
    return lines.withColumn("r", F.from_json("line", full, {"columnNameOfCorruptRecord": CORRUPT}))


def read_responses(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed responses, one JSON object per line; lines that are no such
    object are left to :func:`bad_responses`."""
    return _parsed(spark, path, schema).filter(F.col(f"r.{CORRUPT}").isNull()).select("r.*").drop(CORRUPT)


def bad_responses(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(line, _source_path) of the landed lines that do not parse, for a
    quarantine table; with :func:`read_responses` they add up to all lines."""
    return _parsed(spark, path, schema).filter(F.col(f"r.{CORRUPT}").isNotNull()).select("line", "_source_path")


def land_responses(lake: Lake, path: str, schema: T.StructType, table: str) -> tuple[DataFrame, dict[str, int]]:
    """Good responses of ``path`` and the counts of landed, good and
    quarantined lines; the latter are kept in ``bronze/<table>__quarantine``."""
    lake.write_parquet(bad_responses(lake.spark, path, schema), "bronze", f"{table}__quarantine")
    bad = lake.read_parquet("bronze", f"{table}__quarantine").count()
    good = read_responses(lake.spark, path, schema)
    landed = lake.spark.read.text(path).filter(F.trim("value") != "").count()
    return good, {"landed": landed, "good": landed - bad, "quarantined": bad}


def flatten_spaces(responses: DataFrame) -> DataFrame:
    """``results[]`` -> id, key, name, type, plain description (``''``
    when absent)."""
    r = responses.select(F.explode("results").alias("r"))
    return r.select(F.col("r.id").alias("space_id"), F.col("r.key").alias("space_key"),
                    F.col("r.name").alias("space_name"), F.col("r.type").alias("space_type"),
                    _text("r.description.plain.value").alias("description"))


def flatten_pages(responses: DataFrame, space_key: str | None = None) -> DataFrame:
    """A14 (+A16): pages of all spaces, or of one space when ``space_key`` is
    given. Body, names and dates default to ``''``; id, title, status and
    version number stay null when absent."""
    src = responses if space_key is None else responses.filter(F.col("space_key") == F.lit(space_key))
    r = src.select("space_key", F.explode("results").alias("r"))
    return r.select(
        F.col("r.id").alias("page_id"), "space_key", F.col("r.title").alias("title"),
        F.col("r.status").alias("status"), _text("r.body.storage.value").alias("body_html"),
        F.col("r.version.number").alias("version_number"),
        _text("r.history.createdBy.displayName").alias("created_by"),
        _text("r.history.createdDate").alias("created_date"),
        _text("r.version.by.displayName").alias("last_updated_by"),
        _text("r.version.when").alias("last_updated_date"))


def flatten_comments(responses: DataFrame) -> DataFrame:
    """Comments with the page id of the request (as text)."""
    r = responses.select(F.col("page_id").cast("string").alias("page_id"), F.explode("results").alias("r"))
    return r.select(
        F.col("r.id").alias("comment_id"), "page_id", _text("r.body.storage.value").alias("body_html"),
        _text("r.version.by.displayName").alias("author"), _text("r.version.when").alias("created_date"))
