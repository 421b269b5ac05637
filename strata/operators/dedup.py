"""Keep the last row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.common import as_col

_RN = "__strata_rn"


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Keep, for every key, the row that is greatest under ``order_by``.

    Spark has no input order, so "last" is made explicit: the ordering
    columns (for raw rows: ingest time, source file, position in the file)
    decide. Null ordering values count as earliest. Null keys form one group,
    as in ``drop_duplicates``.

    Plan: ``row_number() = 1`` lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle, so every map task sends at most one row per key; a key
    that holds a large share of the rows does not flood one reducer.
    """
    order = list(order_by)
    if not order:
        # no lineage to go by: the greatest whole row wins (deterministic)
        sortable = [f.name for f in df.schema.fields
                    if f.name not in keys and not isinstance(f.dataType, T.MapType)]
        order = [F.col(c) for c in sortable]
    w = Window.partitionBy(*keys).orderBy(*[as_col(c).desc_nulls_last() for c in order])
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def keep_last_late(stored: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """:func:`keep_last` for wide rows of a frame read from Parquet files.

    The winners are chosen on keys, ordering columns and the place of the row
    (file path and row number, which no change of splits or lost executor
    alters); the other columns, bodies for example, are read only for the join
    with the winners' places. The exchange and sort of keep-last never hold
    them; where Spark broadcasts the places, no body is shuffled at all, and
    otherwise its runtime filters may drop the replaced copies before the join.
    Ties under ``order_by`` go to the greatest place.
    """
    place = [F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__at")]
    order = [as_col(c).alias(f"__o{i}") for i, c in enumerate(order_by)]
    narrow = stored.select(*keys, *order, *place)
    # null keys form one group in both forms; the join goes by place, which is never null
    last = keep_last(narrow, keys, [*[f"__o{i}" for i in range(len(order))], "__path", "__at"])
    return stored.select("*", *place).join(last.select("__path", "__at"), ["__path", "__at"]).drop("__path", "__at")


def drop_meta(df: DataFrame) -> DataFrame:
    """B1: lineage columns (names starting with ``_``) never leave bronze."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def lineage_order(df: DataFrame) -> list[Column]:
    """Default "last" for raw rows: later ingest run, later micro-batch, then
    source file, then position of the row in its file (stamped at ingest)."""
    cols = [c for c in ("_ingested_at", "_ingest_batch", "_source_file", "_source_path", "_ingest_seq") if c in df.columns]
    return [F.col(c) for c in cols]
