"""End-to-end runs (L1, L2): bronze -> silver -> gold, every layer stored.

Gold reads silver back from storage, so the gold tables share one scan
source and the silver job's lineage is cut at the layer boundary (a lost
executor during gold never recomputes bronze -> silver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import access
from strata.plans import content as content_plan
from strata.plans import orders as orders_plan
from strata.plans.metrics import StepMetrics
from strata.session import tuned_for
from strata.sources import ingest
from strata.sources.lake import Lake


def run_orders_etl(lake: Lake, source_csv: str, top_n: int = 50,
                   ingested_at: str | None = None) -> dict[str, object]:
    """L1: CSV -> bronze.orders -> silver.orders -> four gold tables.

    Returns the gold frames (read back from storage) and the step metrics
    (rows in/out, duplicates and cancelled rows removed, groups per table).
    """
    with tuned_for(lake.spark, source_csv):
        return _orders_etl(lake, source_csv, top_n, ingested_at)


def _orders_etl(lake: Lake, source_csv: str, top_n: int, ingested_at: str | None) -> dict[str, object]:
    bronze = ingest.ingest_csv(lake, source_csv, "orders", ingested_at=ingested_at)
    metrics = StepMetrics()
    silver = orders_plan.clean_orders(bronze, metrics=metrics)
    lake.write_parquet(silver.withColumn("_processed_at", _stamp(ingested_at)), "silver", "orders")
    stored = lake.read_parquet("silver", "orders")
    gold = {}
    for name, df in orders_plan.build_gold(stored, top_n, unique_orders=True).items():
        out = metrics.tap(df.withColumn("_aggregated_at", _stamp(ingested_at)), f"gold_{name}")
        lake.write_parquet(out, "gold", name)
        gold[name] = lake.read_parquet("gold", name)
    counts = orders_plan.order_step_counts(metrics)
    counts["groups_out"] = {n: v["rows"] for n, v in metrics.values().items() if n.startswith("gold_")}
    return {"gold": gold, "metrics": counts}


def run_content_etl(lake: Lake, spaces: DataFrame | None, pages: DataFrame | None,
                    comments: DataFrame | None, ingested_at: str | None = None,
                    step_counts: dict | None = None, space_groups: DataFrame | None = None) -> dict[str, DataFrame]:
    """L2: flattened API tables -> bronze -> silver (Parquet + CSV) -> gold
    (Parquet + CSV). Empty or absent inputs are skipped at every layer.

    ``step_counts`` (L3), when given, is filled per landed table with rows in,
    rows out of silver and duplicates removed, counted by the write jobs.
    ``space_groups`` (space_key, allowed_groups), when given, adds the gold table
    ``wiki_secured_documents``: the pages with the groups that may see them (as
    comma-joined text in the CSV twin)."""
    landed = ingest.ingest_all(lake, {"wiki_spaces": spaces, "wiki_pages": pages,
                                      "wiki_comments": comments}, ingested_at=ingested_at)
    cleaners = {"wiki_spaces": content_plan.clean_spaces,
                "wiki_pages": content_plan.clean_pages,
                "wiki_comments": content_plan.clean_comments}
    silver: dict[str, DataFrame] = {}
    metrics = StepMetrics()
    for name, clean in cleaners.items():
        if name not in landed:
            continue
        out = clean(lake.read_parquet("bronze", name)).withColumn("_processed_at", _stamp(ingested_at))
        lake.write_parquet(metrics.tap(out, name), "silver", name)
        silver[name] = lake.read_parquet("silver", name)
        lake.write_csv(silver[name], "silver", name)
    if step_counts is not None:
        out_rows = metrics.values()
        for name in silver:
            rows_in, rows_out = landed[name], out_rows[name]["rows"]
            step_counts[name] = {"rows_in": rows_in, "rows_out": rows_out, "duplicates_removed": rows_in - rows_out}
    gold = content_plan.build_gold(silver.get("wiki_pages"), silver.get("wiki_comments"),
                                   spark=lake.spark)
    if space_groups is not None and "wiki_pages" in silver:
        gold["wiki_secured_documents"] = access.secured_documents(silver["wiki_pages"], space_groups)
    result = {}
    for name, df in gold.items():
        lake.write_parquet(df.withColumn("_aggregated_at", _stamp(ingested_at)), "gold", name)
        result[name] = lake.read_parquet("gold", name)
        lake.write_csv(result[name], "gold", name)
    return result


def _stamp(ts: str | None):
    return F.lit(ts or ingest.run_timestamp())
