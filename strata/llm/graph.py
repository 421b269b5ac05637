"""Connected components of an edge table (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def _stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (u > v) has one edge down and none up,
    or only edges up: the components can then be read off."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
            .union(edges.select("v", F.lit(0), F.lit(1))))
    return not (ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
                .where("down + up > 1").agg(F.count("*")).first()[0])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a bigint, b bigint); the
    component is its smallest node. Every round is written to the shared
    folder; a hub is never gathered in one task: its smallest neighbour comes
    from an aggregate with partial sums and goes back by a join that Spark may
    split."""
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = stored(small, "edges")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def joined(found: DataFrame | None, edges: DataFrame) -> DataFrame:
    """The components ``found`` (node, component), joined by more ``edges``
    (a bigint, b bigint). Only edges between components go through the rounds."""
    if found is None:
        return components(edges)
    side = found.select(F.col("node").alias("a"), F.col("component").alias("a_component"))
    other = found.select(F.col("node").alias("b"), F.col("component").alias("b_component"))
    between = (edges.join(side, "a", "left").join(other, "b", "left")
               .select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b")))
    new = stored(components(between), "components")
    moved = new.select(F.col("node").alias("component"), F.col("component").alias("to"))
    return (found.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            .union(new.join(found, "node", "left_anti").select("node", "component")))
