"""Connected components by alternating large-star and small-star steps, all on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseloom.llm.store import settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one: larger neighbours (large) or smaller (small)."""
    if large:
        sides = edges.union(edges.select("v", "u")).toDF("u", "v")
    else:
        sides = edges
    least = sides.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u"), F.least("u", "m").alias("m"))
    hung = sides.join(least, "u")
    if large:
        out = hung.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") > F.col("v")).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Each round is written to the shared folder. Groups are never collected: the smallest
    neighbour is a partial aggregate, and a hub's join partition can be split.
    """
    edges = settle(edges.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .filter(F.col("u") > F.col("v")).distinct(), "edges")
    if edges.isEmpty():
        return edges.toDF("node", "component")
    seen = None
    while True:
        edges = settle(_star(_star(edges, large=True), large=False), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
