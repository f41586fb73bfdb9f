"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityviews.llm.common import saved


def roots(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``links(a, b)``.

    Alternates large-star and small-star steps until nothing changes, about log(n) times. A hub
    is never gathered in one place: its minimum is a partial aggregate, and Spark splits its
    side of the join.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = saved(edges.where("a != b").distinct(), "edges")
    state = None
    while True:
        edges = saved(_star(_star(edges, large=True), large=False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint"))).first()
        if now == state:
            break
        state = now
    hubs = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(hubs)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node (large: the greater ones, else the lesser) to the least."""
    ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        ends = ends.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = ends.groupBy("u").agg(F.min("v").alias("_m")).select(
        F.col("u").alias("_u"), F.least("u", "_m").alias("_m"))
    near = ends.join(least, F.col("u") == F.col("_u"))
    if large:
        out = near.where("v > u").select(F.col("v").alias("a"), F.col("_m").alias("b"))
    else:
        out = near.select(F.col("v").alias("a"), F.col("_m").alias("b")).unionByName(
            near.select(F.col("u").alias("a"), F.col("_m").alias("b")))
    return out.where("a != b").distinct()
