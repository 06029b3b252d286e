"""Connected components as Spark joins (alternating large-star, small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from argent.llm.common import release, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link a node's larger (or not larger) neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "components-least")
    linked = both.join(least, "a")
    if large:
        linked = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    out = staged(linked.filter("a <> b").distinct(), "components-star")
    release(least, edges)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of (a, b) edges: the smallest node that
    each can reach. No node's neighbours are ever gathered in one row, and the
    lineage is cut by tables in the shared folder."""
    now = staged(edges.filter("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).select("a", "b").distinct(), "components")
    mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while mark[0]:
        now = _star(_star(now, True), False)
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    out = staged(
        now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
            now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
        ),
        "components-named",
    )
    release(now)
    return out
