"""Connected components of an edge table, by alternating large and small stars.

Each step links a node's neighbours to the least node near it; the edges end
as stars around the least node of each component. A step is two grouped
minima and two joins on tables written to the shared folder, so a hub with
very many edges is split by the adaptive skew join and lost executors cost
one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _large(edges: DataFrame) -> DataFrame:
    """Edge (a, b), a > b: a links to the least neighbour of b (or b itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.min("b").alias("least")).filter("least < a"), "cc-least").select(F.col("a").alias("b"), "least")
    return edges.join(least, "b", "left").select("a", F.coalesce("least", "b").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Node a links to the least of its smaller neighbours, and so do those."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "cc-least").select("a", "least")
    moved = edges.join(least, "a", "left").select("a", "b", F.coalesce("least", "b").alias("least"))
    return moved.select("a", F.col("least").alias("b")).unionByName(moved.filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for each node with an edge
    to another one. ``edges``: columns a, b (long), in either order, repeats
    and loops allowed."""
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "cc-edges")
    mark = _mark(e)
    while mark[0]:
        e = written(_small(written(_large(e), "cc-large")), "cc-edges")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
