"""Connected components of an edge table by alternating large and small stars.

Every round relinks each node's neighbours to the smallest of them, by a grouped minimum (partial
sums in the map tasks, so a node with very many links costs one row a task) and an equi-join.
Rounds end when the edges no longer change; each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revspark.llm.common import written


def _star(edges: DataFrame) -> DataFrame:
    """u, v, m: each directed edge with the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _links(a, b, of: DataFrame) -> DataFrame:
    return of.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _links("v", "m", _star(both).where("v > u")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    star = _star(down)
    return _links("v", "m", star).union(_links("u", "m", star)).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns a, b (long). Returns node, component (the smallest node reachable) of
    every node with a link to another; an empty table gives an empty result."""
    now = written(edges.where("a != b").select("a", "b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    least = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(least)
