"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouping over the edges and a join; tables are written to the shared
folder between steps. The edge table shrinks to one star per component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the others) are joined to its smallest neighbour."""
    if large:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # counted in each task first, and joined: a node with very many neighbours is not one task's group
    least = both.groupBy("u").agg(F.min("v").alias("least")).withColumnRenamed("u", "node")
    rows = both.join(least, F.col("u") == F.col("node")).select("u", "v", F.least("least", "u").alias("m"))
    out = rows.where(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionAll(rows.where(F.col("u") != F.col("m")).select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, v): each node u that is not the smallest of its component, with the smallest, v.

    ``edges`` has long columns u and v; loops and repeats are ignored. ``rounds``
    bounds the loop, which ends by itself after about log(n) rounds; going over it
    is an error, never a partial result.
    """
    spark = edges.sparkSession
    now, path = written(edges.select("u", "v").where("u != v").distinct(), "edges")
    state = None
    for _ in range(rounds):
        after, new = written(_star(_star(now, True), False), "edges")
        drop(spark, path)
        now, path = after, new
        found = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if found == state or not found[0]:
            return now
        state = found
    raise RuntimeError("components did not settle")
