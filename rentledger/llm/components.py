"""Connected components of a graph kept as stored tables: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentledger.sources.shared import durable


def _least(links: DataFrame) -> DataFrame:
    """Smallest neighbour of every `u`, stored so that the join with it can be split where a `u` is hot."""
    return durable(links.groupBy("u").agg(F.min("v").alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are linked to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, are linked to the least of them. Edges have u > v."""
    least = _least(edges)
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    kept = durable(edges.distinct())
    return kept, tuple(kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` for every end of an edge (`u`, `v`: longs); the component is its smallest node.

    Loops and repeated edges do no harm. A round makes no more edges than it reads; the
    result is a star around every component's smallest node. Each half round
    is stored in the shared folder, so a lost executor costs its own tasks only.
    """
    whole = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now, mark = _stored(whole)
    while mark[0]:
        before = mark
        now, mark = _stored(_small_star(durable(_large_star(now).distinct())))
        if mark == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
