"""What can be reached over links: recursion by semi-naive rounds over stored deltas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentledger.sources.shared import durable


def reachable(links: DataFrame, seeds: DataFrame, most: int | None = None) -> DataFrame:
    """`seed`, `node`, `steps`: every node that a seed reaches over links, with the least number of links to it.

    `links` has `source`, `target`, `seeds` has `seed`; a seed reaches itself only over a cycle. `most` ends the search after as many
    links, else it ends with the first round that finds nothing new, so cycles do no harm. Links and seeds may repeat; NULLs
    link nothing.

    A round joins only what the last one found with the links and takes away what was known: each pair is
    found new once, stored, and never joined again. Round follows round as stored tables, so a lost executor costs
    its own tasks only. Both joins are left to Spark: a node with many links is split as a skewed join.
    """
    known_links = durable(links.select("source", "target").dropna().distinct())
    now = seeds.select("seed").dropna().distinct().select("seed", F.col("seed").alias("node"))
    rounds: list[DataFrame] = []
    while most is None or len(rounds) < most:
        stepped = now.join(known_links, F.col("node") == F.col("source")).select("seed", F.col("target").alias("node")).distinct()
        for before in rounds:
            stepped = stepped.join(before.select("seed", "node"), ["seed", "node"], "left_anti")
        now = durable(stepped.withColumn("steps", F.lit(len(rounds) + 1)))
        if now.isEmpty():
            break
        rounds.append(now)
        now = now.select("seed", "node")
    return reduce(DataFrame.union, rounds) if rounds else now.select("seed", "node", F.lit(0).alias("steps")).limit(0)
