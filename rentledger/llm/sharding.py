"""Shards of near-equal bytes by histogram sort: count below boundaries until they fit, then exchange once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentledger.llm.common import text_bytes
from rentledger.llm.histogram import Goal, boundaries, parts, ranges, spread
from rentledger.sources.shared import durable

SHARDS = 16
TOLERANCE = 1e-4  # of a shard's bytes


def histogram_sort(
    df: DataFrame,
    order: tuple[Column, Column],
    size: Column,
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """All rows and columns of `df`, with `shard` and `slot`.

    Rows are ordered by `order`, a pair of longs, and cut into `shards` runs whose
    sums of `size` differ by `tolerance` of a shard or by the size of a row at
    a cut. `slot` counts from 0 without gaps in every shard. The order must say
    the same each time `df` is computed; make it tell all rows apart where a
    run of equal ones may be as large as a shard.

    First only the two longs and the size are stored and counted. Then the rows are
    exchanged once, by ranges of bounded size (see `parts`): the counts give the
    slot at which each range begins, so no task sees a whole shard.

    Null order values come first, a null size counts 0, an empty table gives no rows;
    rows may repeat. Columns of `df` named `shard` or `slot` are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    kept = {f"c{i}": c for i, c in enumerate(df.columns) if c not in ("shard", "slot")}  # under names that no other column here has
    raw = durable(df.select(*(c.cast("long").alias(n) for n, c in zip(("key", "tie"), order)), size.cast("long").alias("size")))
    low = raw.agg(*(f(c).alias(f"{n}_{c}") for c in ("key", "tie") for n, f in (("min", F.min), ("max", F.max))), F.count(F.lit(1)).alias("n")).first()
    limits = {c: (low[f"min_{c}"] or 0, low[f"max_{c}"] or 0) for c in ("key", "tie")}
    key, tie = (spread(c.cast("long"), *limits[n]) for n, c in zip(("key", "tie"), order))
    rows = raw.select(*(spread(F.col(n), *limits[n]).alias(n) for n in ("key", "tie")), F.coalesce("size", F.lit(0)).alias("size"))

    total = rows.agg(F.sum("size")).first()[0] or 0
    many = parts(low["n"], total, 4 * shards)
    cuts = [Goal("bytes", total * i // shards, int(tolerance * total / shards)) for i in range(1, shards)]
    steps = [Goal("rows", low["n"] * i // many, low["n"] // (2 * many)) for i in range(1, many)]
    found = boundaries(rows, cuts + steps)
    firsts = [0]  # rows below the first of each shard
    positions = [0]
    for boundary in found[: shards - 1]:
        firsts.append(max(firsts[-1], boundary.rows))
        positions.append(max(positions[-1], boundary.position))
    split = ranges(found)
    owner = [max(i for i, p in enumerate(positions) if p <= b.position) for b in split.starts]
    offset = [b.rows - firsts[s] for b, s in zip(split.starts, owner)]
    at = F.element_at(F.array(*(F.struct(F.lit(s).alias("shard"), F.lit(o).cast("long").alias("slot")) for s, o in zip(owner, offset))), F.col("range") + 1)
    by_order = Window.partitionBy("range").orderBy("key", "tie")
    return (
        df.select(*(F.col(f"`{c}`").alias(n) for n, c in kept.items()), key.alias("key"), tie.alias("tie"))
        .withColumn("range", split.index(F.col("key"), F.col("tie")))
        .withColumn("place", F.row_number().over(by_order) - 1)
        .select(*(F.col(n).alias(c) for n, c in kept.items()), at["shard"].alias("shard"), (at["slot"] + F.col("place")).alias("slot"))
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, **options) -> DataFrame:
    """Digest of the shards of `docs`: doc_id, size, text_crc32, shard, slot.

    Documents are ordered by a hash of id and text. Rows that repeat are told apart by a
    number given when the digest is stored, so that they too can be split over shards.
    Size is the text's UTF-8 bytes plus 1; a null text counts as an empty one.
    """
    text = F.coalesce("text", F.lit(""))
    stored = durable(
        docs.select(
            "doc_id",
            (text_bytes(F.col("text")) + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64("doc_id", text).alias("hash"),
            F.xxhash64(F.monotonically_increasing_id()).alias("copy"),
        )
    )
    placed = histogram_sort(stored, (F.col("hash"), F.col("copy")), F.col("size"), shards, **options)
    return placed.drop("hash", "copy")
