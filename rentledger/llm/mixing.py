"""Mixing sources to target weights by Pfair scheduling.

The rows of a source, in a hash order, fill blocks of equal bytes. Blocks are
the unit tasks of one processor: block i of a source that is due q of every Q
slots is released at floor(i*Q/q) and has its deadline at ceil((i+1)*Q/q), and
every slot takes the released block with the earliest deadline. All deadlines
are met, so after any number t of slots a source has had more than t*q/Q - 1 and
fewer than t*q/Q + 1 blocks. With whole weights the schedule repeats after Q
slots: one period is worked out from the weights alone, and the slot of every
block in the data follows by division.

Where a source has no blocks left, a new period begins there with the weights of
the remaining ones, so all rows are kept and each phase has that bound.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentledger.llm.common import constant, in_files, text_bytes
from rentledger.llm.histogram import Goal, boundaries, parts, ranges
from rentledger.sources.shared import durable

BLOCK_BYTES = 65_536
MAX_STREAMS, MAX_PERIOD = 255, 100_000
STREAM_BITS = 8


def period(weights: Mapping[int, int]) -> list[int]:
    """Earliest deadline first over one period of released blocks: the stream of every slot."""
    total = sum(weights.values())
    waiting = [(0, s, 0) for s in sorted(weights)]  # release, stream, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slots = []
    for now in range(total):
        while waiting and waiting[0][0] <= now:
            _, stream, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * total // weights[stream]), stream, block))
        deadline, stream, block = heapq.heappop(ready)
        assert deadline > now
        slots.append(stream)
        if block + 1 < weights[stream]:
            heapq.heappush(waiting, ((block + 1) * total // weights[stream], stream, block + 1))
    return slots


def phases(weights: Mapping[int, int], blocks: Mapping[int, int]) -> list[dict]:
    """Runs of slots with one set of weights; each ends where the first of its streams has no block left."""
    left = {s: blocks[s] for s in weights if blocks.get(s, 0) > 0}
    done, start, found = dict.fromkeys(left, 0), 0, []
    while left:
        own = {s: weights[s] for s in left}
        slots = period(own)
        at = {s: [t for t, x in enumerate(slots) if x == s] for s in own}
        ends = {s: (n - 1) // own[s] * len(slots) + at[s][(n - 1) % own[s]] + 1 for s, n in left.items()}
        end = min(ends.values())
        used = {s: end // len(slots) * own[s] + sum(t < end % len(slots) for t in at[s]) for s in own}
        found.append({"start": start, "period": len(slots), "at": at, "done": dict(done), "used": used})
        start += end
        done = {s: n + used.get(s, 0) for s, n in done.items()}
        left = {s: n - used[s] for s, n in left.items() if n > used[s]}
    return found


def _slot(plan: list[dict], streams: int, stream: Column, block: Column) -> Column:
    """Slot of a block, from constant arrays whose size depends on the weights only."""
    times, by_stream = [], [[] for _ in range(streams)]
    for phase in plan:
        for s, at in phase["at"].items():
            first = phase["done"][s]
            by_stream[s].append({
                "lo": first, "hi": first + phase["used"][s], "q": len(at),
                "n": phase["period"], "t": phase["start"], "o": len(times),
            })
            times.extend(at)
    kind = "array<struct<lo:bigint,hi:bigint,q:bigint,n:bigint,t:bigint,o:bigint>>"
    own = F.element_at(constant(by_stream, kind), stream + 1)
    phase = F.element_at(F.filter(own, lambda p: (p["lo"] <= block) & (block < p["hi"])), 1)
    i = block - phase["lo"]
    in_period = F.element_at(constant(times, "bigint"), (phase["o"] + i % phase["q"] + 1).cast("int"))
    return phase["t"] + F.floor(i / phase["q"]) * phase["n"] + in_period


def mix(
    docs: DataFrame,
    weights: Mapping[str, int],
    other: int = 1,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every row of `docs` with `stream`, `block`, `place` and `slot`; sort by `slot`, `place` for the mixture.

    `weights` gives whole target weights by source; the sources that it does not
    name, and null ones, form one more stream of weight `other`. A row's size is its
    text's UTF-8 bytes plus 1; it belongs to the block in which it begins, and a text
    longer than a block holds the slots of all its blocks. `place` is the row's number in its stream.

    Within a stream rows are ordered by a hash of id and text, equal ones by where they are stored. Ranges of that order
    are counted exactly as in the histogram sort, so running sums are made over
    ranges of bounded size and never over a source, nor over the copies of one row. `docs` that are not read from files are stored
    first. Null texts have size 1, an empty table gives no rows. Columns of `docs` with one of the four names are replaced.
    """
    if len(weights) >= MAX_STREAMS or sum(weights.values()) + other > MAX_PERIOD:
        raise ValueError(f"at most {MAX_STREAMS} streams and {MAX_PERIOD} slots a period")
    if other < 1 or min(weights.values(), default=1) < 1:
        raise ValueError("weights are whole numbers from 1")
    names, own = list(weights), dict(enumerate([*weights.values(), other]))
    docs = in_files(docs)
    kept = {f"c{i}": c for i, c in enumerate(docs.columns) if c not in ("stream", "block", "place", "slot")}  # under names that no other column here has
    place = F.coalesce(F.array_position(constant(names, "string"), F.col("source")), F.lit(0)).cast("int")
    stream = F.when(place == 0, len(names)).otherwise(place - 1)
    text = F.coalesce("text", F.lit(""))
    hashed = F.shiftrightunsigned(F.xxhash64("doc_id", text), STREAM_BITS)
    key = F.shiftleft(stream.cast("long") - 128, 64 - STREAM_BITS).bitwiseOR(hashed)
    tie = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    size = text_bytes(F.col("text")) + 1

    rows = durable(docs.select(key.alias("key"), tie.alias("tie"), size.alias("size")))
    sums = rows.groupBy((F.shiftright("key", 64 - STREAM_BITS) + 128).cast("int").alias("stream")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    totals = {r.stream: r for r in sums.collect()}
    before, n = [], {"bytes": 0, "rows": 0}
    for s in own:
        before.append(dict(n))
        n = {m: v + (totals[s][m] if s in totals else 0) for m, v in n.items()}
    many = parts(n["rows"], n["bytes"], 64)
    split = ranges(boundaries(rows, [Goal("rows", n["rows"] * i // many, n["rows"] // (2 * many)) for i in range(1, many)]))
    plan = phases(own, {s: -(-r.bytes // block_bytes) for s, r in totals.items()})

    start = F.element_at(constant([{"b": b.bytes, "r": b.rows} for b in split.starts], "struct<b:bigint,r:bigint>"), F.col("range") + 1)
    base = F.element_at(constant([{"b": b["bytes"], "r": b["rows"]} for b in before], "struct<b:bigint,r:bigint>"), F.col("stream") + 1)
    window = Window.partitionBy("range").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        docs.select(*(F.col(f"`{c}`").alias(n) for n, c in kept.items()), stream.alias("stream"), key.alias("key"), tie.alias("tie"), size.alias("size"))
        .withColumn("range", split.index(F.col("key"), F.col("tie")))
        .withColumn("bytes", F.sum("size").over(window) - F.col("size"))
        .withColumn("rows", F.count(F.lit(1)).over(window) - 1)
        .withColumn("block", F.floor((start["b"] + F.col("bytes") - base["b"]) / block_bytes).cast("long"))
        .withColumn("place", start["r"] + F.col("rows") - base["r"])
        .withColumn("slot", _slot(plan, len(own), F.col("stream"), F.col("block")).cast("long"))
        .select(*(F.col(n).alias(c) for n, c in kept.items()), "stream", "block", "place", "slot")
    )


def mixed_documents(docs: DataFrame, weights: Mapping[str, int], other: int = 1, **options) -> DataFrame:
    """The rows and columns of `docs`, stored in the order of the mixture.

    Partitions follow one another and are sorted, so the files a writer makes of them
    hold the mixture in the order of their names.
    """
    own = ("doc_id", "text", "source")
    inner = {c: c if c in own else f"__{i}" for i, c in enumerate(docs.columns)}
    mixed = mix(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in inner.items())), weights, other, **options)
    placed = mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return placed.select(*(F.col(n).alias(c) for c, n in inner.items()))
