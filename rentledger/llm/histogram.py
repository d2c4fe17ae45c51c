"""Exact quantile boundaries by counting: the core of the histogram sort.

Rows are ordered by a pair of longs (`key`, `tie`). A boundary is wanted where the
bytes, or the rows, below it reach a goal. Every round counts what lies in the
children of the intervals that still hold an unmet goal, in one grouped sum
with map-side combining, and keeps the child that the goal falls into.
The driver sees counts of intervals only: 65,536 in the first round and
256 for each unmet goal in later ones.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentledger.llm.common import constant

FIRST_BITS, NEXT_BITS = 16, 8
ROWS_PER_RANGE, BYTES_PER_RANGE = 500_000, 1 << 27
MOST_RANGES = 1 << (FIRST_BITS - 1)  # beyond it ranges grow, and sorts within them spill
HALF, END = 1 << 63, 1 << 128


@dataclass(frozen=True)
class Goal:
    """Wanted: `amount` of `measure` ("bytes" or "rows") below a boundary, give or take `tolerance`."""

    measure: str
    amount: int
    tolerance: int


@dataclass(frozen=True, order=True)
class Boundary:
    """Rows at or after `position` (key and tie, both moved to unsigned, side by side) are above it."""

    position: int
    rows: int
    bytes: int


@dataclass(frozen=True)
class Interval:
    """All positions that start with the `bits` bits of `prefix`, and what lies below and in them."""

    prefix: int
    bits: int
    below: dict
    inside: dict

    def edge(self, upper: bool) -> Boundary:
        found = {m: self.below[m] + (self.inside[m] if upper else 0) for m in self.below}
        return Boundary((self.prefix + upper) << (128 - self.bits), found["rows"], found["bytes"])


def _count(rows: DataFrame, *by: Column) -> list:
    return (
        rows.groupBy(*(c.alias(f"p{i}") for i, c in enumerate(by)))
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )


def _unsigned(value: int, bits: int) -> int:
    return value + (1 << (bits - 1))


def _first(rows: DataFrame) -> list[Interval]:
    counts = {_unsigned(r.p0, FIRST_BITS): r for r in _count(rows, F.shiftright("key", 64 - FIRST_BITS))}
    return _in_order(counts, FIRST_BITS, {"rows": 0, "bytes": 0})


def _in_order(counts: dict, bits: int, below: dict) -> list[Interval]:
    found = []
    for prefix in sorted(counts):
        inside = {"rows": counts[prefix].rows, "bytes": counts[prefix].bytes}
        found.append(Interval(prefix, bits, below, inside))
        below = {m: below[m] + inside[m] for m in below}
    return found


def _children(rows: DataFrame, parents: list[Interval], bits: int) -> dict[int, list[Interval]]:
    """Intervals that are `NEXT_BITS` longer, below each parent."""
    wanted = {p.prefix: p for p in parents}
    deep = bits + NEXT_BITS
    if bits < 64:
        chosen = rows.where(F.shiftright("key", 64 - bits).isin([p - (1 << (bits - 1)) for p in wanted]))
        counted = {_unsigned(r.p0, deep): r for r in _count(chosen, F.shiftright("key", 64 - deep))}
    else:
        of_tie = bits - 64  # bits of the tie that are settled already
        pairs = [(p >> of_tie, p & ((1 << of_tie) - 1)) for p in wanted]
        same = [
            (F.col("key") == key - HALF)
            & (F.lit(True) if not of_tie else F.shiftright("tie", 64 - of_tie) == tie - (1 << (of_tie - 1)))
            for key, tie in pairs
        ]
        chosen = rows.where(reduce(lambda a, b: a | b, same))
        counted = {
            ((r.p0 + HALF) << (deep - 64)) + _unsigned(r.p1, deep - 64): r
            for r in _count(chosen, F.col("key"), F.shiftright("tie", 128 - deep))
        }
    found = {}
    for prefix, parent in wanted.items():
        own = {k: r for k, r in counted.items() if k >> NEXT_BITS == prefix}
        found[prefix] = _in_order(own, deep, parent.below)
    return found


def _holding(intervals: list[Interval], goal: Goal) -> Interval:
    at = bisect_right([i.below[goal.measure] for i in intervals], goal.amount) - 1
    return intervals[max(0, at)]


def boundaries(rows: DataFrame, goals: list[Goal]) -> list[Boundary]:
    """The boundary for every goal, over stored rows of `key`, `tie` and `size`.

    It is within the goal's tolerance wherever single rows are small enough
    to allow that; else no row order has a nearer one.
    """
    first = _first(rows)
    if not first:
        return [Boundary(END, 0, 0) for _ in goals]
    now, bits = [_holding(first, goal) for goal in goals], FIRST_BITS
    while bits < 128:
        unmet = [
            i for i, goal in enumerate(goals)
            if now[i].bits == bits and now[i].inside["rows"] > 1 and now[i].inside[goal.measure] > goal.tolerance
        ]
        if not unmet:
            break
        below = _children(rows, [now[i] for i in unmet], bits)
        for i in unmet:
            now[i] = _holding(below[now[i].prefix], goals[i])
        bits += NEXT_BITS
    found = []
    for goal, interval in zip(goals, now):
        into = goal.amount - interval.below[goal.measure]
        found.append(interval.edge(upper=2 * into > interval.inside[goal.measure]))
    return found


@dataclass(frozen=True)
class Ranges:
    """Consecutive ranges of the order; `starts[0]` is the beginning."""

    starts: list[Boundary]

    def index(self, key: Column, tie: Column) -> Column:
        """Number of a row's range. Only the few boundaries inside the row's first interval are compared."""
        positions = [b.position for b in self.starts[1:]]
        width = 128 - FIRST_BITS
        base = [bisect_right(positions, i << width) for i in range(1 << FIRST_BITS)]
        last = [bisect_left(positions, (i + 1) << width) for i in range(1 << FIRST_BITS)]
        at = (F.shiftright(key, 64 - FIRST_BITS) + (1 << (FIRST_BITS - 1)) + 1).cast("int")
        pairs = [{"k": (p >> 64) - HALF, "t": (p & (2 * HALF - 1)) - HALF} for p in positions]
        start = F.element_at(constant(base, "int"), at)
        many = F.element_at(constant([b - a for a, b in zip(base, last)], "int"), at)
        own = F.slice(constant(pairs, "struct<k:bigint,t:bigint>"), start + 1, F.greatest(many, F.lit(0)))
        passed = F.filter(own, lambda s: (s["k"] < key) | ((s["k"] == key) & (s["t"] <= tie)))
        return start + F.when(many > 0, F.size(passed)).otherwise(0)


def parts(rows: int, size: int, least: int) -> int:
    """Ranges to make of so many rows and bytes, so that a task that sorts one has little to do."""
    return max(least, min(MOST_RANGES, max(-(-rows // ROWS_PER_RANGE), -(-size // BYTES_PER_RANGE))))


def ranges(found: list[Boundary]) -> Ranges:
    inner = {b.position: b for b in found if 0 < b.position < END}
    return Ranges([Boundary(0, 0, 0), *sorted(inner.values())])


def spread(column: Column, low: int, high: int) -> Column:
    """Longs between `low` and `high` moved up to fill the upper bits, order kept, so that few rounds tell them apart."""
    column = F.coalesce(column, F.lit(low)).cast("long")
    shift = 63 - (high - low).bit_length()
    return F.shiftleft(column - low, shift) if shift >= 0 else column
