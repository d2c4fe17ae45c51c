"""Cube, rollup and other grouping sets with HAVING, each level worked out from a finer stored one.

The fact is read once, for the finest level: one row for each combination of dimensions (and of
the values that are counted as different). SQL's own grouping sets copy every fact row once for each set before
it is grouped; here a set is grouped from the smallest stored level that holds its dimensions, so the work after
the first level depends on the number of combinations and no more on the fact.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentledger.sources.shared import durable


@dataclass(frozen=True)
class Measure:
    """`count` without a column counts rows; `distinct` counts different values; NULLs are left out as in SQL."""

    kind: Literal["sum", "count", "min", "max", "avg", "distinct"]
    column: str | Column | None = None


_PARTS = {"sum": ("sum",), "count": ("count",), "min": ("min",), "max": ("max",), "avg": ("sum", "count"), "distinct": ()}
_FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_AGAIN = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def cube_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(dims), -1, -1) for s in combinations(dims, n)]


def rollup_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dims[:n]) for n in range(len(dims), -1, -1)]


def grouping_sets(
    fact: DataFrame,
    dims: Mapping[str, str | Column],
    measures: Mapping[str, Measure],
    sets: Iterable[Sequence[str]],
    having: Column | None = None,
    level: str = "level",
) -> DataFrame:
    """A row for each group of each set: the dimensions, NULL where the set has not got them, `level` and the measures.

    `level` is SQL's GROUPING_ID of all dimensions: bit by bit 1 for those that are summed over, the first one
    highest, which tells a total from a group of NULLs. `having` is a condition on the result's columns; a group for which it is
    NULL goes. The set of no dimensions has one row, also for an empty fact, as a global aggregate has.

    The finest level (all dimensions that any set has) is stored, and every set that a coarser one can be made
    from. Counts of different values stay exact on every level, as the values are kept beside the dimensions.
    """
    column = lambda c: F.col(c) if isinstance(c, str) else c
    wanted = list(dict.fromkeys(tuple(d for d in dims if d in set(s)) for s in sets))
    values = {n: f"_d{i}" for i, (n, m) in enumerate(measures.items()) if m.kind == "distinct"}
    parts = {f"_p{i}_{part}": (f"_m{i}", part) for i, m in enumerate(measures.values()) for part in _PARTS[m.kind]}
    finest = tuple(d for d in dims if any(d in s for s in wanted))

    one = lambda m: F.lit(1) if m.column is None else column(m.column)
    rows = fact.select(
        *(column(c).alias(n) for n, c in dims.items() if n in finest),
        *(column(measures[n].column).alias(v) for n, v in values.items()),
        *(one(m).alias(f"_m{i}") for i, m in enumerate(measures.values()) if m.kind != "distinct"),
    )
    first = [_FIRST[part](source).alias(p) for p, (source, part) in parts.items()]
    again = [_AGAIN[part](p).alias(p) for p, (_, part) in parts.items()]
    counted = F.count(F.lit(1)).alias("_n")

    made: dict[tuple[str, ...], DataFrame] = {finest: durable(rows.groupBy(*finest, *values.values()).agg(counted, *first))}
    found = []
    for own in sorted({*wanted, finest}, key=lambda s: -len(s)):
        if own not in made:
            parent = min((s for s in made if set(own) <= set(s)), key=len)
            grain = made[parent].groupBy(*own, *values.values()).agg(F.sum("_n").alias("_n"), *again)
            made[own] = durable(grain) if any(set(s) < set(own) for s in wanted) else grain
        if own in wanted:
            found.append(_finished(made[own], own, dims, measures, values, again, level))
    result = reduce(DataFrame.unionByName, found)
    return result if having is None else result.where(having)


def _finished(grain, own, dims, measures, values, again, level) -> DataFrame:
    """One set's rows from a level that has its dimensions, one row for each counted value."""
    distinct = [F.count(v) if len(values) == 1 else F.count_distinct(v) for v in values.values()]
    grouped = grain.groupBy(*own).agg(*again, *(d.alias(v) for d, v in zip(distinct, values.values())))
    bits = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in own)
    kinds = dict(grain.dtypes)
    shown = []
    for i, (name, m) in enumerate(measures.items()):
        if m.kind == "distinct":
            shown.append(F.col(values[name]).alias(name))
        elif m.kind == "avg":
            shown.append((F.col(f"_p{i}_sum").cast("double") / F.col(f"_p{i}_count")).alias(name))
        elif m.kind == "count":
            shown.append(F.coalesce(F.col(f"_p{i}_count"), F.lit(0)).cast("long").alias(name))
        else:
            part = f"_p{i}_{m.kind}"
            shown.append(F.col(part).cast(kinds[part]).alias(name))
    return grouped.select(*(F.col(d).alias(d) if d in own else F.lit(None).alias(d) for d in dims), F.lit(bits).cast("long").alias(level), *shown)


def cube(fact: DataFrame, dims: Mapping[str, str | Column], measures: Mapping[str, Measure], having: Column | None = None, level: str = "level") -> DataFrame:
    """All combinations of the dimensions."""
    return grouping_sets(fact, dims, measures, cube_sets(list(dims)), having, level)


def rollup(fact: DataFrame, dims: Mapping[str, str | Column], measures: Mapping[str, Measure], having: Column | None = None, level: str = "level") -> DataFrame:
    """The dimensions, without the last, without the last two, and so on to the total."""
    return grouping_sets(fact, dims, measures, rollup_sets(list(dims)), having, level)
