"""Interval joins, and bookings that overlap.

An equality join cannot say "between". Here every interval is put into bins whose width is
the power of four next to its own length, so it stands in two bins at most and fills a good part of
them. A point looks into its one bin of each width that occurs. As widths follow the lengths
in the data, short and long bookings side by side neither fill wide bins with short intervals
nor copy long ones into thousands of narrow bins.

Where a bin holds more intervals than a task should compare every point with, its intervals are dealt to parts
and its points are copied to each. Such bins are found in two steps: intervals are counted per bucket of bins, of which
there is a fixed number, and only the bins of crowded buckets are counted one by one. Bins with many points are
split by Spark's adaptive skew join, as both sides come straight from a shuffle.

Rows go through the join in plain columns, so that only columns that are used later are moved and pairs are compared in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentledger.operators.joins import semi_join
from rentledger.operators.running import Running, with_running
from rentledger.sources.shared import durable, stored_once

PART = 10_000  # intervals of a bin that a point is compared with in one task
BUCKETS = 1 << 16  # of bins of one width, for the first count
_WIDEST = 31  # exponent of four; 2**62 is the widest bin


def _whole(moment: Column, kind: str) -> Column:
    """A whole number that never goes down as the value goes up: microseconds, days, or the number rounded down."""
    if kind.startswith("timestamp"):
        return F.unix_micros(moment.cast("timestamp"))
    return F.unix_date(moment).cast("long") if kind == "date" else F.floor(moment).cast("long")


def _bin(value: str, level: str) -> str:
    return f"shiftright({value}, 2 * {level})"


def _binned(spans: DataFrame) -> DataFrame:
    """A row for each bin of every interval; 4**_level is at least the interval's length."""
    digits = F.length(F.bin(F.coalesce(F.try_subtract("_to", "_from"), F.lit((1 << 63) - 1))))  # as it may not fit
    level = F.least(F.shiftright(digits + 1, 1), F.lit(_WIDEST))
    bins = F.sequence(F.expr(_bin("_from", "_level")), F.expr(_bin("_to", "_level")))
    return spans.withColumn("_level", level).withColumn("_bin", F.explode(bins))


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    at: str,
    between: tuple[str, str],
    keys: Sequence[tuple[str, str]] = (),
    closed: bool = False,
    condition: Column | None = None,
    part: int = PART,
    known_keys: bool = False,
) -> DataFrame:
    """Every point row with every span row around it: `from <= at < to`, or `<= to` if `closed`. All columns of both, which must differ.

    `keys` are pairs of columns that must be equal, `condition` is one more test of a pair. Rows with a NULL in any of these
    columns, and spans that end before they begin, match nothing. Each pair is found once, in the one
    bin of the span's width that holds the point; rows that repeat give pairs that repeat. Points whose keys no span has
    are dropped before they are copied for each width; `known_keys` says that there are none.
    """
    start, end = between
    if clash := set(points.columns) & set(spans.columns):
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    names = [f"_k{i}" for i in range(len(keys))]
    kinds = {**dict(points.dtypes), **dict(spans.dtypes)}
    inner = {c: f"_{side}{i}" for side, table in (("p", points), ("s", spans)) for i, c in enumerate(table.columns)}  # names that clash with none
    moved = lambda table: [F.col(c).alias(inner[c]) for c in table.columns]
    own = stored_once(spans).dropna(subset=[start, end, *(k for _, k in keys)]).where(F.col(start) <= F.col(end))
    asked = stored_once(points).dropna(subset=[at, *(k for k, _ in keys)])
    if keys and not known_keys:
        asked = semi_join(asked, own, [k for k, _ in keys], [k for _, k in keys])
    binned = _binned(
        own.select(
            *(F.col(k).alias(n) for n, (_, k) in zip(names, keys)), *moved(spans),
            _whole(F.col(start), kinds[start]).alias("_from"), _whole(F.col(end), kinds[end]).alias("_to"),
            F.monotonically_increasing_id().alias("_place"),
        )
    )
    place = [*names, "_level", "_bin"]
    crowded, levels = _crowded(binned.select(*place), place, part)
    looked = (
        asked.select(*(F.col(k).alias(n) for n, (k, _) in zip(names, keys)), *moved(points), _whole(F.col(at), kinds[at]).alias("_at"))
        .withColumn("_level", F.explode(F.array(*(F.lit(n) for n in levels))))
        .withColumn("_bin", F.expr(_bin("_at", "_level")))
    )
    if crowded is not None:
        parts = F.coalesce("_parts", F.lit(1))
        binned = binned.join(crowded, place, "left").withColumn("_part", F.pmod(F.xxhash64("_place"), parts)).drop("_parts")
        looked = looked.join(crowded, place, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
        place = [*place, "_part"]
    begun, when, over = F.col(inner[start]), F.col(inner[at]), F.col(inner[end])
    inside = (begun <= when) & ((when <= over) if closed else (when < over))
    pairs = looked.drop("_at").join(binned.drop("_from", "_to", "_place"), place).where(inside)
    pairs = pairs.select(*(F.col(name).alias(c) for c, name in inner.items()))
    return pairs if condition is None else pairs.where(condition)


def _crowded(bins: DataFrame, place: Sequence[str], part: int) -> tuple[DataFrame | None, list[int]]:
    """The bins with more than `part` intervals and their number of parts, or None; and the widths that occur, 31 at most."""
    hashed = bins.withColumn("_bucket", F.pmod(F.xxhash64(*place), F.lit(BUCKETS)))
    counted = durable(hashed.groupBy("_level", "_bucket").agg(F.count(F.lit(1)).alias("n")))
    levels = sorted(r[0] for r in counted.select("_level").distinct().collect()) or [0]
    full = counted.where(F.col("n") > part).select("_level", "_bucket")
    if full.isEmpty():
        return None, levels
    exact = hashed.join(full, ["_level", "_bucket"], "left_semi").groupBy(*place).agg(F.count(F.lit(1)).alias("n"))
    crowded = durable(exact.where(F.col("n") > part).select(*place, F.ceil(F.col("n") / part).alias("_parts")))
    return (None if crowded.isEmpty() else crowded), levels


def _swept(bookings: DataFrame, start: str, end: str, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Bookings that last, with the largest end of those before them."""
    return with_running(
        bookings.where(F.col(start) < F.col(end)), {"_busy_until": Running("max", end, before=True)}, [start], keys, ties=by
    )


def conflicts(bookings: DataFrame, start: str, end: str, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Bookings that begin while an earlier one of the same `keys` lasts.

    Earlier goes by `start`, then by the columns `by`, which tell bookings apart. One sweep in that order with the largest end
    so far, carried over ranges: no booking is compared with another one, and a hot key is cut.
    Bookings without a beginning or an end, or of no length, take no time and conflict with nothing.
    """
    swept = _swept(bookings, start, end, keys, by)
    return swept.where(F.col(start) < F.col("_busy_until")).drop("_busy_until")


def overlaps(bookings: DataFrame, start: str, end: str, keys: Sequence[str], by: Sequence[str], part: int = PART) -> DataFrame:
    """Pairs of bookings of the same `keys` that overlap, each once: all columns as `first_...` and `second_...`, the earlier one first.

    Only bookings that the sweep finds in conflict are looked up among the others. Bookings with NULL keys are not paired.
    What the sweep finds is stored, and both sides of the pairs are read from there. `by` is compared only where two begin at once.
    """
    swept = durable(_swept(bookings, start, end, keys, by))
    lasting, later = (rows.drop("_busy_until") for rows in (swept, swept.where(F.col(start) < F.col("_busy_until"))))
    named = lambda df, side: df.select(*(F.col(c).alias(f"{side}_{c}") for c in df.columns))
    ties = lambda side: F.struct(*(F.col(f"{side}_{c}") for c in by))
    begun, begins = F.col(f"first_{start}"), F.col(f"second_{start}")
    earlier = (begun < begins) | ((begun == begins) & (ties("first") < ties("second"))) if by else begun < begins
    return interval_join(
        named(later, "second"), named(lasting, "first"), f"second_{start}", (f"first_{start}", f"first_{end}"),
        [(f"second_{k}", f"first_{k}") for k in keys], condition=earlier, part=part, known_keys=True,
    )


def audit_no_overlap(bookings: DataFrame, name: str, start: str, end: str, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """`(constraint, n_violations)`: how many bookings begin while an earlier one lasts, in the form of the other audits."""
    found = conflicts(bookings, start, end, keys, by)
    return found.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("constraint"), "n_violations")

