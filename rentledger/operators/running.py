"""Running totals, ranks and carried values, over a whole table or per key, however hot a key is.

A window over one key is one task. Here it is a prefix scan in two passes instead:

1. rows are cut into ranges of (keys, order) by a range exchange, which also cuts through a
   key and through runs of equal rows; windows run inside (range, key) only, and their result is
   stored;
2. the last row of every (range, key) holds what the range adds to its key. Sums and ranks of
   these few rows say what each range has to carry, and are joined back.

Only a range's first and last key can go on in another range, so what is joined back has at
most two rows a range, whatever the table holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentledger.functions.ordering import asc, desc
from rentledger.sources.shared import durable, stored_once

Kind = Literal["total", "sum", "count", "min", "max", "last", "lag", "lead", "row_number", "rank", "dense_rank", "size"]


@dataclass(frozen=True)
class Running:
    """One running value.

    `sum`, `count`, `min`, `max` and `last` (the latest value that is not NULL) cover the rows up to and with the
    row itself, or without it if `before`. `total` is a sum that includes all rows of equal order, as SQL's
    default frame does. `lag` and `lead` are the value of the row before and the row after, NULL or not. `rank` and
    `dense_rank` count rows and values of smaller order, `size` all rows of the key; they and `row_number` take no value.
    """

    kind: Kind
    value: str | Column | None = None
    before: bool = False


_OF_PEERS = {"total", "rank", "dense_rank"}
_ONE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
_NEXT_TO = {"lag": F.lag, "lead": F.lead}
_COMBINE = {"sum": F.sum, "total": F.sum, "count": F.sum, "min": F.min, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}


def _value(running: Running) -> Column:
    return F.col(running.value) if isinstance(running.value, str) else F.lit(1) if running.value is None else running.value


def _joined(kind: Kind, carried: Column, own: Column) -> Column:
    """What came before and what the range itself has; either may be NULL."""
    if kind in ("sum", "total", "count"):
        return F.when(carried.isNull(), own).when(own.isNull(), carried).otherwise(carried + own)
    return {"min": F.least, "max": F.greatest}[kind](carried, own) if kind in ("min", "max") else F.coalesce(own, carried)


def with_running(
    table: DataFrame,
    values: Mapping[str, Running],
    order: Sequence[str],
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """All rows of `table` with the running `values`, per `keys` or over the whole table.

    Rows go by `order`, all ascending or all `descending`; NULL is the largest value. Rows of equal order
    are peers and go by `ties`, ascending; what is left equal has some fixed order. NULL keys are one key. An
    empty table gives no rows.

    The table is exchanged twice, by range and by (range, key), and stored once. No task has more than a range, and the
    single window that goes over ranges sees one row of each.
    """
    way = desc if descending else asc
    names = list(values)
    packed = F.struct(*order)
    rows = stored_once(table).withColumn("_tie", F.monotonically_increasing_id())
    sort = [*(way(c) for c in order), *(asc(c) for c in ties), F.col("_tie").asc()]
    ranged = rows.repartitionByRange(*(F.col(k).asc() for k in keys), *sort).withColumn("_range", F.spark_partition_id())

    own = Window.partitionBy("_range", *keys).orderBy(*sort)
    so_far = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = own.rowsBetween(Window.unboundedPreceding, -1)
    kinds = {running.kind for running in values.values()}
    peers = bool(kinds & _OF_PEERS)
    made = {"_n": F.row_number().over(own), "_end": F.lead(F.lit(True)).over(own).isNull()}
    if peers:
        made["_from"] = F.first(packed).over(so_far)
        made["_new"] = ~F.coalesce(F.lag(packed).over(own).eqNullSafe(packed), F.lit(False)) | (F.row_number().over(own) == 1)
    for i, running in enumerate(values.values()):
        if running.kind in _ONE:
            made[f"_v{i}"] = _ONE[running.kind](_value(running)).over(so_far)
            if running.before:
                made[f"_b{i}"] = _ONE[running.kind](_value(running)).over(earlier)
        elif running.kind == "size":
            made[f"_v{i}"] = F.count(F.lit(1)).over(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        elif running.kind in _NEXT_TO:  # in a struct, which tells a NULL from no row
            value = F.struct(_value(running))
            made[f"_v{i}"] = value if running.kind == "lag" else F.first(value).over(so_far)
            made[f"_b{i}"] = _NEXT_TO[running.kind](value).over(own)
    local = ranged.withColumns(made)
    totals = [i for i, running in enumerate(values.values()) if running.kind == "total"]
    if peers:
        counted = {"_dense": F.count_if("_new").over(so_far), "_rank": F.max(F.when(F.col("_new"), F.col("_n"))).over(so_far)}
        for i in totals:
            counted[f"_h{i}"] = F.sum(F.when(packed.eqNullSafe(F.col("_from")), _value(values[names[i]]))).over(so_far)  # of the first peers
        local = local.withColumns(counted)
    if totals:
        with_peers = Window.partitionBy("_range", *keys).orderBy(*(way(c) for c in order))
        local = local.withColumns({f"_v{i}": F.sum(_value(values[names[i]])).over(with_peers) for i in totals})
    of_rows = {f"_b{i}" if running.before or running.kind in _NEXT_TO else f"_v{i}" for i, running in enumerate(values.values())}
    of_rows |= {c for c, users in (("_n", {"row_number", "lag"}), ("_dense", {"rank", "dense_rank"}), ("_rank", {"rank"})) if kinds & users}
    of_ends = [c for c in local.columns if c not in {*rows.columns, "_range", "_end", "_new", *of_rows}]
    slim = local.withColumns({c: F.when(F.col("_end"), F.col(c)) for c in of_ends})  # the rest needs them of the last rows only
    local = durable(slim.drop("_new", "_tie"))

    inner = [c for c in local.columns if c in {*of_ends, *of_rows} and c[:2] != "_b"]
    ends = local.where("_end").select("_range", *keys, *inner, packed.alias("_to"))
    offsets = _offsets(ends, values, keys)
    met = [F.col("_range") == F.col("_o_range"), *(F.col(k).eqNullSafe(F.col(f"_o_k{i}")) for i, k in enumerate(keys))]
    # at most two rows a range, so as many as there are partitions
    both = local.join(F.broadcast(offsets), reduce(Column.__and__, met), "left")
    found = []
    for i, (name, running) in enumerate(values.items()):
        if running.kind == "row_number":
            column = F.col("_n") + F.coalesce("_o_n", F.lit(0))
        elif running.kind == "dense_rank":
            column = F.col("_dense") + F.coalesce("_o_dense", F.lit(0))
        elif running.kind == "rank":
            carried = F.when((F.col("_dense") == 1) & F.col("_o_continues"), F.col("_o_rank"))
            column = F.coalesce(carried, F.col("_rank") + F.coalesce("_o_n", F.lit(0)))
        elif running.kind == "size":
            column = F.coalesce(f"_o{i}", f"_v{i}")
        elif running.kind in _NEXT_TO:  # the carried value is that of the key's first or last row in the range
            (field,) = local.schema[f"_b{i}"].dataType.names
            column = F.coalesce(f"_b{i}", F.when(F.col("_end") if running.kind == "lead" else F.col("_n") == 1, F.col(f"_o{i}")))[field]
        else:
            mine = F.col(f"_b{i}" if running.before else f"_v{i}")
            column = _joined(running.kind, F.col(f"_o{i}"), mine)
            if running.kind == "total":
                behind = F.when(packed.eqNullSafe(F.col("_o_to")), F.col(f"_t{i}"))
                column = _joined("sum", behind, column)
            column = column.cast(local.schema[f"_v{i}"].dataType)
        if running.kind in ("row_number", "rank", "dense_rank", "size"):
            column = column.cast("long")
        found.append(column.alias(name))
    return both.select(*(F.col(c) for c in table.columns if c not in values), *found)


def _offsets(ends: DataFrame, values: Mapping[str, Running], keys: Sequence[str]) -> DataFrame:
    """What a range's rows of a key have to add, for keys that stand in several ranges."""
    ranges = Window.partitionBy(*keys).orderBy("_range")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    after = ranges.rowsBetween(1, Window.unboundedFollowing)
    whole = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = [i for i, running in enumerate(values.values()) if running.kind == "total"]
    peers = any(running.kind in _OF_PEERS for running in values.values())
    same = F.coalesce(F.lag("_to").over(ranges).eqNullSafe(F.col("_from")) & F.lag(F.lit(True)).over(ranges), F.lit(False)) if peers else F.lit(False)
    step = ends.withColumns({"_several": F.count(F.lit(1)).over(whole) > 1, "_continues": same, "_o_n": F.sum("_n").over(before)})
    carried = {}
    if peers:
        one = F.when(F.col("_continues"), 1).otherwise(0)
        starts = F.when((F.col("_dense") > 1) | ~F.col("_continues"), F.coalesce("_o_n", F.lit(0)) + F.col("_rank"))
        carried["_o_dense"] = F.coalesce(F.sum(F.col("_dense") - one).over(before), F.lit(0)) - one
        carried["_o_rank"] = F.last(starts, ignorenulls=True).over(before)
    upto = ranges.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for i in totals:  # sums of first peers, and how many ranges have one
        carried[f"_c{i}"] = F.struct(F.sum(F.coalesce(f"_h{i}", F.lit(0))).over(upto).alias("v"), F.count(f"_h{i}").over(upto).alias("n"))
    for i, running in enumerate(values.values()):
        if running.kind in _COMBINE:
            carried[f"_o{i}"] = _COMBINE[running.kind](F.col(f"_v{i}")).over(before)
        elif running.kind == "size":
            carried[f"_o{i}"] = F.sum("_n").over(whole)
        elif running.kind in _NEXT_TO:
            carried[f"_o{i}"] = _NEXT_TO[running.kind](F.col(f"_v{i}")).over(ranges)
    step = step.withColumns(carried)
    # the last peers go on until a range that begins with other ones, or that has other ones behind its first
    tails = {}
    for i in totals:
        own, mine = F.struct(F.coalesce(f"_h{i}", F.lit(0)).alias("v"), F.col(f"_h{i}").isNotNull().cast("long").alias("n")), F.col(f"_c{i}")
        apart = F.struct((mine["v"] - own["v"]).alias("v"), (mine["n"] - own["n"]).alias("n"))
        stop = F.when(~F.col("_continues"), apart).when(F.col("_dense") > 1, mine)
        last = F.coalesce(F.first(stop, ignorenulls=True).over(after), F.last(mine).over(whole))
        tails[f"_t{i}"] = F.when(last["n"] > mine["n"], last["v"] - mine["v"])
    step = step.withColumns(tails).where("_several")
    named = [F.col("_range").alias("_o_range"), *(F.col(k).alias(f"_o_k{i}") for i, k in enumerate(keys)), F.col("_continues").alias("_o_continues")]
    return step.select(*named, F.col("_to").alias("_o_to"), *(c for c in step.columns if c in ("_o_n", "_o_dense", "_o_rank") or c[:2] in ("_o", "_t") and c[2:].isdigit()))


def percent_rank(rank: Column, size: Column) -> Column:
    """SQL's PERCENT_RANK from `rank` and `size`."""
    return F.when(size > 1, (rank - 1) / (size - 1)).otherwise(F.lit(0.0))


def ntile(row_number: Column, size: Column, n: int) -> Column:
    """SQL's NTILE from `row_number` and `size`: the first tiles have one row more."""
    small, more = F.floor(size / n), size % n
    wide = more * (small + 1)
    at = row_number - 1
    return F.when(at < wide, F.floor(at / (small + 1))).otherwise(more + F.floor((at - wide) / small)) + 1


def moving_sum(table: DataFrame, name: str, value: str, at: str, within: Column, keys: Sequence[str] = ()) -> DataFrame:
    """All rows with the sum of `value` over the rows of the key from `within` before to their own time, as SQL's RANGE frame has it.

    It is the running total less the total at the last time before the frame, found by an as-of join: the work does
    not depend on how many rows a frame holds. NULL values add nothing; rows without a time have a NULL sum.
    """
    values = {"_total": Running("total", F.coalesce(value, F.lit(0))), "_some": Running("total", F.col(value).isNotNull().cast("long"))}
    names = [f"_g{i}" for i in range(len(keys))]  # a NULL key is a key here, which joins do not match
    totals = durable(with_running(table, values, [at], keys).withColumns({n: F.to_json(F.struct(k)) for n, k in zip(names, keys)}))
    ends = totals.select(*names, F.col(at).alias("_at"), F.struct("_total", "_some").alias("_t"))
    found = asof_join(totals.withColumn("_start", F.col(at) - within), ends, ("_start", "_at"), {"_before": "_t"}, [(n, n) for n in names], exact=False)
    before = {c: F.coalesce(F.col("_before")[c], F.lit(0)) for c in ("_total", "_some")}
    moved = F.when(F.col(at).isNotNull() & (F.col("_some") > before["_some"]), F.col("_total") - before["_total"])
    return found.select(*(c for c in table.columns if c != name), moved.cast(totals.schema["_total"].dataType).alias(name))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    at: tuple[str, str],
    take: Mapping[str, str],
    keys: Sequence[tuple[str, str]] = (),
    exact: bool = True,
    within: Column | None = None,
    matched: str | None = None,
) -> DataFrame:
    """Every left row with columns of the latest right row at or before it: the rate in force at each payment.

    `at` names the time on either side, `keys` pairs of columns that must be equal, `take` the right columns by
    their new name. With `exact=False` a right row of the same instant is too late. `within` is an interval: older
    right rows count as missing; `matched` names a column for the time of the right row. Where several right rows of a key have
    the latest time, the one with the largest taken values counts, from the first on, NULL above others.

    Left rows without a predecessor, time or key stay, with NULLs; right rows without time or key match nothing.
    Both sides go in one order through the prefix scan, so neither a hot key nor a long gap between matches gathers in a task.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    left_on, right_on = [k for k, _ in keys], [k for _, k in keys]
    own = F.struct(*(F.col(c) for c in left.columns))
    given = F.struct(F.col(at[1]).alias("_at"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(take.values())))
    usable = right.dropna(subset=[at[1], *right_on])
    later = usable.select(*(F.col(c).alias(n) for n, c in zip(names, right_on)), F.col(at[1]).alias("_time"), F.lit(0 if exact else 1).alias("_side"), F.lit(None).alias("_left"), given.alias("_right"))
    asked = left.select(*(F.col(c).alias(n) for n, c in zip(names, left_on)), F.col(at[0]).alias("_time"), F.lit(1 if exact else 0).alias("_side"), own.alias("_left"), F.lit(None).alias("_right"))
    order = [f"_right._c{i}" for i in range(len(take))]
    both = later.union(asked).withColumns({f"_s{i}": F.col(c) for i, c in enumerate(order)})
    carried = with_running(both, {"_found": Running("last", "_right")}, ["_time", "_side"], names, ties=[f"_s{i}" for i in range(len(take))])
    found = carried.where(F.col("_left").isNotNull())
    known = F.col("_time").isNotNull() & reduce(Column.__and__, (F.col(n).isNotNull() for n in names), F.lit(True))
    if within is not None:
        known &= F.col("_found._at") >= F.col("_time") - within
    taken = [F.when(known, F.col(f"_found._c{i}")).alias(name) for i, name in enumerate(take)]
    if matched is not None:
        taken.append(F.when(known, F.col("_found._at")).alias(matched))
    return found.select("_left.*", *taken)
