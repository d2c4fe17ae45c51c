"""MERGE with its change log: insert, update and delete in one statement, and logs that can be applied and composed.

A log has a row for each changed row of the table: the operation (I, U or D), the key,
and the row before and after as structs, one of them NULL for I and D.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentledger.operators.joins import semi_join
from rentledger.sources.shared import durable, stored_once
from rentledger.sources.tables import append


class MergeConflict(ValueError):
    """Several source rows match one row of the table."""


@dataclass(frozen=True)
class MergeResult:
    table: DataFrame
    log: DataFrame


def _same(keys: Sequence[str], a: str, b: str) -> Column:
    return reduce(Column.__and__, (F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys))


def merge(
    table: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    update: Mapping[str, str | Column] | None = None,
    update_if: Column | None = None,
    delete_if: Column | None = None,
    insert: bool = True,
    insert_if: Column | None = None,
    delete_unmatched: bool = False,
    defaults: Mapping[str, object] | None = None,
) -> MergeResult:
    """The table after the source has been merged into it by the key `on`, and the log of what changed.

    In conditions and new values `t.column` is the table's row and `s.column` the source's. A matched row is deleted
    if `delete_if` holds; else, where `update_if` holds (or is not given), the columns in `update` get their new
    values, and the row is in the log if that changes any. A source row without a match is inserted if
    `insert_if` holds, with `defaults` for columns it lacks. `delete_unmatched` deletes rows that no source row matches. A condition
    that is NULL does not hold; a NULL key matches nothing.

    Several source rows that match one row of the table raise `MergeConflict`; without a match each is inserted. A
    table's key may repeat: each of its rows is matched on its own.

    The table's rows, joined with the source and routed, are stored once, the log with them; neither is worked out
    twice. A small source is broadcast by Spark's size check and the table then stays where it is; else
    a hot key of the table can be split, as the table is the outer side.
    """
    source = stored_once(source)
    usable = source.dropna(subset=list(on))
    again = durable(usable.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*on))
    if repeats := not again.isEmpty():  # only keys that repeat are looked for in the table
        met = semi_join(table.select(*on), again, list(on), unique="right").count()
        if met and (update or delete_if is not None):
            raise MergeConflict(f"{met} rows of the table have several matches")
    row = F.struct(*(F.col(f"t.{c}") for c in table.columns)).alias("_before")
    matched = F.col(f"s.{on[0]}").isNotNull()
    truth = lambda c: F.lit(False) if c is None else F.coalesce(c, F.lit(False))
    gone = (matched & truth(delete_if)) | (~matched & F.lit(delete_unmatched))
    changes = {c: F.col(v) if isinstance(v, str) else v for c, v in (update or {}).items()}
    kinds = {f.name: f.dataType for f in table.schema.fields}
    wanted = matched & ~gone & (F.lit(True) if update_if is None else truth(update_if))
    after = F.struct(*(F.when(wanted, changes[c].cast(kinds[c])).otherwise(F.col(f"t.{c}")).alias(c) if c in changes else F.col(f"t.{c}").alias(c) for c in table.columns))
    once = usable.dropDuplicates(list(on)) if repeats else usable  # none of these changes a row of the table
    joined = table.alias("t").join(once.alias("s"), _same(on, "t", "s"), "left")
    routed = joined.select(row, after.alias("_after"), gone.alias("_gone"), matched.alias("_matched"))
    changed = ~F.col("_before").eqNullSafe(F.col("_after"))
    operation = F.when(F.col("_gone"), "D").when(changed, "U")
    kept = routed.select(operation.alias("op"), F.when(operation.isNotNull(), F.col("_before")).alias("before"), F.when(~F.col("_gone"), F.col("_after")).alias("after"))
    if insert:
        present = semi_join(table.select(*on).dropna(), usable, list(on))
        fresh = source.join(present, list(on), "left_anti").select(*source.columns)
        chosen = fresh.alias("s").where(truth(insert_if)).select(*(F.col(f"s.{c}") for c in source.columns)) if insert_if is not None else fresh
        shaped = append(table.limit(0), chosen, defaults).select(F.lit("I").alias("op"), F.lit(None).cast(kept.schema["before"].dataType).alias("before"), F.struct(*table.columns).alias("after"))
        kept = kept.union(shaped)
    done = durable(kept)
    log = done.where("op IS NOT NULL").select("op", *(F.coalesce(f"before.{k}", f"after.{k}").alias(k) for k in on), "before", "after")
    return MergeResult(done.where("after IS NOT NULL").select("after.*"), log)


def apply_log(table: DataFrame, log: DataFrame, on: Sequence[str]) -> DataFrame:
    """The table after the changes of a log; its key, not NULL, tells rows apart."""
    touched = log.where("op != 'I'").select(*on)
    left = table.join(touched, list(on), "left_anti").select(*table.columns)
    return left.unionByName(log.where("op != 'D'").select("after.*"))


def undo_log(log: DataFrame) -> DataFrame:
    """The log that takes the changes of another one back."""
    back = F.when(F.col("op") == "I", "D").when(F.col("op") == "D", "I").otherwise("U")
    rest = [c for c in log.columns if c not in ("op", "before", "after")]
    return log.select(back.alias("op"), *rest, F.col("after").alias("before"), F.col("before").alias("after"))


def compose_logs(first: DataFrame, second: DataFrame, on: Sequence[str]) -> DataFrame:
    """One log for two in a row: a row that comes and goes, or ends as it began, is in it no more.

    Keys are not NULL and stand in each log once.
    """
    both = first.alias("a").join(second.alias("b"), _same(on, "a", "b"), "full_outer")
    before = F.when(F.col("a.op").isNotNull(), F.col("a.before")).otherwise(F.col("b.before"))
    after = F.when(F.col("b.op").isNotNull(), F.col("b.after")).otherwise(F.col("a.after"))
    keys = [F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in on]
    operation = F.when(F.col("before").isNull(), "I").when(F.col("after").isNull(), "D").otherwise("U")
    merged = both.select(*keys, before.alias("before"), after.alias("after")).where(~F.col("before").eqNullSafe(F.col("after")))
    return merged.select(operation.alias("op"), *on, "before", "after")
