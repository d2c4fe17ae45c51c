"""Table-change operators.

Each takes the current tables and returns the new table together with the
affected rows. Nothing is changed in place: the caller stores the new table.
Which state a step reads is the caller's choice, made by what is passed in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentledger.operators.audits import enforce, repeated_keys, unique_conflicts
from rentledger.operators.ids import PLACE, assign_ids, numbered, placed
from rentledger.operators.joins import (
    Key,
    Unique,
    anti_join,
    key_names,
    key_rows,
    keyed,
    one_per_key,
    semi_join,
)
from rentledger.sources.shared import durable, stored_once
from rentledger.sources.tables import append


@dataclass(frozen=True)
class ChangeResult:
    """The new table and the affected rows. `beside` has the affected rows with the columns that a source had beyond the table's, where an insert was asked to keep some."""

    table: DataFrame
    affected: DataFrame
    beside: DataFrame | None = None


def _read_once(id_column: str | None, id_order: Sequence[str | Column]) -> bool:
    """The rows are stored in one go when they are numbered in the order they have; all that follows reads those."""
    return id_column is not None and not id_order


def _inserted(
    table: DataFrame,
    source: DataFrame,
    id_column: str | None,
    id_order: Sequence[str | Column],
    defaults: Mapping[str, object] | None,
    unique_order: bool = False,
    beside: Sequence[str] = (),
) -> ChangeResult:
    """Rows that `placed` has stored are numbered as they are."""
    if PLACE in source.columns:
        source = numbered(source, table, id_column)
    elif id_column is not None:
        source = assign_ids(source, table, id_column, id_order, unique_order)
    affected = append(table.limit(0), source.drop(*beside), defaults)
    return ChangeResult(table.unionByName(affected), affected, source if beside else None)


def new_rows(
    source: DataFrame,
    table: DataFrame,
    on: Sequence[Key],
    table_on: Sequence[Key] | None = None,
    unique_source: bool = False,
    whole: bool = False,
    unique_table: bool = False,
) -> DataFrame:
    """Source rows whose key is not in the table; rows with a NULL key always count as new.

    The table is first cut down to the keys that the source has. A small
    source is broadcast for that, so that a large table is scanned in its key
    columns only and never shuffled. The source is read twice; one that is more than a
    scan or literal rows is stored first, by `stored_once`.

    `whole` says that the source may be as large as the table, so that cutting first is no gain: it is compared with all
    keys of the table in one join and read once. `unique_table` says that no key repeats there.
    """
    if whole:
        return anti_join(source, table, on, table_on, unique="right" if unique_table else None)
    table_keys = key_rows(table, table_on or on, prefix="_t")
    names = table_keys.columns
    present = semi_join(table_keys, source, names, on, unique="right" if unique_source else None)
    return anti_join(source, present, on, names, unique="left" if unique_source else None)


def insert_rows(
    table: DataFrame,
    source: DataFrame,
    id_column: str | None = None,
    id_order: Sequence[str | Column] = (),
    defaults: Mapping[str, object] | None = None,
) -> ChangeResult:
    """Plain insert."""
    return _inserted(table, source, id_column, id_order, defaults)


def insert_if_absent(
    table: DataFrame,
    source: DataFrame,
    on: Sequence[Key],
    table_on: Sequence[Key] | None = None,
    distinct: bool = False,
    id_column: str | None = None,
    id_order: Sequence[str | Column] = (),
    defaults: Mapping[str, object] | None = None,
    unique_order: bool = False,
    whole: bool = False,
    beside: Sequence[str] = (),
) -> ChangeResult:
    """Insert source rows that have no match in the table.

    Rows that match one another inside the source are all inserted;
    `distinct=True` drops exact copies first. For the id arguments see `assign_ids`, for `whole` see `new_rows`,
    for `beside` `ChangeResult`.
    """
    if distinct:
        source = source.distinct()
    empty = table.isEmpty()
    if not ((empty or whole) and _read_once(id_column, id_order)):
        source = stored_once(source)
    if not empty:
        source = new_rows(source, table, on, table_on, whole=whole)
    return _inserted(table, source, id_column, id_order, defaults, unique_order, beside)


def insert_skip_conflicts(
    table: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    id_column: str | None = None,
    id_order: Sequence[str | Column] = (),
    defaults: Mapping[str, object] | None = None,
    other_keys: Sequence[Sequence[str]] = (),
    nullable_key: bool = True,
    whole: bool = False,
    beside: Sequence[str] = (),
) -> ChangeResult:
    """Insert source rows whose unique key is neither in the table nor earlier in the source.

    "Earlier" means first in `order`. A key with a NULL part never conflicts;
    `nullable_key=False` says that there is none and saves reading the source
    for it. Only this key is forgiven: a repeat in one of `other_keys` is an error.
    Rows for an empty table that are numbered are read once, those with a NULL in the key as groups of their own.

    `whole` says that the source may be as large as the table, see `new_rows`, and that few keys repeat in it: what is new is
    stored and counted per key, and only rows whose key repeats are compared with one another. For `beside` see `ChangeResult`.
    """
    empty = table.isEmpty()
    if whole:
        fresh = source if empty else new_rows(source, table, list(key), whole=True, unique_table=True)
        fresh = _first_of_stored(placed(fresh) if _read_once(id_column, id_order) else stored_once(fresh), key, order)
        return _checked(_inserted(table, fresh, id_column, id_order, defaults, beside=beside), table, other_keys)
    once = empty and _read_once(id_column, id_order)
    if not once:
        source = stored_once(source)
    complete = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in key))
    apart = [F.when(~complete, F.monotonically_increasing_id()).alias("_lone")] if nullable_key and once else []  # NULL keys group with nothing
    firsts = _firsts(source.where(complete) if nullable_key and not once else source, key, order, apart)
    fresh = firsts if empty else new_rows(firsts, table, list(key), unique_source=True)
    if nullable_key and not once:
        fresh = fresh.unionByName(source.where(~complete))
    return _checked(_inserted(table, fresh, id_column, id_order, defaults, beside=beside), table, other_keys)


def _firsts(source: DataFrame, key: Sequence[str], order: Sequence[str], apart: Sequence[Column] = ()) -> DataFrame:
    """The first row of every key."""
    rest = [c for c in source.columns if c not in key]
    earliest = F.struct(*order, *(c for c in rest if c not in order))  # rows that tie in `order` are told apart by the rest
    first = F.min_by(F.struct(*rest), earliest) if rest else F.lit(1)
    rows = source.groupBy(*key, *apart).agg(first.alias("_row")).select(*key, *(F.col("_row")[c].alias(c) for c in rest))
    return rows.select(*source.columns)


def _first_of_stored(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As `_firsts`, all rows with a NULL in the key too. Rows that can be read again stay as they are where no key repeats."""
    names = key_names(key)
    again = repeated_keys(rows, key).select(*names)
    if again.isEmpty():
        return rows
    rows = rows.drop(PLACE)  # what is left is numbered anew
    several = semi_join(rows, again, key, names, unique="right")
    return anti_join(rows, again, key, names, unique="right").unionByName(_firsts(several, key, order))


def _checked(result: ChangeResult, table: DataFrame, other_keys: Sequence[Sequence[str]]) -> ChangeResult:
    for other in other_keys:
        enforce(unique_conflicts(table, result.affected, list(other)))
    return result


def insert_chain(
    parent: ChangeResult,
    child: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    on: Sequence[Key],
    id_column: str | None = None,
    id_order: Sequence[str | Column] = (),
    unique_order: bool = False,
) -> ChangeResult:
    """Insert child rows built from the rows that were just inserted in the parent."""
    return insert_if_absent(
        child, build(parent.affected), on, id_column=id_column, id_order=id_order, unique_order=unique_order
    )


def update_from(
    table: DataFrame,
    source: DataFrame,
    on: Sequence[Key],
    values: Mapping[str, Column | str],
    source_on: Sequence[Key] | None = None,
    source_order: Sequence[str] = (),
    unique: Unique = None,
) -> ChangeResult:
    """Set columns from the source row with the same key.

    Should a key repeat in the source, the first row in `source_order` (or the
    smallest set of values) is used, so that a table row is never multiplied.
    """
    keyed_source = keyed(source, source_on or on)
    names = key_names(on)
    new = F.struct(*((F.col(v) if isinstance(v, str) else v).alias(c) for c, v in values.items()))
    pick = F.min_by(new, F.struct(*source_order, new)) if source_order else F.min(new)
    one = one_per_key(keyed_source.dropna(subset=names), names, [pick.alias("_new")], unique)
    joined = keyed(table, on).join(one, names, "left")
    hit = F.col("_new").isNotNull()
    return _set(joined, table, hit, {c: F.col("_new")[c] for c in values})


def update_where(table: DataFrame, condition: Column, values: Mapping[str, Column]) -> ChangeResult:
    """Set columns in the rows that meet the condition; an unknown condition changes nothing."""
    return _set(table, table, condition, values)


def _set(joined: DataFrame, table: DataFrame, hit: Column, values: Mapping[str, Column]) -> ChangeResult:
    """`hit` is worked out once per row for all columns, and stays a plain filter for the affected rows."""
    types = {f.name: f.dataType for f in table.schema.fields}
    cast = {c: v.cast(types[c]) for c, v in values.items()}
    changed = joined.withColumn("_hit", hit).select(
        *(F.when(F.col("_hit"), cast[c]).otherwise(F.col(c)).alias(c) if c in cast else F.col(c) for c in table.columns)
    )
    affected = joined.where(hit).select(*(cast[c].alias(c) if c in cast else F.col(c) for c in table.columns))
    return ChangeResult(changed, affected)


def backfill(table: DataFrame, column: str, value: Column | object) -> ChangeResult:
    """Replace NULL in one column."""
    fill = value if isinstance(value, Column) else F.lit(value)
    return update_where(table, F.col(column).isNull(), {column: fill})


def add_column(table: DataFrame, column: str, data_type: str) -> DataFrame:
    """Add an empty column; a table that has it already is left alone."""
    if column in table.columns:
        return table
    return table.withColumn(column, F.lit(None).cast(data_type))


def evolve(table: DataFrame, column: str, data_type: str, value: Column | object) -> ChangeResult:
    """Add a column where missing and fill its NULLs, after which it holds no NULL."""
    return backfill(add_column(table, column, data_type), column, value)


def delete_where(table: DataFrame, condition: Column) -> ChangeResult:
    """Drop the rows that meet the condition; an unknown condition keeps the row."""
    return ChangeResult(table.where(~F.coalesce(condition, F.lit(False))), table.where(condition))


def delete_using(
    table: DataFrame,
    keys: DataFrame,
    on: Sequence[Key],
    keys_on: Sequence[Key] | None = None,
    unique: Unique = None,
) -> ChangeResult:
    """Drop the rows whose key occurs in another relation."""
    return ChangeResult(
        anti_join(table, keys, on, keys_on, unique),
        semi_join(table, keys, on, keys_on, unique),
    )


def pick_target(table: DataFrame, id_column: str, match: Column, fallback: DataFrame) -> DataFrame:
    """One-row relation: smallest id that matches, else the smallest id of `fallback`, else NULL."""
    other = fallback.agg(F.min(id_column)).scalar()
    return table.where(match).agg(F.min(id_column).alias("_id")).select(F.coalesce("_id", other).alias(id_column))
