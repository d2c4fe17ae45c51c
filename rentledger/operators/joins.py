"""Existence joins, lookups and scalar comparisons.

Skew. A key may hold a large share of either side.

* The side that is only asked "does the key occur" or "what is its aggregate"
  is reduced per key first. The reduction combines on the map side, so a hot
  key on that side shrinks to one row per task before anything is shuffled.
* For the other side Spark's adaptive skew join splits an oversized partition,
  but only when both join inputs come straight from a shuffle. A side that was
  reduced by the join key is already partitioned by it and would be joined
  without another shuffle, which rules the split out. `unique=None` therefore
  reduces by the keys packed in one struct and joins by the unpacked keys: the
  reduced rows, one per key, are shuffled once more and the hot partitions of
  the other side can be split. Exact copies are split too, as the split follows
  map outputs and not values.
* `unique="left"` says that no left key repeats (an entity against a fact);
  the reduction's partitioning is then reused. `unique="right"` says that no
  right key repeats (a fact against an entity); no reduction is needed.

No side is broadcast by force: Spark does so when the statistics of the plan,
or the measured shuffle size at run time, are below its threshold.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Key = str | Column
Unique = Literal["left", "right"] | None


@contextmanager
def hash_joins(spark: SparkSession, most: str = "64m") -> Iterator[None]:
    """Adaptive joins inside the block hash the smaller side where none of its shuffled partitions is larger than `most`, and sort neither.

    This is the session's setting, put back at the end. Larger partitions, and sessions that aim at larger ones, keep merge joins.
    """
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _column(key: Key) -> Column:
    return F.col(key) if isinstance(key, str) else key


def key_names(keys: Sequence[Key], prefix: str = "_k") -> list[str]:
    return [f"{prefix}{i}" for i in range(len(keys))]


def keyed(df: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """The rows with their join keys, which may be expressions, as extra columns."""
    return df.select("*", *(_column(key).alias(name) for key, name in zip(keys, key_names(keys))))


def key_rows(df: DataFrame, keys: Sequence[Key], prefix: str = "_k") -> DataFrame:
    """Only the join keys, without rows that have a NULL part: those match nothing."""
    return df.select(*(_column(key).alias(name) for key, name in zip(keys, key_names(keys, prefix)))).dropna()


def one_per_key(df: DataFrame, names: Sequence[str], aggregates: Sequence[Column], unique: Unique) -> DataFrame:
    """Reduce to one row per key; see the module text for what `unique` decides."""
    if unique == "left":
        return df.groupBy(*names).agg(*aggregates) if aggregates else df.select(*names).distinct()
    packed = df.withColumn("_key", F.struct(*names)).drop(*names)
    reduced = packed.groupBy("_key").agg(*aggregates) if aggregates else packed.select("_key").distinct()
    return reduced.select("_key.*", *(c for c in reduced.columns if c != "_key"))


def _exists(
    left: DataFrame, right: DataFrame, on: Sequence[Key], right_on: Sequence[Key] | None, unique: Unique, how: str
) -> DataFrame:
    names = key_names(on)
    keys = key_rows(right, right_on or on)
    if unique != "right":
        keys = one_per_key(keys, names, [], unique)
    return keyed(left, on).join(keys, names, how).drop(*names)


def semi_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[Key],
    right_on: Sequence[Key] | None = None,
    unique: Unique = None,
) -> DataFrame:
    """IN / EXISTS: left rows whose key occurs on the right, each at most once."""
    return _exists(left, right, on, right_on, unique, "left_semi")


def anti_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[Key],
    right_on: Sequence[Key] | None = None,
    unique: Unique = None,
) -> DataFrame:
    """NOT EXISTS: left rows whose key does not occur on the right; a NULL key is kept."""
    return _exists(left, right, on, right_on, unique, "left_anti")


def exists_in_all(entity: DataFrame, key: str, facts: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Entities that occur in every one of the facts."""
    for fact, fact_key in facts:
        entity = semi_join(entity, fact, [key], [fact_key], unique="left")
    return entity


def left_join_filtered(left: DataFrame, right: DataFrame, on: Sequence[str], condition: Column) -> DataFrame:
    """Left join with a condition on the right rows only: left rows without a match stay."""
    return left.join(right.where(condition), list(on), "left")


def through(left: DataFrame, bridge: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"):
    """Many-to-many join: left, then the bridge by `left_key`, then right by `right_key`."""
    return left.join(bridge, left_key, how).join(right, right_key, how)


def with_agg(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[Key],
    aggregates: Mapping[str, Column],
    right_on: Sequence[Key] | None = None,
    zero: Sequence[str] = (),
    unique: Unique = None,
) -> DataFrame:
    """One aggregate per left row over the matching right rows.

    Sums and maxima are NULL where nothing matches; those named in `zero`
    (counts, zero-kept sums) become 0. The right side is aggregated before the join.
    """
    names = key_names(on)
    keyed_right = keyed(right, right_on or on).dropna(subset=names)
    reduced = one_per_key(keyed_right, names, [c.alias(n) for n, c in aggregates.items()], unique)
    joined = keyed(left, on).join(reduced, names, "left").drop(*names)
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in zero}) if zero else joined


def with_one_row(table: DataFrame, one: DataFrame) -> DataFrame:
    """Every table row with the columns of a relation of at most one row.

    The relation is read as a scalar subquery: no rows there means no rows
    here, more than one is an error at run time.
    """
    packed = one.select(F.struct(*one.columns).alias("_one"))
    joined = table.withColumn("_one", packed.scalar()).where(F.col("_one").isNotNull())
    return joined.select(*table.columns, *(F.col("_one")[name].alias(name) for name in one.columns))


def eq_scalar(table: DataFrame, column: str, one: DataFrame) -> DataFrame:
    """Rows equal to a one-value relation; a missing or NULL value matches nothing.

    The value is known before the scan starts, so it prunes Parquet row groups.
    """
    return table.where(F.col(column) == one.scalar())


def ne_scalar(table: DataFrame, column: str, one: DataFrame) -> DataFrame:
    """Rows that differ from a one-value relation; a missing or NULL value matches nothing."""
    return table.where(F.col(column) != one.scalar())


def resolve_keys(
    source: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: Literal["inner", "left"] = "inner",
    ci: bool = False,
) -> DataFrame:
    """Replace natural keys by surrogate keys.

    `on` maps source columns to dimension columns, `take` maps new columns to
    dimension columns. Inner drops source rows with an unknown key, left gives
    them NULL. A dimension key that repeats multiplies rows: audit it with
    `audit_unique` first. `ci=True` matches without regard to case.
    """
    names = key_names(list(on)) if ci else list(on)  # the source's own columns are the keys where they can be: they move once
    shape = F.upper if ci else (lambda c: c)
    looked_up = dimension.select(
        *(shape(F.col(d)).alias(n) for d, n in zip(on.values(), names)),
        *(F.col(d).alias(new) for new, d in take.items()),
    )
    for name in names:  # plain conditions: Spark knows that a source with the same ones needs no others
        looked_up = looked_up.where(F.col(name).isNotNull())
    rows = keyed(source, [shape(F.col(s)) for s in on]) if ci else source
    return rows.join(looked_up, names, how).select(*source.columns, *take)
