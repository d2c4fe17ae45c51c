"""Grouped aggregates the reports are made of. All combine on the map side first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentledger.operators.joins import semi_join


def zero_sum(column: Column) -> Column:
    """Sum that is 0 and not NULL where there is nothing to add."""
    return F.coalesce(F.sum(column), F.lit(0))


def latest(columns: Sequence[str], order: Sequence[str]) -> Column:
    """Aggregate: struct of `columns` from the row with the greatest `order`.

    Rows with a NULL order key do not take part. As it is an aggregate, it can
    stand beside sums in one `groupBy` and needs no window over a whole group.
    """
    usable = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in order))
    rest = [c for c in columns if c not in order]  # rows that tie in `order` are told apart by what is picked
    return F.max_by(F.struct(*columns), F.when(usable, F.struct(*order, *rest)))


def latest_per_key(table: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest first order key, ties by the next."""
    picked = table.groupBy(*key).agg(latest(columns, order).alias("_row"))
    return picked.where(F.col("_row").isNotNull()).select(*key, "_row.*")


def count_by_value(table: DataFrame, by: Sequence[str], column: str, values: Mapping[str, object]) -> DataFrame:
    """One count column per listed value; groups with none of them stay, with zeros."""
    return table.groupBy(*by).agg(
        *(F.sum(F.when(F.col(column) == F.lit(v), 1).otherwise(0)).alias(name) for name, v in values.items())
    )


def distinct_count(table: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """Exact distinct count per group.

    Spark shuffles by group and value first and by group only after that, so a
    group with a third of all rows is spread over many tasks.
    """
    return table.groupBy(*by).agg(F.count_distinct(column).alias(name))


def eligible(entity: DataFrame, key: str, facts: Sequence[tuple[DataFrame, str, int]]) -> DataFrame:
    """Entities with at least `n` rows in each fact, given as `(fact, fact_key, n)`.

    Each fact is counted on its own, so that the facts do not multiply one another.
    """
    for fact, fact_key, least in facts:
        counts = fact.groupBy(fact_key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
        entity = semi_join(entity, counts, [key], [fact_key], unique="right")
    return entity


def count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and row count."""
    parts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
