"""Sorting and top-k. Limits always follow a total order, so results are repeatable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from rentledger.functions.ordering import asc


def order(table: DataFrame, keys: Sequence[Column], tie: Sequence[str] = ()) -> DataFrame:
    """Global sort. With a unique `tie` the range partitions can cut through a run of equal keys."""
    return table.orderBy(*keys, *(asc(c) for c in tie))


def top_k(table: DataFrame, keys: Sequence[Column], k: int, tie: Sequence[str]) -> DataFrame:
    """First k rows; every task keeps k rows and only those are merged."""
    return order(table, keys, tie).limit(k)


def first_by(table: DataFrame, key: str, k: int = 1) -> DataFrame:
    """The k rows with the smallest key."""
    return table.orderBy(asc(key)).limit(k)
