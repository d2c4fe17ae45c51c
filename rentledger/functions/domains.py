"""Casts to restricted types: a value outside the type is an error when it is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Film ratings.
RATINGS = ("G", "PG", "PG-13", "R", "NC-17")


def _checked(column: Column, valid: Column, what: str) -> Column:
    bad = F.raise_error(F.concat(F.lit(f"{what}: "), column.cast("string")))
    return F.when(column.isNull() | valid, column).otherwise(bad)


def member_of(column: Column, values: Sequence[str]) -> Column:
    """Text that is one of the listed values, or NULL."""
    return _checked(column, column.isin(list(values)), "not a listed value")


def within(column: Column, lo: int, hi: int) -> Column:
    """Integer within a closed range, or NULL."""
    number = column.cast("int")
    return _checked(number, number.between(lo, hi), "out of range")
