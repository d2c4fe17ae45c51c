"""Text functions and text predicates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def eq_ci(a: Column, b: Column) -> Column:
    """Equality without regard to case; NULL on either side gives NULL."""
    return F.upper(a) == F.upper(b)


def eq_ci_null_as_empty(a: Column, b: Column) -> Column:
    """Like `eq_ci`, with a NULL left side read as the empty text."""
    return eq_ci(F.coalesce(a, F.lit("")), b)


def join_text(separator: str, *columns: Column | str) -> Column:
    """Join texts, leaving NULL parts out but keeping empty ones."""
    return F.concat_ws(separator, *columns)


def number_after(column: Column, prefix: str) -> Column:
    """The whole number (a long) that is left once `prefix` is taken out; bad text is an error."""
    return F.replace(column, F.lit(prefix), F.lit("")).cast("long")


def starred(prefix: str, column: Column) -> Column:
    """`prefix` followed by the value; NULL if the value is NULL."""
    return F.concat(F.lit(prefix), column.cast("string"))


def label(column: Column, labels: Mapping[str, str], other: str) -> Column:
    """Name for each listed value, `other` for unlisted values and for NULL."""
    if not labels:
        return F.lit(other)
    named = None
    for value, text in labels.items():
        hit = column == F.lit(value)
        named = F.when(hit, text) if named is None else named.when(hit, text)
    return named.otherwise(other)


def _plain(name: Column) -> Column:
    return F.regexp_replace(F.upper(name), "[^A-Z0-9]+", "_")


def principal_name(first: Column, last: Column, raw: bool = False) -> Column:
    """Name of the principal that stands for one person.

    Both names are upper-cased and every run of other characters becomes one
    underscore. `raw=True` joins the names as they are stored.
    """
    shape = (lambda c: c) if raw else _plain
    return F.concat(F.lit("client_"), shape(first), F.lit("_"), shape(last))


# Unit names in steps of 1024, and the value from which the next unit is used.
SIZE_UNITS = ("bytes", "kB", "MB", "GB", "TB", "PB")
SIZE_LIMIT = 10240


def size_pretty(size: Column) -> Column:
    """Readable byte size: first unit whose half-up rounded value is below 10240."""
    magnitude = F.abs(size.cast("long"))
    text = None
    for step, unit in enumerate(SIZE_UNITS):
        half = 0 if step == 0 else 1 << (10 * step - 1)
        value = F.shiftright(magnitude + F.lit(half).cast("long"), 10 * step)
        shown = F.concat(F.when(size < 0, "-").otherwise(""), value.cast("string"), F.lit(f" {unit}"))
        if step == len(SIZE_UNITS) - 1:
            return text.otherwise(shown)
        below = value < SIZE_LIMIT
        # A NULL size fails every test and ends in the last branch, which is NULL too.
        text = F.when(below, shown) if text is None else text.when(below, shown)
