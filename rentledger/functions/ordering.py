"""Sort keys with NULL counted as the largest value, as the reports expect.

Spark puts NULL first when ascending and last when descending, which is the
other way round, so every sort key of the library is made here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def asc(column: str) -> Column:
    return F.col(column).asc_nulls_last()


def desc(column: str) -> Column:
    return F.col(column).desc_nulls_first()
