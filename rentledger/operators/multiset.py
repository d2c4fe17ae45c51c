"""Difference and intersection of tables whose rows may repeat, from one aggregate of signed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counted(first: DataFrame, second: DataFrame) -> DataFrame:
    """Every different row with how often each side has it.

    Copies are combined before anything is moved, and both sides go through one exchange: a row that a third of a
    table consists of is one row per task. NULLs are equal to each other; columns go by name.
    """
    if sorted(first.columns) != sorted(second.columns):
        raise ValueError(f"columns differ: {sorted(set(first.columns) ^ set(second.columns))}")
    sides = first.select("*", F.lit(1).alias("_one"), F.lit(0).alias("_two")).unionByName(second.select("*", F.lit(0).alias("_one"), F.lit(1).alias("_two")))
    return sides.groupBy(*first.columns).agg(F.sum("_one").alias("_one"), F.sum("_two").alias("_two"))


def table_difference(first: DataFrame, second: DataFrame, surplus: str = "surplus") -> DataFrame:
    """Rows that one side has more often, once each: `surplus` above 0 says how often more in `first`, below 0 in `second`."""
    return _counted(first, second).withColumn(surplus, F.col("_one") - F.col("_two")).where(F.col(surplus) != 0).drop("_one", "_two")


def _repeated(counted: DataFrame, times, columns: list[str]) -> DataFrame:
    return counted.withColumn("_times", times).where("_times > 0").select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "_times")).alias("_copy")).drop("_copy")


def except_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of `first`, each as often as it occurs there more than in `second`."""
    return _repeated(_counted(first, second), F.col("_one") - F.col("_two"), first.columns)


def intersect_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both, each as often as in the one that has it less often."""
    return _repeated(_counted(first, second), F.least("_one", "_two"), first.columns)


def same_rows(first: DataFrame, second: DataFrame) -> bool:
    return table_difference(first, second).isEmpty()
