"""Stored sketches: distinct counts and quantiles of any range of days without reading the fact again.

A day's rows become one row of sketches, which is stored. Sketches of the days of a range are merged; the
answer is approximate within the bounds below, whatever the range. `exact_range` reads the fact and is
what the bounds are tested against.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: HyperLogLog of 2**12 registers: 1.04 / sqrt(4096) = 1.6 % standard error; three of them.
REGISTERS = 12
DISTINCT_BOUND = 3 * 1.04 / 2 ** (REGISTERS / 2)
#: KLL of this size keeps ranks within 0.9 % with 99 % confidence; twice that for quantiles of merged sketches.
QUANTILE_SIZE = 400
RANK_BOUND = 0.018


def daily_sketches(fact: DataFrame, day: str | Column, distinct: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """`day`, the keys, `n_rows`, `total`, and the sketches `distincts` and `quantiles`: one row a day and key, to be stored.

    Rows are combined to sketches in their tasks; what is exchanged is a few kilobytes for each task, day and key.
    NULLs are left out of both sketches; a day without values has an empty or a NULL one.
    """
    moment = F.col(day) if isinstance(day, str) else day
    return fact.groupBy(moment.cast("date").alias("day"), *keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(value).alias("total"),
        F.hll_sketch_agg(distinct, REGISTERS).alias("distincts"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), QUANTILE_SIZE).alias("quantiles"),
    )


def sketched_range(sketches: DataFrame, ranges: DataFrame, quantile: float = 0.95, keys: Sequence[str] = ()) -> DataFrame:
    """For every range (`range_name`, `since`, `until`, both days included): rows, total, distinct count and quantile.

    `ranges` is a small stated set of questions. Every sketch is sent to the ranges that its day is in, merged on the way;
    no other row is read. A range without rows has zeros and NULLs.
    """
    days = ranges.select("range_name", F.explode(F.sequence("since", "until")).alias("day"))
    merged = (
        days.join(sketches, "day")
        .groupBy("range_name", *keys)
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("total").alias("total"),
            F.hll_sketch_estimate(F.hll_union_agg("distincts")).alias("n_distinct"),
            F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("quantiles"), F.lit(quantile)).alias("quantile"),
        )
    )
    filled = ranges.select("range_name").join(merged, "range_name", "left")
    return filled.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_rows", "n_distinct")})


def exact_range(fact: DataFrame, ranges: DataFrame, day: str, distinct: str, value: str, approximate: DataFrame) -> DataFrame:
    """The exact answers beside the approximate ones of `sketched_range`, and whether these are within their bounds.

    A quantile is judged by the share of rows that are not above it, and of those below it.
    """
    days = ranges.select("range_name", F.explode(F.sequence("since", "until")).alias("_day"))
    rows = fact.select(F.col(day).cast("date").alias("_day"), F.col(distinct).alias("_d"), F.col(value).cast("double").alias("_v"))
    met = days.join(rows, "_day").join(approximate.select("range_name", "quantile"), "range_name")
    return met.groupBy("range_name").agg(
        F.count(F.lit(1)).alias("exact_rows"),
        F.count_distinct("_d").alias("exact_distinct"),
        (F.count_if(F.col("_v") <= F.col("quantile")) / F.count("_v")).alias("share_up_to"),
        (F.count_if(F.col("_v") < F.col("quantile")) / F.count("_v")).alias("share_below"),
    )
