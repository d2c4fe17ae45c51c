"""Surrogate keys for new rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentledger.functions.ordering import asc
from rentledger.sources.shared import durable

# monotonically_increasing_id keeps the partition number above the lower 33 bits
# and the position inside the partition in them.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1
PLACE = "_place"


def _local_table(starts: list[tuple[int, int]]) -> pa.Table:
    """As an Arrow table, which becomes a local relation of known size."""
    shards, first_ids = zip(*starts) if starts else ((), ())
    return pa.table({"_shard": pa.array(shards, pa.int64()), "_first": pa.array(first_ids, pa.int64())})


def assign_ids(
    source: DataFrame,
    table: DataFrame,
    id_column: str,
    order: Sequence[str | Column] = (),
    unique_order: bool = False,
) -> DataFrame:
    """Number the rows without gaps, upwards from the largest id of the table.

    The rows are written to reliable storage once with their place (partition
    and position), because ids must not change when they are read again or an
    executor is lost. No shuffle is needed for that, and no window over all rows.

    With `order` the ids follow that order: the rows are range-partitioned and
    sorted before they are placed. The last sort key is the row's position, so
    that a long run of equal keys, even of exact copies, is cut into several
    partitions. Positions are only repeatable over stored rows, so these are
    stored before the sort as well. `unique_order=True` says that no two rows
    have the same sort keys, which makes both unnecessary.

    The driver sees one row count per partition and the largest id; the counts
    go back out as a broadcast of one row per partition.
    """
    rows = source
    if order:
        keys = [asc(k) if isinstance(k, str) else k for k in order]
        if not unique_order:
            rows = durable(source).withColumn("_tie", F.monotonically_increasing_id())
            keys.append(F.col("_tie"))
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    return numbered(placed(rows), table, id_column)


def placed(rows: DataFrame) -> DataFrame:
    """The rows, stored with their place for `numbered`."""
    return durable(rows.withColumn(PLACE, F.monotonically_increasing_id()))


def numbered(stored: DataFrame, table: DataFrame, id_column: str) -> DataFrame:
    """Rows that `placed` has stored, all of them, numbered upwards from the largest id of the table."""
    sharded = stored.withColumn("_shard", F.shiftright(PLACE, _POSITION_BITS))
    position = F.col(PLACE).bitwiseAND(F.lit(_POSITION_MASK))
    sizes = sharded.groupBy("_shard").agg(F.count(F.lit(1)).alias("size")).orderBy("_shard").collect()
    next_id = (table.agg(F.max(id_column)).first()[0] or 0) + 1
    starts = []
    for shard, size in sizes:
        starts.append((shard, next_id))
        next_id += size
    first_ids = stored.sparkSession.createDataFrame(_local_table(starts))
    with_ids = sharded.join(F.broadcast(first_ids), "_shard").withColumn(id_column, F.col("_first") + position)
    return with_ids.select(id_column, *(c for c in stored.columns if c not in (id_column, PLACE)))
