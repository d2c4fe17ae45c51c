"""Loads over a stream: the inserts and totals of the batch operators, a micro-batch at a time.

What a micro-batch adds is written to a folder named by its number. A batch that is run again after a failure
overwrites its own folder and looks only at the folders before it, so it adds the same rows; the
checkpoint makes sure that none is left out. A reader takes whole folders.

An insert loses nothing for being late: a row that arrives after its key was loaded goes through the same rule as the
others. For totals the watermark says which days are complete, and bounds the state in which rows that are
delivered again are recognised.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rentledger.operators.joins import one_per_key, semi_join
from rentledger.sources.shared import durable

BATCH = "load_batch"


def file_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Rows of Parquet files as they appear in a folder; old files are read first."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def _folders(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """The batches that are stored, by number. Only names are listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [s.getPath() for s in files.listStatus(path) if s.isDirectory()]
    done = [p for p in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted((int(p.getName().split("=")[1]), p.toString()) for p in done if p.getName().startswith(f"{BATCH}="))


def stored_batches(spark: SparkSession, folder: str, schema: StructType, before: int | None = None) -> DataFrame:
    """Rows of all whole batches with the number of their batch, or of those `before` one."""
    own = [p for n, p in _folders(spark, folder) if before is None or n < before]
    if not own:
        return spark.createDataFrame([], schema).limit(0).withColumn(BATCH, F.lit(0).cast("long"))
    number = F.regexp_extract(F.col("_metadata.file_path"), f"{BATCH}=(-?\\d+)/", 1).cast("long")
    return spark.read.schema(schema).parquet(*own).select("*", number.alias(BATCH))


def _start(stream: DataFrame, folder: str, checkpoint: str, write: Callable[[DataFrame, int], None], once: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _first_of_key(rows: DataFrame, on: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key by `order`, NULL last, then by all other columns."""
    rest = [c for c in rows.columns if c not in (*on, *order)]
    ranked = F.struct(*(x for c in (*order, *rest) for x in (F.col(c).isNull(), F.col(c))))
    least = F.min(F.struct(ranked.alias("r"), F.struct(*rows.columns).alias("row"))).alias("_least")
    keyed = rows.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(on)), *rows.columns)
    return one_per_key(keyed, [f"_k{i}" for i in range(len(on))], [least], None).select("_least.row.*")


def insert_stream(
    stream: DataFrame, folder: str, checkpoint: str, on: Sequence[str], order: Sequence[str], once: bool = True
) -> StreamingQuery:
    """Insert, skip conflicts, over a stream: of all rows of a key, the first by `order` is in the table, whenever it arrives.

    A micro-batch is reduced to one row per key, compared with the rows that the table has for these keys only, and
    written where it is new or comes first. So a late row takes the place of one that it precedes, and is skipped otherwise,
    which is what one batch over all files gives. Rows with a NULL in the key are all kept, as a unique constraint keeps them.
    `loaded` reads the table.
    """
    schema = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = durable(batch)
        keyed = rows.dropna(subset=list(on))
        first = durable(_first_of_key(keyed, on, order))
        had = semi_join(_current(stored_batches(spark, folder, schema, number), on), first, list(on), unique="right")
        best = _first_of_key(had.select(*schema.names).unionByName(first), on, order)
        fresh = best.join(had.select(*on, F.struct(*schema.names).alias("_had")), list(on), "left")
        changed = fresh.where(F.col("_had").isNull() | ~F.col("_had").eqNullSafe(F.struct(*schema.names))).select(*schema.names)
        nameless = rows.where(_any_null(on))
        changed.unionByName(nameless).write.mode("overwrite").parquet(f"{folder}/{BATCH}={number}")

    return _start(stream, folder, checkpoint, write, once)


def _any_null(on: Sequence[str]) -> Column:
    found = F.lit(False)
    for c in on:
        found |= F.col(c).isNull()
    return found


def _current(batches: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of the latest batch of every key; a key has one row in a batch."""
    columns = [c for c in batches.columns if c != BATCH]
    keyed = batches.dropna(subset=list(on)).select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(on)), *batches.columns)
    latest = F.max_by(F.struct(*columns), BATCH).alias("_row")
    return one_per_key(keyed, [f"_k{i}" for i in range(len(on))], [latest], None).select("_row.*")


def loaded(spark: SparkSession, folder: str, schema: StructType, on: Sequence[str]) -> DataFrame:
    """The table that `insert_stream` has made so far."""
    batches = stored_batches(spark, folder, schema)
    return _current(batches, on).unionByName(batches.where(_any_null(on)).drop(BATCH))


def compacted(spark: SparkSession, folder: str, schema: StructType, on: Sequence[str], target: str) -> DataFrame:
    """The table as one stored snapshot in a new folder; readers switch to it, and a stream can go on from it as its first batch."""
    loaded(spark, folder, schema, on).write.parquet(f"{target}/{BATCH}=-1")
    return loaded(spark, target, schema, on)


def totals_stream(
    stream: DataFrame,
    folder: str,
    checkpoint: str,
    at: str,
    keys: Sequence[str],
    value: str,
    row_id: Sequence[str],
    delay: str = "2 days",
    once: bool = True,
) -> StreamingQuery:
    """Daily sums and counts per key over a stream in which rows may be delivered again.

    A row is recognised by `row_id` and its time, in state that Spark keeps until the watermark, `delay` behind the latest time, has
    passed it. What is written are the batch's sums, which `totals` adds up. Rows behind the watermark are dropped by Spark
    with the state that would recognise them: `delay` must cover the lateness of the source, as `totals` says which days are complete.
    """
    once_each = stream.withWatermark(at, delay).dropDuplicates([*row_id, at])
    daily = [F.to_date(at).alias("day"), *keys]

    def write(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy(*daily).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n_rows"), F.max(at).alias("latest"))
        sums.write.mode("overwrite").parquet(f"{folder}/{BATCH}={number}")

    return _start(once_each, folder, checkpoint, write, once)


def totals(spark: SparkSession, folder: str, schema: StructType, keys: Sequence[str], delay: str = "2 days") -> DataFrame:
    """`day`, the keys, `total`, `n_rows`, and `complete`: whether the watermark has passed the day."""
    batches = stored_batches(spark, folder, schema)
    latest = batches.agg(F.max("latest").alias("_latest")).first()[0]
    summed = batches.groupBy("day", *keys).agg(F.sum("total").alias("total"), F.sum("n_rows").alias("n_rows"))
    passed = F.date_add("day", 1) <= (F.lit(latest) - F.expr(f"INTERVAL {delay}"))
    return summed.withColumn("complete", F.coalesce(passed, F.lit(False)))

