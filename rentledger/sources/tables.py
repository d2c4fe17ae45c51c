"""Tables as Parquet folders: scan, literal rows, generated rows, new snapshots, sizes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rentledger.functions.text import size_pretty, starred


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan one stored table."""
    return spark.read.parquet(f"{folder}/{name}.parquet").alias(name)


def bind(table: DataFrame, **columns: str | Column) -> DataFrame:
    """View of a table under other column names: `bind(part, film_id="p_partkey")`."""
    return table.select(
        *((F.col(source) if isinstance(source, str) else source).alias(name) for name, source in columns.items())
    )


def rows(spark: SparkSession, data: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """Literal rows with declared types, for seeds and parameters.

    They go in as an Arrow table, which becomes a local relation: its size is known
    when joins are planned, so a small seed is broadcast and a stored table is not shuffled for it.
    """
    frame = spark.createDataFrame([], schema)
    made = pa.Table.from_pylist([dict(zip(frame.columns, row)) for row in data], to_arrow_schema(frame.schema))
    return spark.createDataFrame(made, frame.schema)


def sequence_table(spark: SparkSession, n: int, prefix: str, column: str = "col") -> DataFrame:
    """`prefix1 .. prefixN` in one text column, made in parallel on the executors."""
    return spark.range(1, n + 1).select(starred(prefix, F.col("id")).alias(column))


def create_as(df: DataFrame, path: str, replace: bool = False) -> DataFrame:
    """Store the rows as a new table and return the stored table.

    Without `replace` an existing table is an error. Never replace the folder
    that `df` itself is read from: write a new folder and switch to it.
    """
    df.write.mode("overwrite" if replace else "errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_to(path: str, df: DataFrame) -> None:
    """Add the rows to a stored table as new files; the files that are there stay as they are."""
    df.write.mode("append").parquet(path)


def save_all(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Store the new state of several tables in a fresh folder.

    The tables they were computed from stay untouched, so a job that fails
    midway changes nothing: readers go on with the old folder until the caller
    hands them the new one.
    """
    for name, table in tables.items():
        table.write.mode("errorifexists").parquet(f"{folder}/{name}.parquet")


def truncate(table: DataFrame) -> DataFrame:
    """No rows, same columns; nothing is scanned."""
    return table.limit(0)


def with_defaults(source: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill columns the source does not have; a NULL that was given on purpose stays NULL."""
    missing = {
        name: value if isinstance(value, Column) else F.lit(value)
        for name, value in defaults.items()
        if name not in source.columns
    }
    return source.withColumns(missing) if missing else source


def append(table: DataFrame, source: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Table plus source rows, matched by column name and cast to the table's types."""
    filled = with_defaults(source, defaults or {})
    present = set(filled.columns)
    unknown = present - set(table.columns)
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")
    shaped = filled.select(
        *(
            (F.col(field.name) if field.name in present else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in table.schema.fields
        )
    )
    return table.unionByName(shaped)


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("row_count"))


def table_size(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All visible files of a stored table and their bytes. Only file lengths are listed, no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    totals = (
        files.select("path", "length")
        .agg(
            F.count("path").alias("file_count"),
            F.coalesce(F.sum("length"), F.lit(0).cast("long")).alias("total_bytes"),
        )
    )
    return totals.select(F.lit(name).alias("table_name"), "*").withColumns({"total": size_pretty(F.col("total_bytes"))})
