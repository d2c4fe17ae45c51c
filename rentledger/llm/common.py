"""Small things that several operators share."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentledger.sources.shared import durable

FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo `FOLDS`; null for a null id, which is thus in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def text_bytes(text: Column) -> Column:
    """Length in UTF-8 bytes; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def constant(values: Sequence, kind: str) -> Column:
    """A literal array of any length; the optimizer folds it to one constant."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def in_files(df: DataFrame) -> DataFrame:
    """The rows as read from files, whose `_metadata` says where each is stored; other rows are stored first."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return durable(df)
    return df
