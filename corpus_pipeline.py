"""From raw documents to balanced training shards: five stages, each stored and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentledger.llm import decontamination, toxicity
from rentledger.llm.common import table, text_bytes
from rentledger.llm.mixing import mixed_documents
from rentledger.llm.queries import MIXTURE, REST
from rentledger.llm.sharding import histogram_sort
from rentledger.llm.simhash import one_of_each
from rentledger.sources.shared import scratch, shared_dir


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; it is trained on the labels of these documents."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id: SimHash at 2 bits over 3-word shingles."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item's question and answer recur go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order of the mixture."""
    return mixed_documents(docs, MIXTURE, REST)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of near-equal bytes, cut along the order in which the mixture is stored."""
    file = F.coalesce(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("long"), F.lit(0))
    return histogram_sort(docs, (file, F.col("_metadata.row_index")), text_bytes(F.col("text")) + 1)


STAGES = [
    ("toxicity", clean),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: A trained classifier and fingerprints decide, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table; every stage's rows are stored in the shared folder, what it stores on its way is freed."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
