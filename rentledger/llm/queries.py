"""The registered queries of the subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentledger.llm import decontamination, langid, licenses, ranking, recipes, repair, tokens, toxicity
from rentledger.llm.common import table
from rentledger.llm.mixing import mix
from rentledger.llm.sharding import shard_documents
from rentledger.llm.simhash import near_duplicates
from rentledger.llm.vptree import nearest
from rentledger.llm.warc import archive_folder, read_archive, write_archive

#: Target weights: four tiers of sources; a source that is not named shares the weight of the rest.
MIXTURE = {f"src{i}": i % 4 + 1 for i in range(20)}
REST = 2


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, MIXTURE, REST).select("doc_id", "source", "stream", "block", "place", "slot")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_spans(table(spark, sf_dir, "documents"))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokens.read_vocabulary(spark))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op9_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = archive_folder(spark)
    index = write_archive(table(spark, sf_dir, "pages"), folder)
    return read_archive(spark, folder, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair.repair(repair.damage(table(spark, sf_dir, "conversations")))
    own = repair.digests(found.edits).select(F.col("conv_id").alias("id"), "audit", "repaired_sha256")
    return found.report.join(own, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        *found.report.columns,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.exact_groups(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_sharding, op2_decontamination, op3_mixing, op4_toxicity, op5_simhash,
        op6_licenses, op7_tokens, op8_langid, op9_vptree, op10_warc,
        op11_repair, op12_ranking, op13_exact_dedup,
    )
    return {f.__name__: f for f in found}


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op12_ranking": f"""
        WITH words AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS terms FROM documents
        ), counted AS (SELECT row, doc_id, terms, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0),
        whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM counted),
        held AS (
            SELECT row, doc_id, n, term, count(*)::BIGINT AS tf
            FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM counted) GROUP BY ALL
        ), asked AS (
            SELECT item_id, term, count(*)::BIGINT AS times
            FROM (SELECT DISTINCT item_id, text FROM benchmark) AS b, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) AS u(term) GROUP BY ALL
        ), weighed AS (
            SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM held, whole WHERE term IN (SELECT term FROM asked) GROUP BY term
        ), scored AS (
            SELECT item_id, row, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))))::BIGINT AS score
            FROM held JOIN asked USING (term) JOIN weighed USING (term), whole GROUP BY ALL
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
    "op13_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER (PARTITION BY low) AS keep_id, count(*) OVER (PARTITION BY low) AS group_size,
               row_number() OVER (PARTITION BY low ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(low) AS text_sha256
        FROM (SELECT doc_id, {_LOWERED} AS low FROM documents)
    """,
}


def oracles() -> dict[str, str]:
    """Those that SQL can express; `tests/llm` compares the others with brute force."""
    return ORACLES
