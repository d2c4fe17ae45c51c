"""SimHash near-duplicates by covering locality-sensitive hashing.

With radius r, every bit position gets a nonzero vector of r + 1 bits, in turn. A
nonzero vector v of r + 1 bits names a table: its mask keeps the positions whose
vector has an odd product with v. Any r positions leave some v orthogonal to all
their vectors, so two fingerprints that differ in at most r bits agree under that
mask: they meet in one of the 2**(r+1) - 1 tables, always.

Only distinct fingerprints are linked, and a bucket never becomes pairs. A
bucket of two is settled by its sums: the exclusive or of its members is their
difference. Members of larger buckets are linked through the fingerprints next to
them: two within distance 2 have a neighbour, at distance 1 or 0 from each,
in common, and a neighbour has at most 65 fingerprints around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from rentledger.llm.common import constant, text_hash
from rentledger.llm.components import components
from rentledger.sources.shared import durable

BITS, RADIUS, SHINGLE, SEED = 64, 2, 3, 42
CHUNK = 1 << 16  # shingles whose bits are unpacked at a time
SIGNED = lambda x: x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """64-bit SimHash of a whole UTF-8 text as a signed long; a text without words has 0.

    Words are runs of other than ASCII white space, A-Z lower-cased; shingles of
    `width` words count as often as they occur, shorter texts are one shingle.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    count = max(1, len(words) - width + 1)
    for lo in range(0, count, CHUNK):
        spans = zip(starts[lo : lo + CHUNK], ends[min(lo + width, len(words)) - 1 :])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")
    return SIGNED(value)


@F.arrow_udf(LongType())
def fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array([fingerprint(x.as_py()) for x in batch.cast(pa.binary())], pa.int64())


def masks(radius: int = RADIUS) -> list[int]:
    """Positions that each table compares, as signed longs."""
    size = 1 << (radius + 1)
    vector = [1 + i % (size - 1) for i in range(BITS)]
    odd = lambda v, i: (v & vector[i]).bit_count() & 1
    return [SIGNED(sum(odd(v, i) << i for i in range(BITS))) for v in range(1, size)]


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame) -> DataFrame:
    """Edges `u`, `v` that connect all of the distinct longs `fp` that differ in at most two bits, and no others.

    Both ends of an edge are within the radius of each other; not every such pair is an edge.
    """
    tables = F.explode(F.array(*(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks()))))
    keyed = prints.select("fp", tables.alias("b")).select("fp", "b.t", "b.key")
    buckets = durable(
        keyed.groupBy("t", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("fp").alias("apart"), F.min("fp").alias("v"), F.max("fp").alias("u"))
        .where(f"n > 2 OR (n = 2 AND bit_count(apart) <= {RADIUS})")
    )
    pairs = buckets.where("n = 2").select("u", "v")
    full = buckets.where("n > 2").select("t", "key")
    crowded = durable(keyed.join(full, ["t", "key"], "left_semi").select("fp").distinct())
    flips = constant([0, *(SIGNED(1 << i) for i in range(BITS))], "bigint")
    near = crowded.select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("near"))
    around = near.groupBy("near").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)  # 65 at most
    stars = around.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u")).where("u != v")
    return pairs.union(stars)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text_hash`, `fp`, `component_id` of every row of `docs`.

    Rows are linked where fingerprints differ in at most two bits; `component_id` is the
    smallest doc_id reachable. Null and empty texts have fingerprint 0 and are
    linked like others. Rows without doc_id link nothing and have no component; one id with
    several texts is no link between them. Rows that repeat come out as often as they go in.
    An empty table gives no rows.
    """
    prints = durable(docs.select("doc_id", text_hash(F.col("text")).alias("text_hash"), fingerprints("text").alias("fp")))
    distinct = durable(prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = components(links(distinct)).withColumnRenamed("node", "fp")
    linked = durable(found.join(distinct, "fp"))
    least = durable(linked.groupBy("component").agg(F.min("rep").alias("least")))
    named = durable(linked.join(least, "component").select("fp", "least"))
    classes = durable(distinct.join(named, "fp", "left").select("fp", F.coalesce("least", "rep").alias("component_id")))
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return prints.join(classes, "fp", "left").select("doc_id", "text_hash", "fp", own)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of every group of near-duplicates, once; columns as in `docs`, whatever their names.

    Rows without doc_id all stay. What goes is named by id and a hash of the text, so an id that stands for
    several texts loses only those that another document repeats.
    """
    found = durable(near_duplicates(docs).select("doc_id", "text_hash", "component_id").distinct())
    gone = found.where("doc_id > component_id").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    own = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    left = own.select("*", doc_id.alias("id"), text_hash(text).alias("hash")).join(gone, ["id", "hash"], "left_anti")
    known = left.where("id IS NOT NULL").dropDuplicates(["id", "hash"])
    return known.union(left.where("id IS NULL")).drop("id", "hash").toDF(*docs.columns)
