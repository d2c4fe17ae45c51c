"""Exact deduplication by content-defined chunk recipes.

A text's bytes are cut where their own values say so: a chunk ends after three
bytes in a row from one residue class, so an insertion moves the cuts near it and
leaves the others where they were. Equal texts have equal cuts, hence equal lists of chunks.

Every chunk has an identifier of hashes. Chunks are brought together once, equal
ones combined before they move, and each identifier is verified to stand for one
sequence of bytes; were two to share one, all identifiers would be made wider and verified again.
After that only the ordered lists of identifiers, the recipes, are moved and
compared: about one byte in eighty of the texts. The texts themselves are never grouped, joined or stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentledger.sources.shared import durable

LEAST, MOST = 1_024, 16_384  # bytes of a chunk; the last of a text may be shorter
ANCHOR = "".join(f"\\x{b:02x}" for b in range(256) if b % 8 == 5)  # e, m, u, '-', '5' and others of the class
CUTS = f"(?s).{{{LEAST - 3},{MOST - 3}}}?[{ANCHOR}][{ANCHOR}][{ANCHOR}]|.{{1,{MOST}}}"
WIDTHS = (2, 4, 8)  # 64-bit hashes in an identifier: at first, and after identifiers that clash
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else; a null text is an empty one."""
    whole = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(whole) == F.char_length(whole)
    return F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def chunks(text: Column, cuts: str = CUTS) -> Column:
    """The chunks of a text in order, one character for every UTF-8 byte; joined together they are the text."""
    return F.regexp_extract_all(F.decode(text.cast("binary"), "ISO-8859-1"), F.lit(cuts), F.lit(0))


def identifier(chunk: Column, width: int, bits: int = 64) -> Column:
    """`width` hashes with different seeds, as an array of longs; fewer `bits` of each make clashes for tests."""
    kept = lambda h: h if bits == 64 else F.shiftrightunsigned(h, 64 - bits)
    return F.array(*(kept(F.xxhash64(F.lit(i), chunk)) for i in range(width)))


def clashes(docs: DataFrame, width: int, cuts: str = CUTS, bits: int = 64) -> DataFrame:
    """Identifiers that stand for more than one chunk: none, as good as always.

    A chunk that occurs again in a task is combined with the earlier one before anything is moved.
    """
    pieces = docs.select(F.explode(chunks(lowered(F.col("text")), cuts)).alias("chunk"))
    contents = pieces.select(identifier(F.col("chunk"), width, bits).alias("id"), "chunk").groupBy("id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    return contents.groupBy("id").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")


def recipes(docs: DataFrame, cuts: str = CUTS, bits: int = 64) -> DataFrame:
    """`doc_id`, `row`, `text_sha256`, `recipe` of every row, stored. Two recipes are equal where the texts are.

    `row` tells rows apart that repeat; the recipe of an empty text is empty.
    """
    for width in WIDTHS:
        if clashes(docs, width, cuts, bits).isEmpty():
            break
    else:
        raise ValueError(f"chunks clash in {WIDTHS[-1]} hashes")
    text = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), lowered(F.col("text")).alias("text"))
    ids = F.flatten(F.transform(chunks(F.col("text"), cuts), lambda c: identifier(c, width, bits)))
    return durable(text.select("doc_id", "row", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), ids.alias("recipe")))


def exact_groups(docs: DataFrame, cuts: str = CUTS, bits: int = 64) -> DataFrame:
    """`doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256` of every row of `docs`.

    Texts are equal when they are after lower-casing A-Z; a null text equals an empty one. Of equal texts
    the row with the largest doc_id stays, one of them if it is there several times. Rows without
    doc_id stay only where no row of their group has one, and then one does, with a null `keep_id`.
    An empty table gives no rows; further columns are not read.
    """
    rows = recipes(docs, cuts, bits)
    repeated = durable(
        rows.groupBy("recipe")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("doc_id").alias("keep_id"),
            F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("keep_row"),
        )
        .where("n > 1")
    )
    alone = F.col("n").isNull()
    return rows.join(repeated, "recipe", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row of `docs` for each different text, the one that `exact_groups` keeps; columns as in `docs`, whatever their names.

    Rows of texts that occur once pass by a join with the repeated digests only.
    """
    marked = exact_groups(docs, **options).where("group_size > 1").select(F.col("text_sha256").alias("sha"), F.col("keep_id").alias("keep"))
    repeated = durable(marked.distinct())
    own = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    hashed = own.select("*", F.sha2(lowered(text).cast("binary"), 256).alias("sha")).join(repeated.select("*", F.lit(True).alias("again")), "sha", "left")
    single = hashed.where("again IS NULL")
    chosen = hashed.where(F.col("again") & doc_id.eqNullSafe(F.col("keep"))).dropDuplicates(["sha"])
    return single.union(chosen).drop("sha", "keep", "again").toDF(*docs.columns)
