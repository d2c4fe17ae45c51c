"""Language identification by nearest centroid.

A text is the vector of its hashed 3-grams of the UTF-8 bytes of its lower-cased words, weighted by
1 + ln(count) times the inverse document frequency, and normalised. Every language
has a few centroids, made by spherical k-means over its sampled vectors; a text gets the
language of the centroid with the largest cosine. It is rejected where that cosine is under the
language's floor, a low quantile of what its training texts reach.

Every language that occurs is learned. Its centroids are made in a task of its own and stored; texts are compared with
the languages block by block, so that one broadcast holds the centroids of `BLOCK` languages at most.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentledger.llm.common import fold, held_out
from rentledger.sources.shared import durable

DIMS = 8_192
CENTROIDS, ROUNDS = 4, 12
SAMPLE = 1_000  # training vectors of each language, chosen by a hash of the id
BLOCK = 200  # languages whose centroids are broadcast together
FLOOR = 0.005  # quantile of training cosines under which a text is rejected
PIECE = 1 << 18  # bytes hashed at a time
UNKNOWN = "und"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def counts(text: str) -> np.ndarray:
    """How often each hashed 3-gram of bytes occurs in the lower-cased text, runs of other than letters being one space."""
    data = (" " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " ").encode("utf-8", "replace")
    found = np.zeros(DIMS, dtype=np.int64)
    for at in range(0, max(1, len(data) - 2), PIECE):
        b = np.frombuffer(data[at : at + PIECE + 2], dtype=np.uint8).astype(np.uint64)
        if len(b) < 3:
            break
        grams = (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:]
        found += np.bincount(((grams * MULTIPLIER) >> np.uint64(64 - 13)).astype(np.int64), minlength=DIMS)
    return found


def vector(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the normalised TF-IDF vector."""
    at = np.flatnonzero(found)
    values = (1 + np.log(found[at])) * idf[at]
    size = np.linalg.norm(values)
    return at, values / size if size else values


@dataclass(frozen=True)
class Nearest:
    """What a text has come to so far: the largest cosine and its language, and the sum of exp(8 x (cosine - largest)) over all languages."""

    cosine: float = -2.0
    total: float = 0.0
    language: str | None = None
    rejected: bool = True


@dataclass(frozen=True)
class Model:
    """The languages of one block."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # one row each, normalised
    owner: np.ndarray  # index of its language
    floors: np.ndarray  # by language

    def nearest(self, text: str | None, before: Nearest = Nearest()) -> Nearest:
        """The nearest language of this block and those before it; a text without letters has none."""
        if not text or not any(map(str.isalpha, text)) or not self.languages:
            return before
        at, values = vector(counts(text), self.idf)
        best = np.full(len(self.languages), -1.0)
        np.maximum.at(best, self.owner, self.centroids[:, at] @ values)
        chosen = int(best.argmax())
        top = max(before.cosine, float(best[chosen]))
        total = before.total * float(np.exp(8 * (before.cosine - top))) + float(np.exp(8 * (best - top)).sum())
        if best[chosen] > before.cosine:
            return Nearest(top, total, self.languages[chosen], bool(best[chosen] < self.floors[chosen]))
        return Nearest(top, total, before.language, before.rejected)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the text lies too far from all centroids.

        The score is the largest cosine's share of the best cosines of all languages.
        A text without letters is `und` with score 0 and rejected; so is every text where no language was learned.
        """
        found = self.nearest(text)
        return (UNKNOWN, 0.0, True) if found.language is None else (found.language, 1 / found.total, found.rejected)


@dataclass(frozen=True)
class Trained:
    """All languages in order, the weights of the n-grams, and the stored centroids: `lang`, `centres`, `floor`."""

    languages: list[str]
    idf: np.ndarray
    stored: DataFrame | None = None

    def block(self, languages: list[str]) -> Model:
        if not languages or self.stored is None:
            return Model([], self.idf, np.zeros((0, DIMS)), np.zeros(0, int), np.zeros(0))
        rows = self.stored.where(F.col("lang").between(languages[0], languages[-1])).orderBy("lang").collect()
        centres = [np.frombuffer(r.centres, np.float32).reshape(-1, DIMS).astype(np.float64) for r in rows]
        owner = np.repeat(np.arange(len(rows)), [len(c) for c in centres])
        return Model([r.lang for r in rows], self.idf, np.vstack(centres), owner, np.array([r.floor for r in rows]))

    def blocks(self, size: int | None = None) -> list[list[str]]:
        size = size or BLOCK
        return [self.languages[i : i + size] for i in range(0, len(self.languages), size)] or [[]]

    @cached_property
    def whole(self) -> Model:
        return self.block(self.languages)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many texts each n-gram occurs, and how many texts there are (at place -1)."""
    seen, texts = np.zeros(DIMS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            seen += counts(text.as_py()) > 0
            texts += 1
    places = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(places, -1), pa.int32()), pa.array(np.append(seen[places], texts), pa.int64())], names=["place", "n"]
    )


def _count_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [counts(t.as_py()) for t in batch.column("text")]
        places = [np.flatnonzero(f).astype(np.int32) for f in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("mark"), pa.array(places, pa.list_(pa.int32())), pa.array([f[p] for f, p in zip(found, places)], pa.list_(pa.int64()))],
            names=["lang", "mark", "places", "counts"],
        )


def _cluster(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; each new first centre is the row that the earlier ones fit worst."""
    centres = [rows.mean(axis=0)]
    for _ in range(k - 1):
        centres.append(rows[(rows @ np.array(centres).T).max(axis=1).argmin()])
    found = np.array(centres)
    for _ in range(ROUNDS):
        found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
        near = (rows @ found.T).argmax(axis=1)
        found = np.array([rows[near == i].mean(axis=0) if (near == i).any() else found[i] for i in range(k)])
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)


def _centres(idf: np.ndarray, centroids: int) -> Callable:
    """The centroids and the floor of one language from the vectors of its sample."""

    def made(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["mark", "places", "counts"]).to_pylist(), key=lambda r: (r["mark"], r["places"]))
        matrix = np.zeros((len(rows), DIMS), dtype=np.float32)
        for i, r in enumerate(rows):
            found = np.zeros(DIMS, dtype=np.int64)
            found[r["places"]] = r["counts"]
            at, values = vector(found, idf)
            matrix[i, at] = values
        centres = _cluster(matrix, min(centroids, len(rows))).astype(np.float32)
        floor = float(np.quantile((matrix @ centres.T).max(axis=1), FLOOR))
        return pa.table({"lang": table.column("lang").slice(0, 1), "centres": pa.array([centres.tobytes()], pa.binary()), "floor": pa.array([floor], pa.float64())})

    return made


def train(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Trained:
    """Learn every language from text and non-null `lang` of rows outside the held-out fold.

    Document frequencies cover all those rows. Centroids are clustered from at most `sample` different texts of
    each language, the ones with the smallest hash of id and text; rows that repeat count once there. Rows without id, or
    without letters, are not used. Names of languages are all that comes to the driver as their number grows.
    """
    rows = docs.select("doc_id", "text", "lang").where((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    mark = F.xxhash64("doc_id", "text")
    totals = durable(rows.groupBy("lang").agg(F.approx_count_distinct(mark).alias("n")))  # of different rows
    languages = [r.lang for r in totals.select("lang").orderBy("lang").collect()]
    if not languages:
        return Trained([], np.ones(DIMS))
    frequency = rows.select("text").mapInArrow(_count_batches, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    seen = {r.place: r.n for r in frequency.collect()}
    idf = np.log((1 + seen.pop(-1)) / (1 + np.array([seen.get(i, 0) for i in range(DIMS)]))) + 1

    # A hash below a language's own share leaves about twice the sample, of which the smallest hashes are taken.
    marked = rows.withColumn("mark", mark).join(totals, "lang")
    under = F.shiftrightunsigned("mark", 11) < F.lit(2.0 * (sample + 50)) / F.col("n") * float(1 << 53)
    few = durable(marked.where(under).select("doc_id", "text", "lang", "mark").dropDuplicates(["doc_id", "text", "lang"]))
    order = Window.partitionBy("lang").orderBy("mark", "doc_id", "text")
    chosen = few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample)
    vectors = chosen.select("lang", "text", "mark").mapInArrow(_count_sample, "lang string, mark long, places array<int>, counts array<long>")
    made = vectors.groupBy("lang").applyInArrow(_centres(idf, centroids), "lang string, centres binary, floor double")
    return Trained(languages, idf, durable(made))


def _predict(shared, last: bool) -> Callable:
    """Take texts on by one block; the `last` one leaves the text away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        kinds = {"cosine": pa.float64(), "total": pa.float64(), "language": pa.string(), "rejected": pa.bool_()}
        for batch in batches:
            before = [Nearest(*b) for b in zip(*(batch.column(c).to_pylist() for c in kinds))]
            found = [model.nearest(t.as_py(), b) for t, b in zip(batch.column("text"), before)]
            made = [pa.array([getattr(f, c) for f in found], kind) for c, kind in kinds.items()]
            kept = ["doc_id", "held_out"] if last else ["doc_id", "held_out", "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, *kinds])

    return run


def identify(docs: DataFrame, trained: Trained, block: int | None = None) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred`, `score`, `rejected` of every row; texts are read whole.

    A null or empty text, or one without a letter, is `und`. A rejected text keeps its nearest language.
    Centroids of `block` languages are broadcast at a time; with more languages rows are stored after every block.
    """
    none = Nearest()
    shape = "doc_id long, held_out boolean, {}cosine double, total double, language string, rejected boolean"
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text", F.lit(none.cosine).alias("cosine"),
        F.lit(none.total).alias("total"), F.lit(none.language).cast("string").alias("language"), F.lit(none.rejected).alias("rejected"),
    )
    blocks = trained.blocks(block)
    for i, languages in enumerate(blocks):
        last = i == len(blocks) - 1
        shared = docs.sparkSession.sparkContext.broadcast(trained.block(languages))
        rows = rows.mapInArrow(_predict(shared, last), shape.format("" if last else "text string, "))
        rows = rows if last else durable(rows)
    known = F.col("language").isNotNull()
    return rows.select(
        "doc_id", "held_out", F.coalesce("language", F.lit(UNKNOWN)).alias("lang_pred"), F.when(known, 1 / F.col("total")).otherwise(0.0).alias("score"), "rejected"
    )
