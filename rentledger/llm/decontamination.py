"""Benchmark decontamination: BM25 over an inverted index of test items, searched with block-max WAND.

Items are cut into segments of a few dozen words, the documents of the index. A posting
holds a segment and its BM25 part for a term, divided by the score that the
segment gets for its own words; so 1 is a full match and one threshold suits all
segments. Posting lists are ordered by segment and cut into blocks with their
largest part.

Every passage of a training text, a window of words that overlaps the next one by
half, is a query for all segments above the threshold. A window is first
bounded by the parts of rarer terms, summed per segment, and all that frequent words can add;
those that may reach the threshold go through the pivots and block bounds of WAND. What is found is
verified on the item's question (its words up to the last quarter) and answer (the
rest): both must recur in the text around the passage, the question in runs of words, the answer in its order within a
stretch of about its own length.

Number, mean length and document frequencies of the segments are those of all items, however many indexes they are dealt to.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from rentledger.sources.shared import durable

K1, B = 1.2, 0.75  # usual BM25 constants
SEGMENT, PASSAGE = 48, 128  # words
BLOCK = 8  # postings
THRESHOLD = 0.5  # share of a segment's own score
COMMON = 0.3  # share of it that frequent words may make up in bounds
WIDTH, OVERLAP = 5, 0.8  # words of a shingle; share of the question and of the answer that must recur
SHARD_ITEMS = 20_000  # items indexed, broadcast and searched at a time
STRETCH = 2  # times an answer's length, in which its words must recur in order
WORD = re.compile(r"\w+")
HIT = "doc_id long, item_id long, bm25 double, question_overlap double, answer_overlap double, start_word int, end_word int"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def segments_of(item: list[str]) -> list[list[str]]:
    pieces = max(1, round(len(item) / SEGMENT)) if item else 0
    return [item[len(item) * i // pieces : len(item) * (i + 1) // pieces] for i in range(pieces)]


def in_order(wanted: list[str], text: list[str]) -> int:
    """Length of the longest common subsequence, with one bit for each wanted word."""
    places: dict[str, int] = defaultdict(int)
    for i, word in enumerate(wanted):
        places[word] |= 1 << i
    full = free = (1 << len(wanted)) - 1
    for word in text:
        if word in places:
            taken = free & places[word]
            free = ((free + taken) | (free - taken)) & full
    return len(wanted) - free.bit_count()


@dataclass
class Statistics:
    """Of the segments of all items: how many there are, their words, and in how many of them a term occurs."""

    segments: int
    words: int
    frequency: Mapping[str, int]

    @classmethod
    def of(cls, items: list[list[str]]) -> Statistics:
        own = [s for item in items for s in segments_of(item)]
        return cls(len(own), sum(map(len, own)), Counter(t for s in own for t in set(s)))


@dataclass
class Index:
    """Terms by number; postings as flat arrays, `at[t]:at[t + 1]` being the list of term t."""

    terms: dict[str, int]
    at: np.ndarray
    segment: np.ndarray
    part: np.ndarray
    owner: list[int]  # item of a segment
    items: list[list[str]]
    ids: list[int]
    blocks: list[list[tuple[int, float]]] = field(default_factory=list)  # per term: last segment and largest part of each block
    best: list[float] = field(default_factory=list)
    rare: np.ndarray | None = None  # terms that bounds add up; the others' parts are added whole, as `rest` of each segment
    rest: np.ndarray | None = None

    @classmethod
    def build(cls, texts: list[tuple[int, str]], statistics: Statistics | None = None) -> Index:
        """`statistics` are those of all items where `texts` are only some."""
        items = [words(t) for _, t in texts]
        known = statistics or Statistics.of(items)
        segments, owner = [], []
        for number, item in enumerate(items):
            own = segments_of(item)
            segments += own
            owner += [number] * len(own)
        mean = known.words / max(1, known.segments)
        lists: dict[str, list] = defaultdict(list)
        for number, segment in enumerate(segments):
            parts = {}
            for term, tf in Counter(segment).items():
                idf = math.log(1 + (known.segments - known.frequency[term] + 0.5) / (known.frequency[term] + 0.5))
                parts[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(segment) / mean))
            own = sum(parts.values())
            for term, part in parts.items():
                lists[term].append((number, part / own))
        terms = {t: i for i, t in enumerate(lists)}
        flat = [p for t in terms for p in lists[t]]
        made = cls(
            terms,
            np.cumsum([0, *(len(lists[t]) for t in terms)]),
            np.array([p[0] for p in flat], dtype=np.int64),
            np.array([p[1] for p in flat], dtype=np.float64),
            owner,
            items,
            [i for i, _ in texts],
        )
        for t in terms:
            runs = [lists[t][i : i + BLOCK] for i in range(0, len(lists[t]), BLOCK)]
            made.blocks.append([(r[-1][0], max(p for _, p in r)) for r in runs])
            made.best.append(max(p for _, p in lists[t]))
        made._split()
        return made

    def _split(self) -> None:
        """Terms with the longest lists are not rare, as long as no segment comes near the threshold with them alone."""
        self.rare, self.rest = np.ones(len(self.terms), bool), np.zeros(len(self.owner))
        for term in np.argsort(-np.diff(self.at), kind="stable"):
            own = slice(self.at[term], self.at[term + 1])
            after = self.rest[self.segment[own]] + self.part[own]
            if own.stop - own.start < 4:
                break
            if after.max() <= COMMON:
                self.rare[term] = False
                self.rest[self.segment[own]] = after

    def retrieve(self, query: set[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Block-max WAND: all segments whose score for the terms reaches the threshold, with their scores."""
        end = len(self.owner)
        lists = [[int(self.segment[self.at[t]]), t, int(self.at[t])] for t in query]
        found = []
        while True:
            lists.sort()
            bound, pivot = 0.0, -1
            for i, (segment, term, _) in enumerate(lists):
                if segment >= end:
                    break
                bound += self.best[term]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                return found
            target = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == target:
                pivot += 1
            bound, beyond = 0.0, end
            for _, term, _ in lists[: pivot + 1]:
                blocks = self.blocks[term]
                i = bisect_left(blocks, (target,))
                if i < len(blocks):
                    bound += blocks[i][1]
                    beyond = min(beyond, blocks[i][0] + 1)
            if bound < threshold:  # no segment up to the end of these blocks can reach it
                after = lists[pivot + 1][0] if pivot + 1 < len(lists) else end
                target = max(target + 1, min(beyond, after))
            elif lists[0][0] == target:
                score = sum(float(self.part[at]) for segment, _, at in lists if segment == target)
                if score >= threshold:
                    found.append((target, score))
                target += 1
            for one in lists[: pivot + 1]:
                if one[0] < target:
                    stop = int(self.at[one[1] + 1])
                    one[2] += int(np.searchsorted(self.segment[one[2] : stop], target))
                    one[0] = int(self.segment[one[2]]) if one[2] < stop else end

    def candidates(self, numbers: np.ndarray, threshold: float = THRESHOLD) -> Iterator[tuple[int, int, int, float]]:
        """`first word, last word, item, score` of the passages that retrieve something; `numbers` are terms or -1."""
        step = PASSAGE // 2
        where = np.flatnonzero((numbers >= 0) & self.rare[numbers])
        if not len(where):
            return  # a threshold above COMMON takes some rare term
        # Sum of parts by half passage and segment; a term counts once in a half, so sums bound scores from above.
        pairs = np.unique((where // step) * len(self.terms) + numbers[where])
        half, term = np.divmod(pairs, len(self.terms))
        many = self.at[term + 1] - self.at[term]
        spot = np.repeat(self.at[term] - np.cumsum(many) + many, many) + np.arange(many.sum())
        key = np.repeat(half, many) * len(self.owner) + self.segment[spot]
        keys, inverse = np.unique(key, return_inverse=True)
        sums = np.bincount(inverse, self.part[spot])
        next_ = np.searchsorted(keys, keys + len(self.owner))
        follows = (next_ < len(keys)) & (keys[np.minimum(next_, len(keys) - 1)] == keys + len(self.owner))
        both = sums + np.where(follows, sums[np.minimum(next_, len(keys) - 1)], 0)
        alone = ~np.isin(keys - len(self.owner), keys)
        rest = self.rest[keys % len(self.owner)] + 1e-9
        high = np.unique(np.concatenate([keys[both + rest >= threshold] // len(self.owner), keys[alone & (sums + rest >= threshold)] // len(self.owner) - 1]))
        for passage in high[high >= 0].tolist():
            lo, hi = passage * step, min(len(numbers), passage * step + PASSAGE)
            query = set(numbers[lo:hi].tolist()) - {-1}
            for segment, score in self.retrieve(query, threshold):
                yield lo, hi, self.owner[segment], score

    def verify(self, text: list[str], item: list[str]) -> tuple[float, float]:
        """Shares of the question's runs of words that recur in `text`, and of the answer's words that do in order, in a stretch of it."""
        cut = max(1, len(item) - max(WIDTH, len(item) // 4))
        grams = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        width = min(WIDTH, max(1, cut))
        question = grams(item[:cut], width)
        answer = item[cut:]
        seen = grams(text, width) & question
        asked = len(seen) / len(question)
        if not answer:
            return asked, asked
        stretch, step = STRETCH * len(answer), max(1, len(answer) // 2)
        answered = max(in_order(answer, text[i : i + stretch]) for i in range(0, max(1, len(text) - stretch + step), step)) / len(answer)
        return asked, answered

    def hits(self, text: str | None, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple]:
        """Verified items of a text: `item_id, bm25, question, answer, first word, last word` of the best passage."""
        own = words(text)
        if not self.terms or not own:
            return []
        find = self.terms.get
        numbers = np.array([find(w, -1) for w in own], dtype=np.int64)
        best: dict[int, tuple] = {}
        for lo, hi, item, score in self.candidates(numbers, threshold):
            reach = len(self.items[item])
            asked, answered = self.verify(own[max(0, lo - reach) : hi + reach], self.items[item])
            if asked >= overlap and answered >= overlap:
                found = (self.ids[item], score, asked, answered, lo, hi)
                if item not in best or (found[1], -lo) > (best[item][1], -best[item][4]):
                    best[item] = found
        return [best[i] for i in sorted(best)]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every batch of items: in how many segments each term is, and under NULL the number of segments and of their words."""
    for batch in batches:
        own = Statistics.of([words(t.as_py()) for t in batch.column("text")])
        rows = [(None, own.segments, own.words), *((t, n, 0) for t, n in own.frequency.items())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))], names=["term", "n", "words"])


def _shards(benchmark: DataFrame, size: int | None = None) -> Iterator[Index]:
    """Indexes of about `size` items each, by a hash of the id; one is on the driver at a time, with the statistics of its own terms."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", "text")
    count = max(1, -(-items.count() // (size or SHARD_ITEMS)))
    known = items.select("text").mapInArrow(_terms, "term string, n long, words long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    known = durable(known) if count > 1 else known
    total = known.where("term IS NULL").first()
    for shard in range(count):
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == shard)
        rows = mine.orderBy("item_id", "text").collect()
        own = mine.select("text").mapInArrow(_terms, "term string, n long, words long").select("term").dropna().distinct()
        frequency = {r.term: r.n for r in known.join(own, "term", "left_semi").collect()}
        statistics = Statistics(total.n, total.words, frequency) if total else None
        yield Index.build([(r.item_id, r.text) for r in rows], statistics)


def _find(shared, threshold: float) -> Callable:
    kinds = pa.schema([
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("bm25", pa.float64()), ("question_overlap", pa.float64()),
        ("answer_overlap", pa.float64()), ("start_word", pa.int32()), ("end_word", pa.int32()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc.as_py(), *hit)
                for doc, text in zip(batch.column("doc_id"), batch.column("text"))
                for hit in shared.value.hits(text.as_py(), threshold)
            ]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, kinds)], schema=kinds)

    return run


def contaminations(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`HIT` rows: one for each document and each item whose question and answer both recur in it.

    All passages of whole texts are searched for all items. Null and empty texts, and items
    without words, hit nothing; rows that repeat hit as often as they occur; items that repeat are
    found under each id. Without items, or documents, there are no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    if threshold <= COMMON:
        raise ValueError(f"the threshold must be above {COMMON}")
    for index in _shards(benchmark):
        part = rows.mapInArrow(_find(docs.sparkSession.sparkContext.broadcast(index), threshold), HIT)
        found = part if found is None else found.union(part)
    return found


def flag(docs: DataFrame, index: Index) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf(BooleanType())
    def contaminated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([bool(shared.value.hits(t.as_py())) for t in batch], pa.bool_())

    return contaminated(F.col("text"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows in whose text no item recurs; columns as in `docs`. Texts are judged where they lie, without a shuffle."""
    for index in _shards(benchmark):
        docs = docs.where(~flag(docs, index))
    return docs
