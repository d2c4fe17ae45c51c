"""Ranked lexical search for many items at once, with common subexpressions evaluated once.

An item's score of a document is a sum over the item's terms, so items that share
terms share parts of that sum. The shared term sets are mined first: terms that
stand in exactly the same items form one node, then the two nodes that most
items have in common form a node of their own, and so on until no two items
share a pair. The result is a graph without cycles: leaves are terms, inner nodes
are term sets, and an item is the sum of the few nodes left to it.

Documents are read once: each leaves its length and the counts of the terms
that any item has. Term statistics are aggregates of those rows. Then every task
takes its documents a batch at a time, adds the parts of the terms up to node accumulators,
one number for a node and document, combines them along the graph and keeps the best documents of each
item. Accumulators stay in the task; only each task's best rows are exchanged.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentledger.sources.shared import durable

TOP = 10
VOCABULARY_BYTES = 64 << 20  # of item texts whose terms are looked for in one scan
GRAPH_BYTES = 1 << 20  # of item texts in one graph
REACH = 8  # places in an item, by frequency, between two nodes that may be joined; saves work only, results are the same
CELLS = 1 << 22  # accumulators of one batch
INDEX = "doc_id long, n long, terms array<int>, tfs array<int>"
BEST = "item int, doc_id long, score long"
#: A-Z become a-z, other letters, digits and all bytes beyond ASCII stay, the rest parts terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters of a whole UTF-8 text, in order, A-Z lower-cased."""
    return (text or b"").translate(TERM_BYTES).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


@dataclass
class Graph:
    """Nodes are numbers: first those of terms that stand in the same items, then, in order, sums of two earlier ones."""

    leaves: list[tuple[int, int, int]]  # term, times it counts, node
    sums: list[tuple[int, int, int]]  # node, and the two that it adds up
    items: list[list[int]]  # the nodes of each item

    @property
    def size(self) -> int:
        return 1 + max([-1, *(n for _, _, n in self.leaves), *(n for n, _, _ in self.sums)])

    def additions(self) -> int:
        """Sums of accumulators for a document: those that make nodes, and those that make items."""
        return len(self.sums) + sum(max(0, len(own) - 1) for own in self.items)


def mine(items: Sequence[Counter], reach: int = REACH) -> Graph:
    """Graph for items given as counts of term numbers."""
    owners = defaultdict(list)
    for i, counts in enumerate(items):
        for term, times in counts.items():
            owners[term, times].append(i)
    classes = defaultdict(list)
    for leaf, own in owners.items():
        classes[tuple(own)].append(leaf)
    holders, leaves = [], []
    for own, members in classes.items():
        leaves.extend((term, times, len(holders)) for term, times in members)
        holders.append(set(own))
    nodes = [set() for _ in items]
    for node, own in enumerate(holders):
        for i in own:
            nodes[i].add(node)
    sums = []
    while True:
        pairs = Counter()
        for own in nodes:
            order = sorted((n for n in own if len(holders[n]) > 1), key=lambda n: (-len(holders[n]), n))
            pairs.update((a, b) if a < b else (b, a) for k, a in enumerate(order) for b in order[k + 1 : k + 1 + reach])
        before = len(sums)
        for (a, b), n in sorted(pairs.items(), key=lambda p: (-p[1], p[0])):
            if n < 2:
                break
            both = holders[a] & holders[b]
            if len(both) < 2:
                continue
            node = len(holders)
            holders.append(both)
            sums.append((node, a, b))
            holders[a] = holders[a] - both
            holders[b] = holders[b] - both
            for i in both:
                nodes[i] = nodes[i] - {a, b} | {node}
        if len(sums) == before:
            return Graph(leaves, sums, [sorted(own) for own in nodes])


def _counted(shared) -> Callable:
    """For every text with a term: its number of terms, and how often each term of the vocabulary occurs."""
    kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            ids, lengths, found, counts = [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                words = terms(text.as_py())
                if words:
                    held = Counter(words)
                    own = held.keys() & vocabulary.keys()
                    ids.append(doc)
                    lengths.append(len(words))
                    found.append([vocabulary[w] for w in own])
                    counts.append([held[w] for w in own])
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip((ids, lengths, found, counts), kinds)], schema=kinds)

    return run


class Scorer:
    """Adds up and combines accumulators for batches of documents, and keeps the best of each item."""

    def __init__(self, graph: Graph, weights: np.ndarray, n: int, length: int, top: int = TOP):
        self.graph, self.weights, self.n, self.length, self.top = graph, weights, n, length, top
        order = sorted(graph.leaves)
        self.at = np.searchsorted([t for t, _, _ in order], np.arange(len(weights) + 1))
        self.times = np.array([k for _, k, _ in order], np.int64)
        self.node = np.array([x for _, _, x in order], np.int64)
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in graph.items]  # score, document, whether it has no id

    def scores(self, lengths: np.ndarray, ends: np.ndarray, found: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        """Scores by item and document; the terms of document i are those from ends[i] to ends[i + 1]."""
        m = 25 + 75 * lengths * self.n // self.length
        doc = np.repeat(np.arange(len(lengths)), np.diff(ends))
        part = self.weights[found] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m[doc]))
        own = self.at[found + 1] - self.at[found]  # a term stands in as many leaves
        leaf = np.repeat(self.at[found] - np.cumsum(own) + own, own) + np.arange(own.sum())
        sums = np.zeros((self.graph.size, len(lengths)), np.int64)
        np.add.at(sums, (self.node[leaf], np.repeat(doc, own)), np.repeat(part, own) * self.times[leaf])
        for node, a, b in self.graph.sums:
            np.add(sums[a], sums[b], out=sums[node])
        scores = np.zeros((len(self.graph.items), len(lengths)), np.int64)
        for i, nodes in enumerate(self.graph.items):
            for node in nodes:
                scores[i] += sums[node]
        return scores

    def add(self, ids: np.ndarray, nameless: np.ndarray, scores: np.ndarray) -> None:
        """Highest score first, equal ones by id, those without an id last."""
        least = np.array([s[-1] if len(s) == self.top else 1 for s, _, _ in self.best], np.int64)
        better = scores >= least[:, None]
        for i in np.flatnonzero(better.any(axis=1)):
            new = np.flatnonzero(better[i])
            all_ = [np.concatenate(x) for x in zip(self.best[i], (scores[i, new], ids[new], nameless[new]))]
            first = np.lexsort((all_[1], all_[2], -all_[0]))[: self.top]
            self.best[i] = tuple(x[first] for x in all_)


def _best(shared) -> Callable:
    kinds = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        step = max(1, CELLS // max(1, scorer.graph.size))
        for batch in batches:
            for lo in range(0, len(batch), step):
                part = batch.slice(lo, step)
                found, tfs = part.column("terms"), part.column("tfs")
                ends = found.offsets.to_numpy().astype(np.int64)
                flat = lambda x: x.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                scores = scorer.scores(part.column("n").to_numpy().astype(np.int64), ends - ends[0], flat(found), flat(tfs))
                doc = part.column("doc_id")
                scorer.add(doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), scores)
        for i, (score, doc, nameless) in enumerate(scorer.best):
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(score), pa.int32()), pa.array(doc, pa.int64(), mask=nameless), pa.array(score, pa.int64())], schema=kinds)

    return run


def _blocks(items: DataFrame, size: int, seed: int) -> Iterable[DataFrame]:
    """Items in blocks of about `size` bytes of text, by a hash of the id."""
    count = max(1, -(-(items.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0) // size))
    where = F.pmod(F.xxhash64(F.lit(seed), "item_id"), F.lit(count))
    return [items.where(where == i) for i in range(count)]


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, vocabulary_bytes: int = VOCABULARY_BYTES, graph_bytes: int = GRAPH_BYTES) -> DataFrame:
    """`item_id`, `rank`, `doc_id`, `score`: for each item its `top` documents with the highest score above 0.

    `docs` has `doc_id`, `text`; `items` has `item_id`, `text`. Every row of `docs` is a document, whole texts count, also
    those that repeat; one without an id comes after others of equal score. Equal scores go by id. Null and
    empty texts have no terms and do not count. An item that repeats counts once; different texts
    of one item id are one item with the terms of all of them. Items without a hit have no rows.

    Items are a query set: their terms are searched for in scans of the documents, one for each `vocabulary_bytes` of item texts,
    and what is broadcast is bounded by that; a graph is mined for each `graph_bytes` of them.
    """
    spark = docs.sparkSession
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    whole = durable(texts.groupBy("item_id").agg(F.array_join(F.sort_array(F.collect_list("text")), " ").alias("text")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = []
    for group in _blocks(whole, vocabulary_bytes, 0):
        blocks = [[(r.item_id, Counter(terms(r.text.encode()))) for r in block.collect()] for block in _blocks(group, graph_bytes, 1)]
        vocabulary = {t: i for i, t in enumerate(sorted({t for block in blocks for _, own in block for t in own}))}
        index = durable(rows.mapInArrow(_counted(spark.sparkContext.broadcast(vocabulary)), INDEX))
        n, length = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.full(len(vocabulary), weight(n, 0), np.int64)
        for term, df in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect():  # as many rows as items have terms
            weights[term] = weight(n, df)
        for block in blocks:
            graph = mine([Counter({vocabulary[t]: k for t, k in own.items()}) for _, own in block])
            shared = spark.sparkContext.broadcast((graph, weights, n, length, top))
            names = _named([i for i, _ in block])
            found.append(index.mapInArrow(_best(shared), BEST).withColumn("item_id", names[F.col("item")]))
    best = found[0]
    for part in found[1:]:
        best = best.union(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _named(ids: Sequence[int | None]) -> Column:
    """Array of the ids of a graph's items."""
    return F.from_json(F.lit("[" + ",".join("null" if i is None else str(i) for i in ids) + "]"), "array<bigint>")
