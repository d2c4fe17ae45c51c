"""Token counts by a linear longest-match automaton.

Greedy word pieces take the longest vocabulary entry at the front of what is left of
a word. The automaton is the trie of the vocabulary with a failure link for each
node: where no child fits the next byte, the pieces that greedy matching would have
taken by then are popped and reading goes on at the node of what remains. Only the
number of popped pieces is kept with a link, so a word is counted in time linear
in its bytes and no piece is built.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
REMEMBERED = 200_000  # words whose count a task keeps at a time
ROOT, NONE = 0, -1


@dataclass(frozen=True)
class Automaton:
    """`steps[node * 256 + byte]` is the child; `link` and `popped` say what happens where there is none."""

    steps: dict[int, int]
    link: list[int]
    popped: list[int]

    @classmethod
    def build(cls, vocabulary: Iterable[bytes]) -> Automaton:
        """Children are met breadth first, so the links of shorter strings are there when they are needed."""
        steps: dict[int, int] = {}
        whole = [False]
        order: list[tuple[int, int, int]] = []  # parent, byte, node
        for piece in sorted({p for p in vocabulary if p}, key=len):
            node = ROOT
            for byte in piece:
                child = steps.get(node << 8 | byte)
                if child is None:
                    child = steps[node << 8 | byte] = len(whole)
                    whole.append(False)
                    order.append((node, byte, child))
                node = child
            whole[node] = True
        depth = [0] * len(whole)
        for parent, _, node in order:
            depth[node] = depth[parent] + 1
        link, popped = [NONE] * len(whole), [0] * len(whole)
        for parent, byte, node in sorted(order, key=lambda x: depth[x[2]]):
            if whole[node]:
                link[node], popped[node] = ROOT, 1
                continue
            at, count = link[parent], popped[parent]
            while at != NONE and at << 8 | byte not in steps:
                count += popped[at]
                at = link[at]
            if at != NONE:
                link[node], popped[node] = steps[at << 8 | byte], count
        return cls(steps, link, popped)

    def count(self, word: bytes) -> int:
        """Pieces of one word; a word that the vocabulary cannot spell is one unknown piece."""
        steps, link, popped = self.steps, self.link, self.popped
        node = count = 0
        for byte in word:
            child = steps.get(node << 8 | byte)
            while child is None:
                if link[node] == NONE:
                    return 1
                count += popped[node]
                node = link[node]
                child = steps.get(node << 8 | byte)
            node = child
        while node != ROOT:
            if link[node] == NONE:
                return 1
            count += popped[node]
            node = link[node]
        return count


def read_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> list[bytes]:
    """Entries of a rank file: a base64 piece and its rank on each line. Spark reads it, wherever it is; it is bounded by its kind."""
    lines = spark.read.text(path if "://" in path else f"file://{path}").where(F.length("value") > 0).collect()
    return [base64.b64decode(line.value.split(" ")[0]) for line in lines]


def _count(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = shared.value, {}
        for batch in batches:
            counted, tokens = [], []
            for text in batch.column("text").cast(pa.binary()):
                own = (text.as_py() or b"").split()
                total = 0
                for word in own:
                    many = known.get(word)
                    if many is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        many = known[word] = automaton.count(b" " + word)
                    total += many
                counted.append(len(own))
                tokens.append(total)
            columns = [batch.column("doc_id"), pa.array(counted, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: Iterable[bytes]) -> DataFrame:
    """`doc_id`, `n_words`, `n_tokens` of every row; whole texts, each row by itself.

    Words are runs of other than ASCII white space; a word is looked up with one space
    before it, as byte-level vocabularies mark beginnings. Null, empty and blank texts
    have no words and no tokens. Rows without doc_id are counted too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Automaton.build(vocabulary))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_count(shared), "doc_id long, n_words long, n_tokens long")
