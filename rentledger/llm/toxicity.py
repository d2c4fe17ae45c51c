"""Toxicity by weak supervision.

1. Voters. Terms (whole words and word stems of a few letters) that are far commoner
   in toxic than in clean training texts are mined, and dealt into lexicons and
   stem patterns by kind and hash. Together with a fixed word list, the number of words that hit and
   patterns of form (shouting, marks, no hit at all) they vote toxic, clean or abstain.
2. Label model. A generative model of a hidden label y and the votes: each voter has
   its own accuracy given y, and may further depend on one other voter. The
   dependencies are the maximum spanning tree over the conditional mutual information
   of voters given y, kept where it is above a floor. It is fitted by expectation
   maximisation, and its posterior is the label of a training text. The label that
   people gave is one more voter there, whose accuracy is estimated like the others'.
3. Classifier. A logistic regression on the terms and voters is fitted to the posteriors
   and is all that scoring needs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from rentledger.llm.common import fold, held_out
from rentledger.sources.shared import durable

SAMPLE = 20_000  # labelled rows that the model is fitted on, at most, chosen by a hash of the id
TERMS = 2_000  # size of the model: terms that are kept, by strength
STEMS = (3, 4, 5, 6, 7, 8)  # letters of the stems that are mined
SEVERAL = 2  # words with hits from which a text is voted toxic; one alone may be chance
SUPPORT, LIFT = 5, 20.0  # toxic texts a term must be in, and how many times commoner it must be there
CHANCE = 0.01  # terms of that kind to be expected if all stood in toxic texts by chance
LEXICONS = 4  # voters that the mined words, and as many that the stems, are dealt into
ROUNDS, DEPENDENT = 50, 0.01  # of EM; conditional mutual information from which voters depend on each other
GIVEN = 0.95  # accuracy that people's labels are taken to have beforehand
TOXIC, CLEAN, ABSTAIN = 1, 0, 2
WORD = re.compile(r"[^\W\d_]+")
# Common insults in English.
INSULTS = frozenset("clown disgusting dumb fool garbage idiot jerk loser moron pathetic scum stupid trash ugly worthless".split())


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def terms_of(text: str | None) -> set[str]:
    """Words, and stems marked by a star, that occur in a text."""
    own = words(text)
    return own | {w[:n] + "*" for w in own for n in STEMS if len(w) > n}


def _shape(text: str | None) -> list[int]:
    """Votes of the patterns of form: shouting, exclamation marks."""
    text = text or ""
    signs = Counter(text)
    letters, upper = (sum(n for sign, n in signs.items() if kind(sign)) for kind in (str.isalpha, str.isupper))
    return [
        TOXIC if letters >= 20 and 2 * upper > letters else ABSTAIN,
        TOXIC if signs["!"] * 50 > len(text) > 0 else ABSTAIN,
    ]


@dataclass
class Model:
    terms: dict[str, int] = field(default_factory=dict)  # mined term to weight index
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    voters: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -2.0

    def voter_of(self, term: str) -> int:
        return crc32(term.encode()) % LEXICONS + (LEXICONS if term.endswith("*") else 0)

    @cached_property
    def heads(self) -> frozenset[str]:
        """First letters of all terms; a word that begins otherwise cannot hit."""
        return frozenset(t.rstrip("*")[: min(STEMS)] for t in self.terms)

    def hits(self, text: str | None) -> tuple[list[str], int, bool]:
        """The terms that occur, the number of words with any, and whether a word is in the fixed list."""
        found, several, heads, head, all_words = set(), 0, self.heads, min(STEMS), words(text)
        for word in all_words:
            if word[:head] not in heads:
                continue
            own = [t for t in (word, *(word[:n] + "*" for n in STEMS if len(word) > n)) if t in self.terms]
            found.update(own)
            several += bool(own)
        return sorted(found), several, not INSULTS.isdisjoint(all_words)

    def votes(self, text: str | None, hits: list[str], several: int, listed: bool) -> list[int]:
        """Lexicons, stem patterns, the fixed list, number of words, forms; the last votes clean where no term hits."""
        cast = [ABSTAIN] * (2 * LEXICONS)
        for term in hits:
            cast[self.voter_of(term)] = TOXIC
        many = TOXIC if several >= SEVERAL else ABSTAIN
        return [*cast, TOXIC if listed else ABSTAIN, many, *_shape(text), ABSTAIN if hits or listed else CLEAN]

    def score(self, text: str | None) -> float:
        hits, several, listed = self.hits(text)
        sum_ = self.bias + sum(self.weights[self.terms[t]] for t in hits)
        if len(self.voters):
            sum_ += float(_signs(np.array(self.votes(text, hits, several, listed))) @ self.voters)
        elif listed:
            sum_ += 4.0
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum_))))


def _signs(votes: np.ndarray) -> np.ndarray:
    return np.where(votes == TOXIC, 1.0, np.where(votes == CLEAN, -1.0, 0.0))


class LabelModel:
    """Hidden label, and votes whose tables are P(vote | label, vote of the parent). The last voter is people's label."""

    def __init__(self, votes: np.ndarray, prior: float) -> None:
        patterns, self.inverse, self.counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
        self.patterns, self.prior = patterns, min(0.9, max(0.01, prior))
        self.parents = [-1] * votes.shape[1]
        self.posterior = np.where(patterns[:, -1] == TOXIC, 0.9, 0.05)  # the last voter starts it

    def _table(self, voter: int) -> np.ndarray:
        """Smoothed counts [label, parent's vote, vote], as probabilities."""
        parent = self.parents[voter]
        above = self.patterns[:, parent] if parent >= 0 else np.zeros(len(self.patterns), int)
        table = np.full((2, 3, 3), 0.1)
        for label, share in ((1, self.posterior), (0, 1 - self.posterior)):
            np.add.at(table[label], (above, self.patterns[:, voter]), share * self.counts)
            if voter == len(self.parents) - 1:  # what people say is believed beforehand, so that y keeps meaning toxic
                mass = float((share * self.counts).sum())
                table[label, 0, label] += GIVEN * mass
                table[label, 0, 1 - label] += (1 - GIVEN) * mass
        return table / table.sum(axis=2, keepdims=True)

    def _step(self) -> float:
        log = np.log([1 - self.prior, self.prior])[:, None] + np.zeros((2, len(self.patterns)))
        for voter, parent in enumerate(self.parents):
            table = self._table(voter)
            above = self.patterns[:, parent] if parent >= 0 else np.zeros(len(self.patterns), int)
            log += np.log(table[:, above, self.patterns[:, voter]])
        now = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        moved = float(np.abs(now - self.posterior).max(initial=0))
        self.posterior = now
        return moved

    def _information(self, a: int, b: int) -> float:
        """Conditional mutual information of two voters given the label."""
        found = 0.0
        total = self.counts.sum()
        for share in (self.posterior, 1 - self.posterior):
            joint = np.zeros((3, 3))
            np.add.at(joint, (self.patterns[:, a], self.patterns[:, b]), share * self.counts)
            mass = joint.sum()
            if mass > 0:
                p = joint / mass
                apart = p.sum(axis=1, keepdims=True) * p.sum(axis=0, keepdims=True)
                some = p > 0
                found += mass / total * float((p[some] * np.log(p[some] / apart[some])).sum())
        return found

    def _correlate(self) -> None:
        """A forest of the strongest dependencies; each voter hangs on at most one other."""
        count = self.patterns.shape[1] - 1  # people's label depends on nothing else
        links = sorted(((self._information(a, b), a, b) for a in range(count) for b in range(a)), reverse=True)
        group, near = list(range(count)), {v: [] for v in range(count)}
        for value, a, b in links:
            if value >= DEPENDENT and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
                near[a].append(b)
                near[b].append(a)
        self.parents, seen = [-1] * (count + 1), set()
        for root in range(count):
            stack = [(root, -1)]
            while stack:
                voter, above = stack.pop()
                if voter not in seen:
                    seen.add(voter)
                    self.parents[voter] = above
                    stack += [(x, voter) for x in near[voter]]

    def fit(self) -> np.ndarray:
        for _ in range(2):  # dependencies first: voters that copy one another would else pass for the label
            self._correlate()
            for _ in range(ROUNDS):
                if self._step() < 1e-4:
                    break
        return self.posterior[self.inverse]


def _regress(rows: list[list[int]], votes: np.ndarray, labels: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient steps with a small ridge."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.array([c for r in rows for c in r], dtype=np.int64)
    signs = _signs(votes)
    size = max(1, max((len(r) for r in rows), default=1)) + signs.shape[1] + 1
    w, v, b = np.zeros(terms), np.zeros(signs.shape[1]), 0.0
    last, rate = (w, v, b), 8.0 / size
    for step in range(400):
        push = step / (step + 3)
        at = tuple(x + push * (x - y) for x, y in zip((w, v, b), last))
        last = (w, v, b)
        z = at[2] + np.bincount(row, at[0][column], len(rows)) + signs @ at[1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / len(rows)
        w = at[0] - rate * len(rows) ** 0.5 / 4 * (np.bincount(column, error[row], terms) + 1e-5 * at[0])
        v = at[1] - rate * (signs.T @ error + 1e-5 * at[1])
        b = at[2] - rate * error.sum()
    return w, v, float(b)


def _mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = (Counter(), Counter())
        for text, toxic in zip(batch.column("text"), batch.column("toxic")):
            both[toxic.as_py()].update(terms_of(text.as_py()))
        terms = list(both[0] | both[1])
        columns = [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in (both[1], both[0]))]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "toxic", "clean"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` labelled rows outside the held-out fold.

    Rows with a null id or label are not used; an id labelled twice counts once, toxic if any of its labels is, with the
    first of its texts in order if it has several; so do equal texts with one label. Without
    labelled rows of both kinds only the fixed word list scores.

    A term is mined if it is in `SUPPORT` toxic texts, `LIFT` times commoner there than in clean ones, and if that is no chance: the
    bound does not ask for more texts as the sample grows, but for more the more terms are tried. The strongest `TERMS` are kept.
    """
    marks = (
        labels.where((fold(F.col("doc_id")) != 0) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("mark", F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53))
    )
    marked = docs.select("doc_id", "text").join(F.broadcast(_bounded(marks, sample)), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = durable(marked.select("text", "toxic").distinct())
    size = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        return Model()
    counted = rows.select("text", "toxic").mapInArrow(_mine, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = durable(counted)
    lift = (F.col("toxic") / size[1]) / ((F.col("clean") + 0.5) / size[0])
    strength = lift * F.log1p("toxic")
    # Chernoff's bound on so many of a term's texts being toxic by chance, for as many terms as are often enough to be asked
    base, n = size[1] / (size[0] + size[1]), F.col("toxic") + F.col("clean")
    share = F.col("toxic") / n
    surprise = n * (share * F.log(share / base) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0))
    asked = counted.where(F.col("toxic") >= SUPPORT)
    least = math.log(max(1, asked.count()) / CHANCE)
    mined = asked.where((lift >= LIFT) & (surprise >= least)).orderBy(F.desc(strength), "term").limit(TERMS)
    terms = {r.term: i for i, r in enumerate(mined.collect())}
    model = Model(terms, np.zeros(len(terms)))

    found = rows.select("text", "toxic").mapInArrow(_hit(docs.sparkSession.sparkContext.broadcast(model)), "hits array<int>, votes array<int>, toxic int").collect()
    votes = np.array([r.votes for r in found])
    given = np.array([TOXIC if r.toxic else CLEAN for r in found])
    posterior = LabelModel(np.column_stack([votes, given]), size[1] / (size[0] + size[1])).fit()
    model.weights, model.voters, model.bias = _regress([list(r.hits) for r in found], votes, posterior, len(terms))
    return model


def _bounded(marks: DataFrame, sample: int) -> DataFrame:
    """At most `sample` ids, by the smallest hashes; the bound is what makes it fit for a broadcast."""
    return marks.orderBy("mark", "doc_id").limit(sample).select("doc_id", "toxic")


def _hit(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            hits = [model.hits(t) for t in texts]
            columns = [[sorted(model.terms[x] for x in h) for h, *_ in hits], [model.votes(t, *h) for t, h in zip(texts, hits)]]
            made = [pa.array(c, pa.list_(pa.int32())) for c in columns]
            yield pa.RecordBatch.from_arrays([*made, batch.column("toxic")], names=["hits", "votes", "toxic"])

    return run


def scorer(docs: DataFrame, model: Model) -> Callable[[Column], Column]:
    """A column function that scores whole texts, null and empty ones too, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by TERMS

    @F.arrow_udf(DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([shared.value.score(t.as_py()) for t in batch], pa.float64())

    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` of every row; the score depends on the text alone."""
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scorer(docs, model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that score below one half; columns as in `docs`."""
    return docs.where(scorer(docs, model)(F.col("text")) < 0.5)
