"""License scans: winnowed fingerprints pick templates and places, banded alignment measures and locates them.

A template's runs of words are hashed and winnowed: of every few runs in a row the least hash is kept. An
inverted index leads from a kept hash to the templates and places it comes from. A text is winnowed
alike, so a passage that shares enough words in a row with a template has a kept hash in common with it.
Around the diagonals that these name the template is aligned with the text, within a band of
insertions and deletions, which gives the matched share and the span.

How long the runs are, and how many of them are looked at together, follows from each template's length. A passage that
matches the least share with no more edits than words may be missing has an unbroken run of some words
somewhere, and winnowing keeps a hash of every run as long as that. Short notices so keep all their pairs of words.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 3  # words of a run at most
LEAST_WORDS = 3  # of a template
BAND = 8  # words that may be added or missing
COVERAGE = 0.8  # share of a template's words that must be matched in order
WORD = re.compile(r"\w+")
FOUND = "doc_id long, license string, coverage double, start_word int, end_word int, start_char int, end_char int, matched string"

# Notices, opening passages and whole texts of public licenses, by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "MIT-whole": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC-whole": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
        "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def sampling(words: int, coverage: float) -> tuple[int, int]:
    """Words in a run, and runs in a window, for a template of so many words.

    If `need` words must match and one edit may take the place of each other, the edits part the
    matched words to runs of which the longest has at least need / (edits + 1).
    """
    need = math.ceil(coverage * words - 1e-9)
    run = -(-need // (words - need + 1))
    gram = min(GRAM, run)
    return gram, run - gram + 1


def _grams(hashes: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all runs of `gram` words."""
    mixed = np.zeros(max(0, len(hashes) - gram + 1), dtype=np.uint64)
    for i in range(gram):
        mixed = (mixed ^ hashes[i : i + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of the runs that are kept: the rightmost least one of each window, all of fewer runs than a window."""
    if len(grams) <= window or window == 1:
        return np.arange(len(grams))
    if window == 2:
        right = grams[1:] <= grams[:-1]
        kept = np.zeros(len(grams), bool)
        kept[1:] |= right
        kept[:-1] |= ~right
        return np.flatnonzero(kept)
    windows = np.lib.stride_tricks.sliding_window_view(grams, window)
    least = window - 1 - windows[:, ::-1].argmin(axis=1)
    return np.unique(np.arange(len(windows)) + least)


def align(template: list[str], text: list[str], at: int, band: int = BAND, low: int = 0, high: int | None = None) -> tuple[int, int, int]:
    """Longest common subsequence of the template and text[low:high] near diagonal `at`: matches, first and last word of the text.

    Word i of the template meets words at + i - band to at + i + band only. Of equally good
    alignments the shortest span counts, then the one that begins nearest to the diagonal.
    """
    high = len(text) if high is None else high
    zero = (0, 0, 0, -1, -1)  # matches, minus the span, minus the distance of the beginning from the diagonal, first, last
    before: dict[int, tuple] = {}
    best = zero
    for i, word in enumerate(template):
        now: dict[int, tuple] = {}
        left = zero
        for j in range(max(low, at + i - band), min(high, at + i + band + 1)):
            up, corner = before.get(j, zero), before.get(j - 1, zero)
            one = max(left, up)
            if text[j] == word:
                first, off = (corner[3], corner[2]) if corner[0] else (j, -abs(j - at - i))
                one = max(one, (corner[0] + 1, first - j, off, first, j))
            now[j] = left = one
            best = max(best, one)
        before = now
    return best[0], best[3], best[4]


@dataclass(frozen=True)
class Scanner:
    names: list[str]
    words: list[list[str]]
    index: dict[tuple[int, int], dict[int, list[tuple[int, int]]]]  # by sampling: kept hash to template and place
    known: dict[tuple[int, int], np.ndarray]  # the kept hashes in order
    coverage: float

    @classmethod
    def build(cls, templates: Mapping[str, str], coverage: float = COVERAGE) -> Scanner:
        names = sorted(templates)
        own = [WORD.findall(templates[n].lower()) for n in names]
        index: dict = defaultdict(lambda: defaultdict(list))
        for number, words in enumerate(own):
            gram, window = sampling(len(words), coverage)
            grams = _grams(_hashes(words), gram)
            for i in winnow(grams, window).tolist():
                index[gram, window][int(grams[i])].append((number, i))
        known = {k: np.array(sorted(v), np.uint64) for k, v in index.items()}
        return cls(names, own, {k: dict(v) for k, v in index.items()}, known, coverage)

    def _least(self, number: int) -> int:
        return math.ceil(self.coverage * len(self.words[number]) - 1e-9)

    def candidates(self, words: list[str]) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """Template and diagonal, with the first and last word of the runs that both have there."""
        hashes, found = _hashes(words), defaultdict(list)
        for (gram, window), held in self.index.items():
            grams = _grams(hashes, gram)
            kept, known = winnow(grams, window), self.known[gram, window]
            own = grams[kept]
            met = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
            for j in kept[met].tolist():
                for number, i in held[int(grams[j])]:
                    if words[j : j + gram] == self.words[number][i : i + gram]:
                        found[number, j - i].append((j, j + gram - 1))
        return found

    def scan(self, text: str | None) -> list[tuple]:
        """`license, coverage, first and last word, first and last character, matched text` of each match in a text.

        The match with the most words is taken first, of equal ones the first template's, then the one that begins first. What lies
        across a taken match is aligned again in the words that are left beside it, so copies in a row are all found.
        """
        text = text or ""
        low = text.lower()
        words = WORD.findall(low) if len(low) == len(text) else [w.lower() for w in WORD.findall(text)]
        found = self.candidates(words)
        if not found:
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        queue: list[tuple] = []

        def put(number: int, at: int, runs: list[tuple[int, int]], low: int, high: int) -> None:
            own, least = self.words[number], self._least(number)
            near = Counter(words[max(low, at - BAND) : max(0, min(high, at + len(own) + BAND))])
            if sum(min(n, near[w]) for w, n in Counter(own).items()) < least:
                return  # not enough of its words are there in any order
            matches, first, end = align(own, words, at, low=low, high=high)
            if matches >= least:
                heapq.heappush(queue, (-matches, number, first, end, at, runs))

        for (number, at), runs in found.items():
            put(number, at, runs, 0, len(words))
        starts: list[int] = []
        taken: dict[int, tuple] = {}  # first word: last word, result
        while queue:
            matches, number, first, end, at, runs = heapq.heappop(queue)
            k = bisect_left(starts, end + 1)
            if not k or taken[starts[k - 1]][0] < first:
                low, high = spans[first][0], spans[end][1]
                insort(starts, first)
                taken[first] = end, (self.names[number], -matches / len(self.words[number]), first, end + 1, low, high, text[low:high])
                continue
            beside = defaultdict(list)  # runs by the words that are free around them
            for run in runs:
                k = bisect_left(starts, run[1] + 1)
                low = taken[starts[k - 1]][0] + 1 if k else 0
                if low <= run[0]:
                    beside[low, starts[k] if k < len(starts) else len(words)].append(run)
            for (low, high), own in beside.items():
                put(number, at, own, low, high)
        return [taken[first][1] for first in starts]


class _Words(dict):
    """Hashes of words, kept for the words that come first."""

    def __missing__(self, word: str) -> int:
        value = crc32(word.encode("utf-8", "replace"))
        if len(self) < 1 << 18:
            self[word] = value
        return value


_WORDS = _Words()


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def _scan(shared) -> Callable:
    kinds = pa.schema([
        ("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("start_word", pa.int32()),
        ("end_word", pa.int32()), ("start_char", pa.int32()), ("end_char", pa.int32()), ("matched", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc.as_py(), *hit)
                for doc, text in zip(batch.column("doc_id"), batch.column("text"))
                for hit in shared.value.scan(text.as_py())
            ]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, kinds)], schema=kinds)

    return run


def license_spans(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """`FOUND` rows: one for each passage of a text that holds at least `coverage` of a template's words in order.

    Whole texts are scanned, each row by itself; the templates are a parameter and bound what is
    broadcast. Words compare without regard to case and punctuation. Spans are half open, in words
    and in characters. Null and empty texts match nothing; rows that repeat match as often as
    they occur; templates of fewer than `LEAST_WORDS` words are refused.

    A passage is found if it holds an unbroken run of as many words as `sampling` says (two for notices of five words, four
    for long texts): so all with the least share are that have no more edits than words may be missing.
    """
    short = [n for n, t in templates.items() if len(WORD.findall(t)) < LEAST_WORDS]
    if short:
        raise ValueError(f"templates of fewer than {LEAST_WORDS} words: {short}")
    shared = docs.sparkSession.sparkContext.broadcast(Scanner.build(templates, coverage))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scan(shared), FOUND)
