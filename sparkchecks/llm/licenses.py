"""License statements in texts: winnowed fingerprints, an inverted index, banded alignment.

Words (runs of letters and digits, A-Z lower-cased) of each template are hashed in runs of up to
``RUN``; of up to ``WINDOW`` neighbouring hashes the smallest is kept (winnowing), and an inverted
index maps it to its templates and places. Both are chosen per template such that every statement
that is to be reported keeps a fingerprint; short templates are indexed by single words. A text's
runs are looked up in the index; hits with enough words of their template around them count. Hits of one
template whose implied beginnings lie within ``BAND`` words are one candidate. It is aligned with
the template inside a band around that beginning (match 2, mismatch or gap -1), which gives matched
coverage and span. Of overlapping matches the one with more matched words is kept, and the words
before and behind it are aligned again, so repeats at any distance are found.

A statement is reported if at least ``MIN_COVERAGE`` of its words match. With a band of
``BAND`` words, up to that many words may be inserted or missing.

Defined cases: NULL and empty texts have no matches and give no rows; a template that occurs
several times gives a row for each place; repeated rows give repeated results; whole texts are
scanned. The templates are a parameter (name to text) and small enough to go with each task.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import NOT_ALNUM, U, Words, chunks, shingles, words

RUN, WINDOW = 3, 2
BAND = 6
MIN_COVERAGE = 0.8

# Wording of common license statements.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit": "Released under the MIT License",
    "mit-text": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope "
        "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "all-rights-reserved": "All rights reserved",
}


def winnow(hashes: np.ndarray, window: int = WINDOW) -> list[int]:
    """Places of the smallest hash (the last of equals) of each window; all of a short list."""
    if len(hashes) <= window:
        return list(range(len(hashes)))
    kept: list[int] = []
    for i in range(len(hashes) - window + 1):
        part = hashes[i : i + window]
        at = i + window - 1 - int(part[::-1].argmin())
        if not kept or kept[-1] != at:
            kept.append(at)
    return kept


def run_and_window(size: int, least: float) -> tuple[int, int]:
    """Longest run and window of which a reported alignment keeps a fingerprint.

    Words that don't match and up to ``BAND`` inserted ones cut what matches into pieces; the
    longest of them holds a window of runs.
    """
    matched = needed(size, least)
    whole = -(-matched // (size - matched + BAND + 1))
    run = min(RUN, max(1, whole - WINDOW + 1))
    return run, min(WINDOW, whole - run + 1)


def needed(size: int, least: float) -> int:
    """Matched words that a template of that size needs to be reported."""
    return max(1, math.ceil(least * size))


class Index:
    """Words of each template and the inverted indexes of their fingerprints, one for each length of runs."""

    def __init__(self, templates: Mapping[str, str], least: float = MIN_COVERAGE) -> None:
        self.names = list(templates)
        self.least = least
        held: dict = {}
        self.words = []
        places: dict[int, list[tuple[int, int, int]]] = {}
        for t, name in enumerate(self.names):
            data = np.frombuffer(templates[name].encode(), np.uint8)
            w = words(data, np.array([0, len(data)]), held, NOT_ALNUM)
            if not len(w.hash):
                raise ValueError(f"template {name} has no words")
            self.words.append(w.hash)
            run, window = run_and_window(len(w.hash), least)
            value, _ = shingles(w, run, short_as_one=False)
            places.setdefault(run, []).extend((int(value[i]), t, i) for i in winnow(value, window))
        #: Hashes (sorted), templates and places by length of runs.
        self.runs = {}
        for run, found in places.items():
            found.sort()
            self.runs[run] = (np.array([p[0] for p in found], U), np.array([p[1] for p in found]), np.array([p[2] for p in found]))
        self.vocabulary = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, U)
        self.counts = [np.bincount(np.searchsorted(self.vocabulary, x), minlength=len(self.vocabulary) + 1) for x in self.words]

    def candidates(self, w: Words) -> dict[int, list[tuple[int, int]]]:
        """By document of a chunk: template and implied beginning (a word number) of each group of hits.

        Hits whose band holds too few words of the template to be reported are left out.
        """
        bounds = np.searchsorted(w.doc, np.arange(w.n_docs + 1))
        own = np.full(len(w.hash), len(self.vocabulary))
        if len(self.vocabulary):
            at = np.minimum(np.searchsorted(self.vocabulary, w.hash), len(self.vocabulary) - 1)
            own = np.where(self.vocabulary[at] == w.hash, at, own)
        out: dict[int, list[tuple[int, int]]] = {}
        for run, (hashes, template, place) in self.runs.items():
            value, doc = shingles(w, run, short_as_one=False)
            left, right = np.searchsorted(hashes, value, "left"), np.searchsorted(hashes, value, "right")
            hit = np.flatnonzero(right > left)
            n = (right - left)[hit]
            entry = np.repeat(left[hit] - np.cumsum(n) + n, n) + np.arange(n.sum())
            hit = np.repeat(hit, n)
            # Word number of each hit in the chunk, from its number among the runs of its document.
            begin = hit - np.searchsorted(doc, doc[hit]) + bounds[doc[hit]] - place[entry]
            for t in np.unique(template[entry]):
                of = template[entry] == t
                begins, docs = begin[of], doc[hit[of]]
                size, least = len(self.words[t]), needed(len(self.words[t]), self.least)
                low, high = np.maximum(begins - BAND, bounds[docs]), np.minimum(begins + size + BAND, bounds[docs + 1])
                sums = np.concatenate([[0], np.cumsum(self.counts[t][own] > 0)])
                enough = sums[high] - sums[low] >= least
                found = np.unique(np.stack([docs[enough], begins[enough]], axis=1), axis=0)
                last, first = -1, 0
                for d, x in found.tolist():
                    # A group spans at most BAND words, so the band around its beginning reaches as far around each hit.
                    if d == last and x - first <= BAND:
                        continue
                    last, first = d, x
                    near = own[max(x - BAND, bounds[d]) : min(x + size + 2 * BAND, bounds[d + 1])]
                    if np.minimum(np.bincount(near, minlength=len(self.vocabulary) + 1), self.counts[t]).sum() >= least:
                        out.setdefault(d, []).append((int(t), int(x - bounds[d])))
        return out


def align(template: np.ndarray, text: np.ndarray, begin: int, band: int = BAND, low: int = 0, high: int | None = None) -> tuple[int, int, int]:
    """Matched words, first and end word of the best local alignment within the band and the words from low to high."""
    high = len(text) if high is None else high
    zero = (0, 0, 0, 0)  # score, matched, first, end
    above: dict[int, tuple[int, int, int, int]] = {}
    best = zero
    for i, word in enumerate(template):
        row: dict[int, tuple[int, int, int, int]] = {}
        for j in range(max(low, begin + i - band), min(high, begin + i + 2 * band + 1)):
            score, matched, first, end = above.get(j - 1, zero)
            if text[j] == word:
                cell = (score + 2, matched + 1, first if matched else j, j + 1)
            else:
                cell = (score - 1, matched, first, end)
            for score, matched, first, end in (above.get(j, zero), row.get(j - 1, zero)):
                if score - 1 > cell[0]:
                    cell = (score - 1, matched, first, end)
            if cell[0] > 0:
                row[j] = cell
                if (cell[1], cell[0]) > (best[1], best[0]):
                    best = cell
        above = row
    return best[1:]


def matches(index: Index, hashes: np.ndarray, candidates: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """Template, matched words, first and end word of what is reported for one text."""
    heap: list[tuple] = []
    firsts: list[int] = []  # sorted first words of the reported spans
    kept: dict[int, tuple[int, int, int, int]] = {}

    def seek(t: int, begin: int, low: int, high: int) -> None:
        size = len(index.words[t])
        if high - low >= needed(size, index.least):
            matched, first, end = align(index.words[t], hashes, begin, low=low, high=high)
            if matched >= needed(size, index.least):
                heappush(heap, (-matched, -matched / size, first, t, end, begin, low, high))

    for t, begin in candidates:
        seek(t, begin, max(0, begin - BAND), min(len(hashes), begin + len(index.words[t]) + 2 * BAND))
    while heap:
        less, _, first, t, end, begin, low, high = heappop(heap)
        at = bisect_left(firsts, end) - 1
        if at < 0 or kept[firsts[at]][3] <= first:
            insort(firsts, first)
            kept[first] = (t, -less, first, end)
        # What is left of these words, between the reported spans, is searched again.
        at = max(bisect_left(firsts, low) - 1, 0)
        while at < len(firsts) and firsts[at] < high:
            if kept[firsts[at]][3] > low:
                seek(t, begin, low, firsts[at])
                low = kept[firsts[at]][3]
            at += 1
        seek(t, begin, low, high)
    return [kept[x] for x in firsts]


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None, least: float = MIN_COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per statement: doc_id, license, coverage, matched, start_char, end_char (code points)."""
    templates = dict(templates or TEMPLATES)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, license string, coverage double, matched bigint, start_char bigint, end_char bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held = Index(templates, least), {}
        for batch in batches:
            for i, j, data, offs in chunks(batch.column(1)):
                w = words(data, offs, held, NOT_ALNUM)
                word_at = np.searchsorted(w.doc, np.arange(j - i + 1))
                rows, out = [], []
                for d, candidates in sorted(index.candidates(w).items()):
                    own = slice(word_at[d], word_at[d + 1])
                    for t, matched, first, end in matches(index, w.hash[own], candidates):
                        span = [offs[d], w.start[own][first], w.end[own][end - 1]]
                        chars = [int(((data[x:y] & 0xC0) != 0x80).sum()) for x, y in zip(span, span[1:], strict=False)]
                        rows.append(i + int(d))
                        out.append((index.names[t], matched / len(index.words[t]), matched, chars[0], sum(chars)))
                columns = list(zip(*out, strict=True)) if out else [[]] * 5
                kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                    names=["doc_id", "license", "coverage", "matched", "start_char", "end_char"],
                )

    return base.mapInArrow(run, schema)
