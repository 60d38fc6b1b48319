"""Operator 8 - licence scan by Dice coefficients of word bigrams.

Texts and templates are normalised to words; a text's passage resembles a template if
the Dice coefficient of their distinct word bigrams is at least ``THRESHOLD``.  That bounds
sizes: a passage of n bigrams can only reach templates with n * T / (2 - T) to n * (2 - T) / T
bigrams, so a text too short for a template never meets it.  A passage begins and ends at
a bigram of the template (other ends only lower the coefficient) and may have any length up
to the upper bound, plus the bigrams that the template itself repeats; for each beginning with enough
bigrams of the template after it, the coefficients of all ends are computed exactly.  The whole
text is compared too, under the same bounds.  Of passages that overlap the best stays.

Defined results
    null, empty or one-word text: no licence; null ``doc_id``: reported as null; ties: the
    earlier passage, then the earlier template, of one beginning the length nearest to the template's; equal rows: each reported; an empty table
    gives no row; very long texts: every passage of theirs; other columns are not read.
"""

from __future__ import annotations

import heapq
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kestrel.llm.common import batches, doc_texts
from kestrel.llm.words import shingles, words_of

THRESHOLD = 0.8

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software.")
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_GPL_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as "
    "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version. This program "
    "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} for more details.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_3 = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.")
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."

#: (licence, text): fixed values, the public wording of notices and short licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT_GRANT), ("MIT", _MIT_WARRANTY), ("MIT", _MIT_GRANT + " " + _MIT_WARRANTY),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", _BSD), ("BSD-3-Clause", _BSD + _BSD_3),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
             "purpose, including commercial applications, and to alter it and redistribute it freely."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                   "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
                   "the specific language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", _GPL_NOTICE.format("General Public License", 3, "General Public License")),
    ("GPL-2.0", _GPL_NOTICE.format("General Public License", 2, "General Public License")),
    ("LGPL-3.0", _GPL_NOTICE.format("Lesser General Public License", 3, "Lesser General Public License")),
    ("AGPL-3.0", _GPL_NOTICE.format("Affero General Public License", 3, "Affero General Public License")),
    ("CC-BY-4.0", _CC.format("Attribution")), ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike")),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial")), ("CC-BY-ND-4.0", _CC.format("Attribution-NoDerivatives")),
    ("CC-BY-NC-SA-4.0", _CC.format("Attribution-NonCommercial-ShareAlike")),
    ("CC-BY-NC-ND-4.0", _CC.format("Attribution-NonCommercial-NoDerivatives")),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."), ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("proprietary", "All rights reserved."),
)
FOUND = "doc_id long, license string, dice double, first_word int, n_words int, whole_text boolean"


class Templates:
    """Bigrams of all templates, and of each bigram the templates that hold it.

    ``every_length``: passages of all lengths within the bounds, else only as long as the template.
    """

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD, every_length: bool = False):
        self.threshold, self.every_length = threshold, every_length
        self.names = [name for name, _ in templates]
        words = [words_of(text) for _, text in templates]
        if min(map(len, words)) < 2:
            raise ValueError("a template needs two words")
        self.words = [len(w) for w in words]
        self.sets = [np.unique(shingles(w, 2)) for w in words]
        self.sizes = [len(s) for s in self.sets]
        self.bigrams = np.unique(np.concatenate(self.sets))
        holds = np.array([np.isin(self.bigrams, s) for s in self.sets])
        self.holders = [np.flatnonzero(c).tolist() for c in holds.T]

    def dice(self, h: np.ndarray, t: int) -> float:
        own = np.unique(h)
        return 2.0 * len(np.intersect1d(own, self.sets[t], assume_unique=True)) / (len(own) + self.sizes[t])

    def scan(self, h: np.ndarray, at: np.ndarray, number: np.ndarray) -> list[tuple]:
        """(dice, first word, words, template, whole) of passages of a text.

        ``h``: the text's bigrams, ``at``: the places of those that some
        template holds, ``number``: their numbers among ``bigrams``.
        """
        places: dict[int, list[int]] = {}
        for p, b in zip(at.tolist(), number.tolist()):
            for t in self.holders[b]:
                places.setdefault(t, []).append(p)
        found, n, distinct, passages = [], len(h), None, {}
        for t, own in places.items():
            least = self.sizes[t] * self.threshold / (2 - self.threshold)  # fewest bigrams of a passage, and shared ones
            if n < least or len(own) < least:
                continue
            own, length = np.array(own), self.words[t] - 1
            if self.every_length:
                length += int(self.sizes[t] * (2 - self.threshold) / self.threshold + 1e-9) - self.sizes[t]
            inside = np.searchsorted(own, own + length) - np.arange(len(own))
            starts = own[inside >= least].tolist()
            if self.every_length and starts:
                passages[t] = _Passages(h, own, self.sizes[t], self.words[t] - 1, length)
                for p in starts:
                    score, m = passages[t].best(p, n)
                    if score >= self.threshold:
                        found.append((score, p, m + 1, t, False))
                starts = []
            for p in starts:
                score = self.dice(h[p:p + length], t)
                if score >= self.threshold:
                    found.append((score, p, min(length, n - p) + 1, t, False))
            if distinct is None:
                distinct = len(np.unique(h))
            if least <= distinct <= self.sizes[t] * (2 - self.threshold) / self.threshold:
                score = self.dice(h, t)
                if score >= self.threshold:
                    found.append((score, 0, n + 1, t, True))
        # the best first; a passage that overlaps a better one goes
        kept: list[tuple] = []
        starts: list[int] = []
        queue = [((-x[0], x[4], x[1], x[3]), x) for x in found]
        heapq.heapify(queue)
        while queue:
            _, x = heapq.heappop(queue)
            i = bisect(starts, x[1])
            if i and kept[i - 1][1] + kept[i - 1][2] > x[1]:
                continue
            if i == len(kept) or x[1] + x[2] <= starts[i]:
                kept.insert(i, x)
                starts.insert(i, x[1])
            elif not x[4] and x[3] in passages:
                # the best passage from here that ends before the better one
                score, m = passages[x[3]].best(x[1], starts[i] - 1)
                if score >= self.threshold:
                    heapq.heappush(queue, ((-score, False, x[1], x[3]), (score, x[1], m + 1, x[3], False)))
        return kept


class _Passages:
    """Coefficients of the passages of a text (bigrams ``h``) with a template that holds those at ``own``."""

    def __init__(self, h: np.ndarray, own: np.ndarray, size: int, usual: int, longest: int):
        order = np.argsort(h, kind="stable")
        self.before = np.full(len(h), -1)  # where a place's bigram was last seen
        again = h[order[1:]] == h[order[:-1]]
        self.before[order[1:][again]] = order[:-1][again]
        self.held = np.zeros(len(h), bool)
        self.held[own] = True
        self.size, self.usual, self.longest = size, usual, longest

    def best(self, p: int, end: int) -> tuple[float, int]:
        """(coefficient, bigrams) of the best passage from ``p`` that ends before bigram ``end``; (0, 0): none."""
        end = min(end, p + self.longest)
        if end <= p:
            return 0.0, 0
        held, new = self.held[p:end], self.before[p:end] < p
        ends = np.flatnonzero(held)
        if not len(ends):
            return 0.0, 0
        score = 2.0 * np.cumsum(held & new)[ends] / (np.cumsum(new)[ends] + self.size)
        top = ends[score == score.max()] + 1
        return float(score.max()), int(top[np.argmin(np.abs(top - self.usual))])


def _scan(templates: Templates):
    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 1000, chars=8 << 20):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                if len(words) < 2:
                    continue
                h = shingles(words, 2)
                number = np.minimum(np.searchsorted(templates.bigrams, h), len(templates.bigrams) - 1)
                at = np.flatnonzero(templates.bigrams[number] == h)
                if len(at):
                    rows += [(doc_id, templates.names[t], score, p, n, whole)
                             for score, p, n, t, whole in templates.scan(h, at, number[at])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (
                    pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.bool_()))],
                    ["doc_id", "license", "dice", "first_word", "n_words", "whole_text"])
    return scan


def find_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, first_word, n_words, whole_text): the licence passages of every text.

    The templates are a fixed list (some kilobytes) that goes with the task.
    """
    return doc_texts(docs).mapInArrow(_scan(Templates(templates, threshold, every_length=True)), FOUND)


def op8_dice_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
