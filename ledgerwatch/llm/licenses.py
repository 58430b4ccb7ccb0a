"""Licence notices in documents: MinHash bands over overlapping windows of the
text retrieve templates, exact shingle containment verifies them.

Templates fall into classes by their number of 5-word shingles, with powers of
two as bounds. For a class of at most n shingles, windows begin every n / 4
shingles and are 5 n / 4 long (for n up to 4 every shingle begins a window of
n), so a whole notice always lies in some window. A template of more than n / 2
shingles of which at least 80 % are in a window has Jaccard similarity of at
least 0.8 * (n/2) / (5/4 n + 0.2 * n/2) = 0.296 with it. With one row a band,
``BANDS`` bands meet with probability at least 1 - (1 - 0.296)**BANDS, that is
0.9999 for 27 bands.

Words are compared without ASCII punctuation at their ends, and what is nothing
but punctuation (comment marks, rules, bullets) is passed over, so a notice may
stand in a comment of any common kind. Templates that share most of their text
(a licence with one clause more, another version) would all be found in the
same place; there only the one with the most shingles found is reported.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textops import _IS_WORD, _LOWER, CHUNK, U64, buffers, prefix_sums, seeds, shingles, slices, span_hash, word_spans

WORDS = 5
CONTAINED = 0.8
ALIKE = 0.5              # share of the smaller template's shingles from which two templates compete for a place
MISS = 1e-4
LEAST_JACCARD = 0.4 / 1.35
BANDS = math.ceil(math.log(MISS) / math.log1p(-LEAST_JACCARD))

# Public licence notices as they are put into files.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission."),
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain "
        "worldwide. This software is distributed without any warranty."),
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. "
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    "LGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
}
_SOLID = _IS_WORD.copy()
_SOLID[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = False
SCHEMA = "doc_id long, license string, start_word int, end_word int, containment double"


def _minima(marks: np.ndarray) -> Iterator[np.ndarray]:
    """For each band, the hash values whose minimum over a set is its sketch."""
    for seed in seeds(BANDS, 707) | U64(1):
        yield ((marks * seed) >> U64(32)).astype(np.uint32)


def bare_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprints, place among the row's white-space separated words, words
    per row) of the words that are more than punctuation, without it at their ends."""
    start, end = word_spans(raw, offsets)
    solid = np.flatnonzero(_SOLID[raw])
    low, high = np.searchsorted(solid, start), np.searchsorted(solid, end)
    kept = np.flatnonzero(high > low)
    a, b = solid[low[kept]], solid[high[kept] - 1] + 1
    out, at = np.empty(len(kept), U64), 0
    while at < len(kept):                # in chunks cut between words
        base = a[at]
        to = max(at + 1, int(np.searchsorted(b, base + CHUNK, "right")))
        prefix = prefix_sums(_LOWER[raw[base: b[to - 1]]])
        out[at:to] = span_hash(prefix, a[at:to] - base, b[at:to] - base)
        at = to
    counts = np.diff(np.searchsorted(a, offsets))
    head = np.searchsorted(start, offsets[:-1])
    return out, kept - np.repeat(head, counts), counts


class Index:
    """The templates' sets and, per size class, their band keys."""

    def __init__(self, templates: dict[str, str], words: int = WORDS):
        names = sorted(templates)
        column = pa.array([templates[n] for n in names])
        raw, offsets = buffers(column)
        hashed, _, counts = bare_words(raw, offsets)
        marks, sizes = shingles(hashed, counts, words)
        ends = np.cumsum(sizes)
        self.words, self.sets, self.names = words, [], []
        for name, a, b in zip(names, ends - sizes, ends):
            if b > a:
                self.sets.append(np.unique(marks[a:b]))
                self.names.append(name)
        shared = [[len(np.intersect1d(x, y, True)) >= ALIKE * min(len(x), len(y)) for y in self.sets] for x in self.sets]
        self.rivals = [{j for j, alike in enumerate(line) if alike and j != i} for i, line in enumerate(shared)]
        self.classes: dict[int, list[int]] = {}
        for i, s in enumerate(self.sets):
            self.classes.setdefault(1 << (len(s) - 1).bit_length(), []).append(i)
        # band -> class -> (flags by the low 16 bits, key, template)
        self.keys = []
        hashes = [list(_minima(s)) for s in self.sets]
        for band in range(BANDS):
            by = {}
            for n, members in self.classes.items():
                key = np.array([hashes[i][band].min() for i in members], np.uint32)
                flags = np.zeros(1 << 16, bool)
                flags[key & 0xFFFF] = True
                by[n] = (flags, key, np.array(members))
            self.keys.append(by)

    def candidates(self, marks: np.ndarray, sizes: np.ndarray) -> set[tuple[int, int, int]]:
        """(template, first and end mark) of the windows that meet a template in a band."""
        found: set[tuple[int, int, int]] = set()
        first = np.cumsum(sizes) - sizes
        grids = {}
        for n in self.classes:
            step = max(1, n // 4)
            blocks = -(-sizes // step)
            begin = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            grids[n] = (step, n if n <= 4 else 5, np.repeat(first, blocks) + begin * step)
        for band, hashed in enumerate(_minima(marks)):
            for n, (step, wide, begin) in grids.items():
                least = hashed if step == 1 else np.minimum.reduceat(hashed, begin)
                window = least.copy()
                for j in range(1, wide):
                    np.minimum(window[:-j], least[j:], out=window[:-j])
                flags, key, members = self.keys[band][n]
                hit = np.flatnonzero(flags[window & 0xFFFF])
                for at in hit.tolist():
                    for i in members[key == window[at]].tolist():
                        found.add((i, int(begin[at]), int(begin[at]) + wide * step))
        return found

    def _beaten(self, match: tuple, other: tuple) -> bool:
        """Whether ``other`` is of a rival template, in the same place (over
        half of the shorter one) and has more shingles there, while less than
        half of what only the first has is found (side by side both stay)."""
        (s, e, i, here), (t, f, j, there) = match, other
        if j not in self.rivals[i] or 2 * (min(e, f) - max(s, t) + 1) <= min(e - s, f - t) + 1:
            return False
        if (len(there), len(there) / len(self.sets[j]), -j) <= (len(here), len(here) / len(self.sets[i]), -i):
            return False
        own = np.setdiff1d(self.sets[i], self.sets[j], True)
        return not len(own) or 2 * np.isin(own, here).sum() < len(own)

    def matches(self, marks: np.ndarray, sizes: np.ndarray, counts: np.ndarray, places: np.ndarray) -> list[tuple[int, str, int, int, float]]:
        """(row, template, start word, end word, containment) of verified
        windows, overlapping ones of a template joined. ``places``: of every
        bare word among its row's words."""
        first = np.cumsum(sizes) - sizes
        found: dict[int, list[tuple]] = {}
        for i, a, b in self.candidates(marks, sizes):
            row = int(np.searchsorted(first, a, "right")) - 1
            b = min(b, int(first[row] + sizes[row]))
            part = np.flatnonzero(np.isin(marks[a:b], self.sets[i]))
            here = np.unique(marks[a:b][part])
            if len(here) >= CONTAINED * len(self.sets[i]):
                found.setdefault(row, []).append((a + int(part[0]) - int(first[row]), a + int(part[-1]) - int(first[row]), i, here))
        out: list[list] = []
        for row in sorted(found):
            inside = sorted(found[row], key=lambda m: m[:3])
            starts, longest = [m[0] for m in inside], max(m[1] - m[0] for m in inside)
            best = [m for m in inside if not any(self._beaten(m, o) for o in inside[bisect_left(starts, m[0] - longest): bisect_right(starts, m[1])])]
            for start, end, i, here in sorted(best, key=lambda m: (m[2], m[0], m[1])):
                share, last = len(here) / len(self.sets[i]), out[-1] if out else None
                if last and last[:2] == [row, i] and start <= last[3]:
                    last[3], last[4] = max(last[3], end), max(last[4], share)
                else:
                    out.append([row, i, start, end, share])
        head, named = np.cumsum(counts) - counts, []
        for r, i, s, e, c in out:
            last = min(int(counts[r]), e + self.words) - 1
            named.append((r, self.names[i], int(places[head[r] + s]), int(places[head[r] + last]) + 1, c))
        return named


def _scan(templates: dict[str, str], words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, words)
        for whole in batches:
            for batch in slices(whole):
                hashed, places, counts = bare_words(*buffers(batch.column("text")))
                marks, sizes = shingles(hashed, counts, words)
                found = index.matches(marks, sizes, counts, places) if len(marks) and index.sets else []
                rows = [m[0] for m in found]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").cast(pa.int64()).take(pa.array(rows, pa.int64())), pa.array([m[1] for m in found], pa.string()),
                    pa.array([m[2] for m in found], pa.int32()), pa.array([m[3] for m in found], pa.int32()), pa.array([m[4] for m in found], pa.float64())],
                    ["doc_id", "license", "start_word", "end_word", "containment"])
    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] | DataFrame | None = None, words: int = WORDS) -> DataFrame:
    """One row per occurrence of a template in a document of ``docs`` (doc_id,
    text): doc_id, license, start_word, end_word (the white-space separated
    words it covers, end exclusive), containment (share of the template's
    shingles found there, at least 0.8).

    ``templates`` (name to text, or a table with license and text, such as one
    of full licence texts) travel with the task; they are a parameter of the
    caller's size, not data. Without them the notices of ``TEMPLATES`` are
    looked for. Whole texts are scanned in one pass without a shuffle; a very
    long text costs memory in proportion to its words. Null and empty texts
    hold nothing; a text or template shorter than five words is its whole word
    sequence. Templates without words match nothing. A null doc_id is returned
    as null, repeated rows each give their rows, other columns are ignored, an
    empty table gives no rows. Overlapping verified windows of one template are
    one occurrence; of templates that share half of the smaller one's shingles
    and overlap in a text, the one with the most shingles found is named, and
    another one if half of what sets it apart is found there too."""
    if isinstance(templates, DataFrame):
        templates = {r["license"]: r["text"] for r in templates.where("license is not null and text is not null").select("license", "text").collect()}
    return docs.select("doc_id", "text").mapInArrow(_scan(TEMPLATES if templates is None else templates, words), SCHEMA)
