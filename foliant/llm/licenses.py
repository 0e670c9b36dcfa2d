"""Operator 8: license scans by winnowed fingerprints and banded alignment.

Each template's winnowed word k-grams are an inverted index (fingerprint to template
and position). A document's winnowed k-grams look up candidates map-side; both sides
keep the least of each window, so a run of ``k + window - 1`` equal words can't be
missed. Around each diagonal of a candidate a banded alignment of words reports how many
of the template's words are matched, and where; what is matched is taken out and the
alignment repeated, so copies close to each other are all found.

The templates are a parameter of bounded size (checked); the default ones are the
usual short notices. Documents aren't shuffled.

Defined cases: null and empty texts match nothing; a template without words is
refused; a text with several copies of a notice gives a row for each that doesn't
overlap; repeated rows give their own rows; an empty table gives no rows; further
columns don't matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm._arrow import NON_WORD, HashIndex, Words, blocks, grams, winnow, words
from foliant.llm.shared import small_batches

MAX_TEMPLATE_BYTES = 4 << 20
K, WINDOW, BAND, COVERAGE = 3, 2, 8, 0.8

#: Wording of public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT": "Released under the MIT License",
    "MIT-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "GPL-3.0": "licensed under the GNU General Public License, version 3",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL": "licensed under the GNU Lesser General Public License",
    "AGPL-3.0": "licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0-text": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC0-1.0": "To the extent possible under law the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "All-rights-reserved": "All rights reserved",
}
_AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_TWO_CLAUSES = TEMPLATES["BSD"] + " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
#: Whole texts of short licenses; of notices that overlap the longest match wins, so a whole license is reported as one.
TEMPLATES |= {
    "MIT-whole": TEMPLATES["MIT-text"] + ' The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "BSD-2-Clause-whole": f"{_TWO_CLAUSES} {_AS_IS}",
    "BSD-3-Clause-whole": f"{_TWO_CLAUSES} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_AS_IS}",
    "ISC-whole": TEMPLATES["ISC"] + ', provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
}


def align(doc: np.ndarray, item: np.ndarray, shift: int, band: int) -> tuple[int, int, int, int, int]:
    """Banded local alignment near the diagonal ``doc position - item position = shift``.

    A match scores 2, a mismatch or gap -1. Returns (score, start, end, item's start, matched words) of the
    best alignment; start and end are word positions in ``doc``.
    """
    best = (0, 0, 0, 0, 0)
    width = 2 * band + 1
    row: list[tuple[int, int, int, int]] = [(0, 0, 0, 0)] * width  # by diagonal: score, start, item's start, matched
    for j, word in enumerate(item.tolist()):
        new: list[tuple[int, int, int, int]] = []
        for d in range(width):
            i = j + shift + d - band
            if not 0 <= i < len(doc):
                new.append((0, i, j + 1, 0))
                continue
            s, a, c, m = row[d] if row[d][0] > 0 else (0, i, j, 0)
            now = (s + 2, a, c, m + 1) if int(doc[i]) == word else (s - 1, a, c, m)
            if d + 1 < width and row[d + 1][0] - 1 > now[0]:  # a word of the item is missing
                s, a, c, m = row[d + 1]
                now = (s - 1, a, c, m)
            if new and new[-1][0] - 1 > now[0]:  # a word too many
                s, a, c, m = new[-1]
                now = (s - 1, a, c, m)
            if now[0] > best[0]:
                best = (now[0], now[1], i + 1, now[2], now[3])
            new.append(now)
        row = new
    return best


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE, k: int = K, window: int = WINDOW, band: int = BAND) -> DataFrame:
    """One row per document and matched notice: id, template, coverage, matched, template_words, start_word, end_word, start_byte, end_byte, span.

    Of notices that overlap in a document, the one with the most matched words stays, then the greater coverage.
    """
    small_batches(docs)
    templates = dict(TEMPLATES if templates is None else templates)
    if sum(len(t.encode()) for t in templates.values()) > MAX_TEMPLATE_BYTES:
        raise ValueError("the templates are too large to be sent to every task")
    names = list(templates)
    items: list[np.ndarray] = []
    at: dict[tuple[int, bool], dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for n, name in enumerate(names):
        w = words(next(blocks(pa.array([templates[name]]), 1 << 60)), NON_WORD)
        if not len(w.hashes):
            raise ValueError(f"template {name} has no words")
        items.append(w.hashes)
        size, wide = min(k, len(w.hashes)), len(w.hashes) >= k + window - 1
        values, valid = grams(w, size)
        for p in (winnow(values, valid, w.bounds, window) if wide else np.flatnonzero(valid)).tolist():
            at[size, wide][int(values[p])].append((n, p))
    # notices shorter than a window's reach are looked up from every k-gram, the others from winnowed ones
    indexes = [(size, wide, index := HashIndex(np.fromiter(of, np.uint64, len(of))), [of[h] for h in index.keys.tolist()]) for (size, wide), of in at.items()]
    # a hash that no word of the template has
    taken_word = [next(x for x in np.arange(len(t) + 1, dtype=np.uint64) if x not in t) for t in items]
    least_end = [max(1, int(np.ceil(coverage * len(x) - 1e-9))) for x in items]

    def matches(w: Words, i: int, found: dict[int, list[int]]) -> list[tuple]:
        doc = w.of(i)
        got = []
        for n, shifts in found.items():
            free = None  # the document without what this template has matched, so that the next copy is the best one
            for shift in sorted(set(shifts)):
                low = max(0, shift - band)
                while True:
                    part = (doc if free is None else free)[low : low + len(items[n]) + 2 * band + 1]
                    _, a, b, _, m = align(part, items[n], shift - low, band)
                    if m < least_end[n] or free is not None and (part[a:b] == taken_word[n]).any():
                        break
                    got.append((-m, -m / len(items[n]), a + low, b + low, n))
                    free = doc.copy() if free is None else free
                    free[a + low : b + low] = taken_word[n]
        got.sort()
        taken: list[tuple] = []
        for x in got:
            if all(x[3] <= y[2] or y[3] <= x[2] for y in taken):
                taken.append(x)
        return taken

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block in blocks(batch.column(1)):
                w = words(block, NON_WORD)
                found: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
                for size, wide, index, where in indexes:
                    values, valid = grams(w, size)
                    pos = winnow(values, valid, w.bounds, window) if wide else np.flatnonzero(valid)
                    hit, place = index.find(values[pos])
                    pos = pos[hit]
                    owner = np.searchsorted(w.bounds, pos, "right") - 1
                    for i, p, m in zip(owner.tolist(), (pos - w.bounds[owner]).tolist(), place.tolist(), strict=True):
                        for n, q in where[m]:
                            found[i][n].append(p - q)
                for i in sorted(found):
                    for m, c, a, b, n in matches(w, i, found[i]):
                        x, y = int(w.starts[w.bounds[i] + a]), int(w.ends[w.bounds[i] + b - 1])
                        first = int(block.offsets[i])
                        rows.append({"id": batch.column(0)[block.first + i].as_py(), "template": names[n], "coverage": -c, "matched": -m, "template_words": len(items[n]), "start_word": a, "end_word": b, "start_byte": x - first, "end_byte": y - first, "span": block.data[x:y].tobytes().decode("utf-8", "replace")})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, OUT)

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "id long, template string, coverage double, matched long, template_words long, start_word long, end_word long, start_byte long, end_byte long, span string").withColumnRenamed("id", id_col)


OUT = pa.schema([("id", pa.int64()), ("template", pa.string()), ("coverage", pa.float64()), *((c, pa.int64()) for c in ("matched", "template_words", "start_word", "end_word", "start_byte", "end_byte")), ("span", pa.string())])
