"""License scans by patience alignment of template words with document words.

Both are sequences of lower-cased words. Where a stretch of a document could hold
a template (enough of its words are template words), the two are aligned:
words unique to both sides are anchors, the longest increasing subsequence of
their positions keeps the order, and the gaps between anchors are aligned the
same way, where words that repeat in the whole may be unique again; a gap without any word unique to both takes
a longest common subsequence of its words. Coverage
is the share of template words that are aligned. Copies may follow each other closely.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.decontaminate import word_hashes, words
from tessera.llm.runtime import prepare

COVERAGE = 0.8
SPREAD = 1.5

# Notices and license texts as published, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "notice", "Released under the MIT License."),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MPL-2.0", "notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("GPL-3.0-or-later", "header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("ISC", "text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-3-Clause", "text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("MIT", "disclaimer", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "disclaimer", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-3-Clause", "disclaimer", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("Apache-2.0", "header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Zlib", "text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "header", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    ends, last, back = [], [], []
    for i, v in enumerate(values):
        k = bisect_left(ends, v)
        back.append(last[k - 1] if k else -1)
        ends[k : k + 1] = [v]
        last[k : k + 1] = [i]
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions of equal words, increasing in both sequences."""
    pairs, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        shared = [(i, at_b[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at_b]
        kept = [shared[k] for k in increasing([j for _, j in shared])]
        if not kept:
            places: dict[str, list[int]] = {}
            for j in range(b1 - 1, b0 - 1, -1):
                places.setdefault(b[j], []).append(j)
            equal = [(i, j) for i in range(a0, a1) for j in places.get(a[i], ())]
            # a word's places run backwards, so that an increasing subsequence takes one of them at most
            pairs += [equal[k] for k in increasing([j for _, j in equal])]
            continue
        pairs += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if i + 1 < k and j + 1 < m]
    return sorted(pairs)


class Scanner:
    def __init__(self, templates: list[tuple[str, str, str]], coverage: float):
        self.coverage = coverage
        self.templates = [(name, kind, words(text)) for name, kind, text in templates if words(text)]
        hashed = [np.unique(word_hashes(text)) for _, _, text in templates if words(text)]
        self.known = np.unique(np.concatenate(hashed)) if hashed else np.zeros(0, np.uint64)
        self.member = np.array([np.isin(self.known, h) for h in hashed]).reshape(len(hashed), len(self.known))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.known >> np.uint64(48)] = True

    def regions(self, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, first word, end) of the stretches in which enough words are words of the template."""
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(48)])
        where = np.searchsorted(self.known, hashes[at])
        ok = self.known[np.minimum(where, len(self.known) - 1)] == hashes[at]
        at, where = at[ok], where[ok]
        for k, (_, _, text) in enumerate(self.templates):
            need, span = int(np.ceil(self.coverage * len(text) - 1e-9)), int(SPREAD * len(text)) + 1
            if len(at) < need:
                continue
            p = at[self.member[k, where]]
            if len(p) < need:
                continue
            # a start is good if enough members lie within the span
            good = p[: len(p) - need + 1][p[need - 1 :] - p[: len(p) - need + 1] < span]
            start = None
            for s in good.tolist():
                if start is None:
                    start = s
                elif s >= end:
                    yield k, start, min(end, len(hashes))
                    start = s
                end = s + span
            if start is not None:
                yield k, start, min(end, len(hashes))

    def first_copy(self, k: int, mine: list[str], s: int, end: int) -> tuple[int, int, int] | None:
        """(aligned words, first word, last word) of the first copy that starts in the span from s.

        Copies that stand close together leave no word unique in a wide window, and a word that one copy lacks is an
        anchor in the next: windows start at steps of an eighth of the template and grow by such steps up to the span.
        The first that holds enough may cut its copy short: windows up to there and at its first words are compared.
        """
        template = self.templates[k][2]
        need, step, stride = int(np.ceil(self.coverage * len(template) - 1e-9)), int(SPREAD * len(template)) + 1, max(len(template) // 8, 1)
        known = Counter(template)

        def tried(at: int) -> Iterator[list[int]]:
            for width in range(need, step + 2 * stride, stride):
                part = mine[at : min(at + width, end)]
                if (Counter(part) & known).total() >= need:
                    pairs = align(template, part)
                    if len(pairs) >= need:
                        yield [at + j for _, j in pairs]
                if at + width >= end:
                    return

        for at in range(s, min(s + step, end), stride):
            places = next(tried(at), None)
            if places:
                starts = {*range(at, places[0], stride), *places[: len(template) - need + 1]}
                # one that starts further on is another copy; a word aligned far from the others is not worth the words between
                best = max((x for i in starts for x in tried(i) if x[0] <= max(starts)), default=places, key=lambda x: (4 * len(x) - (x[-1] - x[0]), -x[0]))
                return len(best), best[0], best[-1]
        return None

    def scan(self, text: str) -> list[tuple]:
        """(license, kind, coverage, first word, last word) of each template found; a stretch is scanned on until nothing more is found."""
        if not self.templates:
            return []
        found, mine = [], None
        for k, start, end in self.regions(word_hashes(text)):
            mine = mine or words(text)
            name, kind, template = self.templates[k]
            step = int(SPREAD * len(template)) + 1
            s = start
            while s < end:
                hit = self.first_copy(k, mine, s, end)
                if hit is None:
                    # a window of twice the span holds any stretch that starts in its first half
                    pairs = align(template, mine[s : min(s + 2 * step, end)])
                    if len(pairs) / len(template) >= self.coverage and pairs[-1][1] - pairs[0][1] < 2 * step:
                        hit = len(pairs), s + pairs[0][1], s + pairs[-1][1]
                if hit:
                    found.append((name, kind, hit[0] / len(template), *hit[1:]))
                    s = hit[2] + 1
                else:
                    s += step
        return found


FOUND = "array<struct<license:string,kind:string,coverage:double,first_word:int,last_word:int>>"


def licenses(text: Column, templates: list[tuple[str, str, str]], coverage: float) -> Column:
    @F.pandas_udf(FOUND)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates, coverage)
        names = ["license", "kind", "coverage", "first_word", "last_word"]
        for s in texts:
            yield pd.Series([[dict(zip(names, x)) for x in scanner.scan(t or "")] for t in s], dtype=object)

    return run(text)


def templates_from(table: DataFrame, most: int = 10_000, most_bytes: int = 32 << 20) -> list[tuple[str, str, str]]:
    """Templates of a table (license, kind, text), whose size is checked before it is fetched: more than the bounds is an error."""
    rows = table.select("license", "kind", "text").filter(F.col("text").isNotNull())
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if n > most or size > most_bytes:
        raise ValueError(f"{n} templates of {size} bytes are too many to go to the tasks")
    return sorted(map(tuple, rows.collect()))


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES, coverage: float = COVERAGE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, license, kind, coverage, first_word, last_word: a row for each template found in a document.

    Word numbers count from 0. Null, empty and wordless texts give no rows; repeated
    rows give repeated rows; a template that stands several times in a document is
    reported each time; other columns are not read. The templates are a list given
    by the caller and go to the tasks as part of the function.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode(licenses(F.col(text), templates, coverage)).alias("l"))
    return rows.select("doc_id", "l.license", "l.kind", F.round("l.coverage", 6).alias("coverage"), "l.first_word", "l.last_word")
