"""Licence scans: lines, paragraphs, whole texts and windows of words against licence templates by word bigrams."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_VERSION = re.compile(r"v?(\d+(?:\.\d+)*)")
#: What a version number follows; clause numbers and years do not.
_VERSIONED = re.compile(r"version|v|licen[cs]e|[al]?gpl|cc|(?:cc-)?by(?:-.*)?|attribution(?:-.*)?")
#: Words, or parts of hyphened ones, that tell a licence from its neighbours.
_VARIANTS = {w: w for w in ("affero", "lesser", "library", "nc", "nd", "sa")} | {
    "noncommercial": "nc",
    "noderivatives": "nd",
    "noderivs": "nd",
    "sharealike": "sa",
}
_COPYRIGHT = re.compile(r"\s*(?:copyright\b|\(c\)|©)", re.IGNORECASE)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:"""
_MIT_REST = """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} as published by the Free
Software Foundation{3} either version {4} of the License, or (at your option) any later version."""
#: Published licence texts and the notices that name them: fixed values.
TEMPLATES: Mapping[str, Sequence[str]] = {
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        _GNU.format("program", ":", "Affero General Public License", ",", 3),
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
        """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License.""",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", f"{_BSD}\n\n{_BSD_WARRANTY}"),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        _BSD_NAMES,
        f"{_BSD}\n\n{_BSD_NAMES}\n\n{_BSD_WARRANTY}",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        _GNU.format("program", ";", "General Public License", ";", 2),
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    ),
    "ISC": ("Released under the ISC License.", _ISC),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        _GNU.format("library", ";", "Lesser General Public License", ";", 2.1),
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        _GNU.format("program", ":", "Lesser General Public License", ",", 3),
    ),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", _MIT, f"{_MIT}\n\n{_MIT_REST}"),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}


def normalised(line: str) -> list[str]:
    """Words in lower case without punctuation; versions and hyphened names stay whole. A copyright line has none."""
    return [] if _COPYRIGHT.match(line) else _WORD.findall(line.lower())


def bigrams(words: Sequence[str]) -> Counter:
    return Counter(zip(words, words[1:], strict=False))


def marks(words: Sequence[str]) -> frozenset[str]:
    """The versions (2.0 is 2) and variants that `words` name. LGPL-2.1 calls its subject a library, so that word counts only before
    "general"."""
    found = set()
    for i, word in enumerate(words):
        if i and (version := _VERSION.fullmatch(word)) and _VERSIONED.fullmatch(words[i - 1]):
            found.add(re.sub(r"(?:\.0)+$", "", version[1]))
        for part in word.split("-"):
            if part in _VARIANTS and (part != "library" or words[i + 1 : i + 2] == ["general"]):
                found.add(_VARIANTS[part])
    return frozenset(found)


class Templates:
    """Templates by their number of bigrams, and by each bigram."""

    def __init__(self, texts: Mapping[str, Sequence[str]], threshold: float = THRESHOLD):
        counted = [(name, bigrams(words), marks(words)) for name, all_ in texts.items() for text in all_ if len(words := self._words(text)) > 1]
        counted.sort(key=lambda x: (x[1].total(), x[0]))
        self.threshold = threshold
        self.names, self.counts, self.marks = [n for n, *_ in counted], [c for _, c, _ in counted], [m for *_, m in counted]
        self.sizes = [c.total() for c in self.counts]
        self.having: dict[tuple[str, str], list[int]] = defaultdict(list)
        for i, counts in enumerate(self.counts):
            for pair in counts:
                self.having[pair].append(i)

    @staticmethod
    def _words(text: str) -> list[str]:
        return [w for line in text.split("\n") for w in normalised(line)]

    def candidates(self, size: int) -> range:
        """Templates that a unit of `size` bigrams can resemble enough: what they share is at most the smaller size."""
        t = self.threshold
        return range(bisect_left(self.sizes, size * t / (2 - t) - 1e-9), bisect_right(self.sizes, size * (2 - t) / t + 1e-9))

    def best(self, words: Sequence[str]) -> tuple[float, int, str] | None:
        """(coefficient, template's bigrams, name) of the template that `words` resemble most, where one reaches the threshold and
        names the versions and variants that `words` name."""
        size = len(words) - 1
        among = self.candidates(size) if size > 0 else range(0)
        if not among:
            return None
        pairs = list(zip(words, words[1:], strict=False))
        found = {i for p in pairs if p in self.having for i in self.having[p] if i in among}
        if not found:
            return None
        counts, out = Counter(pairs), []
        for i in found:
            shared = sum(min(n, self.counts[i][p]) for p, n in counts.items() if p in self.counts[i])
            if (dice := 2 * shared / (size + self.sizes[i])) >= self.threshold:
                out.append((-dice, -self.sizes[i], self.names[i], self.marks[i]))
        own = marks(words) if out else None
        dice, size, name, _ = min((h for h in out if h[3] == own), default=(None,) * 4)
        return None if name is None else (-dice, -size, name)

    def windows(self, words: Sequence[str]) -> list[tuple[float, int, str, int, frozenset[str]]]:
        """(coefficient, template's bigrams, name, first word, the template's marks) of the windows that reach the threshold: as long as
        the template, beginning at one of its bigrams or ending with `words`. No other window shares more with it."""
        places: dict[int, list[tuple[int, tuple[str, str]]]] = defaultdict(list)
        for at, pair in enumerate(zip(words, words[1:], strict=False)):
            if pair in self.having:
                for i in self.having[pair]:
                    places[i].append((at, pair))
        out = []
        for i, own in places.items():
            size, last = self.sizes[i], len(words) - 1 - self.sizes[i]
            least = self.threshold * size
            if last < 0 or len(own) < least:
                continue
            for at, shared in self._shared(self.counts[i], size, own, last):
                if shared >= least:
                    out.append((shared / size, size, self.names[i], at, self.marks[i]))
        return out

    @staticmethod
    def _shared(template: Counter, size: int, places: list[tuple[int, tuple[str, str]]], last: int) -> Iterator[tuple[int, int]]:
        """(begin, bigrams shared with the template) of the windows that begin at `places` up to `last`, and of the last one."""
        held: Counter = Counter()
        shared = ahead = 0
        for begin, gone in [*(p for p in places if p[0] < last), (last, None)]:
            while ahead < len(places) and places[ahead][0] < begin + size:
                pair = places[ahead][1]
                held[pair] += 1
                shared += held[pair] <= template[pair]
                ahead += 1
            if gone is None:
                break
            yield begin, shared
            shared -= held[gone] <= template[gone]
            held[gone] -= 1
        yield last, shared


def scan(text: str | None, templates: Templates) -> list[tuple[float, int, str, str, int]]:
    """(coefficient, template's bigrams, licence, kind of unit, its first line) of each match, best first.

    Each line, each paragraph of several lines and the whole text are units with one match at most (see `Templates.best`). So that a licence
    between other paragraphs or within a line is named too, each template is also compared with windows of its own size, whatever
    their lines. A window counts if it names the versions and variants that the template names, and if no better match
    (a higher coefficient, then the larger template, a unit before a window, the first name) has any of its words.
    """
    lines = [normalised(line) for line in (text or "").split("\n")]
    starts, words = list(accumulate(map(len, lines), initial=0)), list(chain.from_iterable(lines))
    units = [(i, i + 1, "line") for i in range(len(lines))]
    if len(lines) > 1:
        begin, whole = 0, (0, len(lines), "text")
        for i in range(len(lines) + 1):
            if i == len(lines) or not lines[i]:
                if 1 < i - begin < len(lines):
                    units.append((begin, i, "paragraph"))
                begin = i + 1
        units.append(whole)
    found = []  # in the order in which they count; a window's marks are read when its turn comes
    for a, b, kind in units:
        if templates.candidates(starts[b] - starts[a] - 1) and (hit := templates.best(words[starts[a] : starts[b]])):
            found.append((-hit[0], -hit[1], False, hit[2], starts[a], starts[b], kind, a, None))
    for dice, size, name, begin, said in templates.windows(words):
        line = bisect_right(starts, begin) - 1
        found.append((-dice, -size, True, name, begin, begin + size + 1, "window", line, said))
    out, taken = [], bytearray(len(words))
    for dice, size, window, name, begin, end, kind, line, said in sorted(found, key=lambda h: h[:8]):
        if window and (taken.find(1, begin, end) >= 0 or marks(words[begin:end]) != said):
            continue
        taken[begin:end] = b"\1" * (end - begin)
        out.append((-dice, -size, name, kind, line))
    return out


def scanned(docs: DataFrame, texts: Mapping[str, Sequence[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice, unit, line, licenses of every row of `docs` (doc_id, text).

    The best match of the document (its coefficient, the kind of unit (line, paragraph, text or window) and its first line from 0)
    and the names of all matches (see `scan`), sorted and joined by commas; nulls if none reaches the threshold. Of equal coefficients
    the larger template counts, then the first name, then the first line. Null and empty texts match nothing; repeated rows get the same answer. Of
    other columns nothing is read. An empty table gives no rows. Each text is scanned where it lies; nothing is shuffled.
    """

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(texts, threshold)
        for batch in batches:
            column, rows = batch.column(1), []
            for i in range(len(column)):
                hits = scan(column[i].as_py(), templates)
                dice, _, name, unit, line = min(hits, key=lambda h: (-h[0], -h[1], h[2], h[4], h[3]), default=(None,) * 5)
                rows.append((name, dice, unit, line, ",".join(sorted({h[2] for h in hits})) or None))
            types = [pa.string(), pa.float64(), pa.string(), pa.int64(), pa.string()]
            arrays = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "license", "dice", "unit", "line", "licenses"])

    schema = "doc_id bigint, license string, dice double, unit string, line bigint, licenses string"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(match, schema)
