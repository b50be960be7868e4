"""Licence passages by patience alignment with known templates.

A passage of a text and a template are aligned on the words that are unique in
both: their longest increasing subsequence anchors the alignment, and the gaps
between anchors are aligned in the same way, with equal ends matched first. The
share of the template's words that are matched is the passage's coverage.

A word that a text repeats elsewhere would not be unique in the whole text, so
texts are first cut to passages: runs of places where two neighbouring words are
neighbours in the template too, in rising order. Templates are a fixed list of
public licence texts and notices, so every text is read where it lies, once.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_small_batches, returning_memory, without_nulls

# Public licence texts and the notices by which texts refer to licences.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License version 3.",
        "SPDX-License-Identifier: GPL-3.0",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0"),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0"),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."),
    "CC-BY-NC-4.0": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "SPDX-License-Identifier: CC0-1.0"),
}

# Notices that differ from another's in the licence's name or version alone.
_GPL = TEMPLATES["GPL-3.0"][0]
TEMPLATES["GPL-2.0"] += (_GPL.replace("version 3", "version 2"),)
TEMPLATES["LGPL-3.0"] += (_GPL.replace("GNU General", "GNU Lesser General"),)
TEMPLATES["AGPL-3.0"] += (_GPL.replace("GNU General", "GNU Affero General"),)


# Headings and short notices, by the licence's names: with a version where they have one.
_NAMED = {
    "MIT": ("MIT License",),
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0"),
    "GPL-3.0": ("GNU GPL v3", "GNU General Public License v3.0", "GNU General Public License version 3"),
    "GPL-2.0": ("GNU GPL v2", "GNU General Public License v2.0", "GNU General Public License version 2"),
    "LGPL-3.0": ("GNU LGPL v3", "GNU Lesser General Public License v3.0", "GNU Lesser General Public License version 3"),
    "AGPL-3.0": ("GNU AGPL v3", "GNU Affero General Public License v3.0", "GNU Affero General Public License version 3"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License"),
}
for _name, _titles in _NAMED.items():
    for _title in _titles:
        TEMPLATES[_name] += tuple(t for t in (f"Licensed under the {_title}.", f"Released under the {_title}.", f"Distributed under the {_title}.", f"Distributed under the terms of the {_title}.") if t not in TEMPLATES[_name])
    if "BSD" in _name:
        TEMPLATES[_name] += _titles

#: Words that name a licence, as versions do.
NAMES = frozenset("mit apache gnu gpl lgpl agpl lesser affero mozilla bsd 2-clause 3-clause cc by by-sa by-nc creative attribution attribution-sharealike attribution-noncommercial".split())
#: Words that make another licence of a name that they stand within.
QUALIFIERS = frozenset("lesser library affero noncommercial non-commercial sharealike share-alike noderivatives noderivs no-derivatives".split())
#: Words of a notice at most; in longer texts a name may be missing, but not be another.
NOTICE = 40

_VERSION = re.compile(r"v?\d+(?:\.\d+)*")
_TOKEN = re.compile(r"[^\W_]+(?:[.\-'][^\W_]+)*")


def tokens(text: str) -> list[str]:
    """Lower-cased words, versions and hyphenated names as one."""
    return _TOKEN.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience piles."""
    tops: list[int] = []
    last: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            last.append(i)
        else:
            tops[pile], last[pile] = v, i
        back[i] = last[pile - 1] if pile else -1
    out, at = [], last[-1] if last else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def patience(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched (place in text, place in template) pairs, rising in both."""
    found, gaps = [], [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        once, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: k for k, w in enumerate(template[c:d], c) if there[w] == 1}
        common = [(k, place[w]) for k, w in enumerate(text[a:b], a) if once[w] == 1 and w in place]
        before = (a - 1, c - 1)
        anchors = [common[i] for i in increasing([p for _, p in common])]
        if not anchors:
            continue
        found += anchors
        for x, y in [*anchors, (b, d)]:
            gaps.append((before[0] + 1, x, before[1] + 1, y))
            before = (x, y)
    return sorted(found)


def _plain(word: str) -> str:
    """A name or version without the ways in which it may be spelled."""
    return (word[1:] if _VERSION.fullmatch(word) and word[0] == "v" else word).removesuffix(".0").replace(".", "")


class Scanner:
    """Finds licence passages in texts.

    A passage must have the names and versions that its template has (see ``_named``).
    """

    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES, coverage: float = 0.8):
        self.coverage = coverage
        self.templates = [(name, tokens(t)) for name, texts in templates.items() for t in texts]
        self.pairs: dict[tuple[str, str], list[tuple[int, int]]] = defaultdict(list)
        for k, (_, words) in enumerate(self.templates):
            for place, pair in enumerate(zip(words, words[1:])):
                self.pairs[pair].append((k, place))
        self.needed = [math.ceil(round(coverage * len(words), 9)) for _, words in self.templates]
        # where each of a template's names and versions stands first
        self.names = [sorted({w: c for c, w in reversed(list(enumerate(words))) if _VERSION.fullmatch(w) or w in NAMES and (w != "by" or "cc" in words)}.values()) for _, words in self.templates]
        # A match has one of these: of each template its rarest words, one more than may be missing.
        often = Counter(w for _, words in self.templates for w in set(words))
        self.keys = frozenset()
        for (_, words), needed in zip(self.templates, self.needed):
            missing = len(words) - needed + 1
            picked, held = set(), 0
            for w, n in sorted(Counter(words).items(), key=lambda x: (often[x[0]] + 20 * (len(x[0]) < 3), -len(x[0]), x[0])):
                if held >= missing:
                    break
                picked.add(w)
                held += n
            self.keys |= picked
        self.finder = ahocorasick.Automaton()
        for key in self.keys:
            self.finder.add_word(key, len(key))
        self.finder.make_automaton()

    def _may_match(self, low: str) -> bool:
        """Whether one of the keys stands in a lower-cased text with no letter or digit beside it, as every key that is a word does."""
        if not self.keys:
            return False
        for last, size in self.finder.iter(low):
            if (last < size or not low[last - size].isalnum()) and (last + 1 == len(low) or not low[last + 1].isalnum()):
                return True
        return False

    def _passages(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """(template, first, end) of runs of shared neighbours."""
        seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
        get = self.pairs.get
        for i, pair in enumerate(zip(words, words[1:])):
            for k, place in get(pair, ()):
                seeds[k].append((i, place))
        for k, own in seeds.items():
            size = len(self.templates[k][1])
            slack = 2 + size // 4
            runs: list[list[int]] = []
            for i, places in groupby(own, key=itemgetter(0)):
                due = runs[-1][2] + i - runs[-1][1] if runs else 0
                place = min((p for _, p in places), key=lambda p: abs(p - due))
                # a run ends where the text strays or starts the template again
                if not runs or i - runs[-1][1] > size // 2 + slack or place < runs[-1][2] - size // 4:
                    runs.append([i, i, place, place])
                runs[-1][1], runs[-1][2] = i, max(runs[-1][2], place)
            edges = [0, *(run[1] + 2 for run in runs[:-1])], [*(run[0] for run in runs[1:]), len(words)]
            for (first, last, top, bottom), low, high in zip(runs, *edges):
                # as far as the template may reach, but not into the runs beside
                yield k, max(min(low, first), first - bottom - slack), min(max(high, last + 2), last + 2 + size - top + slack)

    def _named(self, k: int, text: list[str], matched: list[tuple[int, int]]) -> bool:
        """Whether a passage names the template's licence, and no other.

        A notice must have all its names and versions, be they spelled another
        way. A longer text may lack them, but not have another version or
        name in their place.
        """
        places, template = self.names[k], self.templates[k][1]
        at = {c: a for a, c in matched}
        found = []
        for c in places:
            if c in at:
                found.append(at[c])
                continue
            beside = [text[a] for a in (at.get(c - 1, -9) + 1, at.get(c + 1, -9) - 1) if 0 <= a < len(text)]
            if any(_plain(w) == _plain(template[c]) for w in beside):
                continue
            if len(template) <= NOTICE or any(w in NAMES or _VERSION.fullmatch(w) for w in beside):
                return False
        if not found:
            return True
        own = set(at.values())
        return not any(text[a] in QUALIFIERS and a not in own for a in range(min(found), max(found)))

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """(licence, coverage, first character, end, matched words) of the passages, in text order.

        Of passages that overlap, the one with most matched words stays.
        """
        low = text.lower()
        if not self._may_match(low) or self.keys.isdisjoint(words := _TOKEN.findall(low)):
            return []
        spans = None
        found = []
        for k, first, end in self._passages(words):
            name, template = self.templates[k]
            matched = patience(words[first:end], template)
            if len(matched) >= self.needed[k] and self._named(k, words[first:end], matched):
                spans = spans or [m.span() for m in _TOKEN.finditer(text.lower())]
                found.append((len(matched), len(matched) / len(template), name, spans[first + matched[0][0]][0], spans[first + matched[-1][0]][1]))
        kept: list[tuple[str, float, int, int, int]] = []
        for n, share, name, a, b in sorted(found, key=lambda x: (-x[0], -x[1], x[2], x[3])):
            if all(b <= c or a >= d for _, _, c, d, _ in kept):
                kept.append((name, share, a, b, n))
        return sorted(kept, key=lambda x: x[2])


def scan_licenses(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, coverage: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, license, coverage, first, end, words): the licence passages of every text.

    ``coverage``: share of the template's words that the passage has in their
    order. ``first`` and ``end`` are character places in the lower-cased text.
    Null and empty texts have no passage. A text may have many, each counts; of
    overlapping ones the one with most words stays (ties: higher coverage, then
    name). Each row that repeats a text gives its passages. Other columns are
    ignored; an empty table gives an empty result. One narrow stage.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    scanners: list[Scanner] = []

    def scanned(batches):
        if not scanners:
            scanners.append(Scanner(templates, coverage))
        for batch in batches:
            rows = [(i, *p) for i, t in enumerate(batch.column(1).to_pylist()) for p in scanners[0].scan(t)]
            at, names, shares, first, end, n = zip(*rows) if rows else ((),) * 6
            yield pa.record_batch(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(first, pa.int64()), pa.array(end, pa.int64()), pa.array(n, pa.int64())],
                names=[id_column, "license", "coverage", "first", "end", "words"],
            )

    rows = docs.select(F.col(id_column), without_nulls(F.col(text_column)).alias("text"))
    return by_small_batches(rows).mapInArrow(returning_memory(scanned), f"`{id_column}` {kind}, license string, coverage double, first long, end long, words long")
