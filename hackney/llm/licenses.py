"""Licence scans: passages compared to templates by the Dice coefficient.

A text is cut into passages: its lines, its paragraphs (runs of lines without
an empty one) and the whole text; where none of them is a licence, windows of
words are tried wherever enough of a template's bigrams stand close together
(`Templates.windows`).  Passages and templates are normalised
(lower case, words of letters, digits, dots and hyphens between them, common
spelling variants merged) and compared as multisets of word bigrams:

    dice = 2 shared / (bigrams of the passage + bigrams of the template)

A passage of n bigrams can reach ``threshold`` only with templates of n t/(2-t)
to n (2-t)/t bigrams; the templates are kept sorted by size, so candidates are
a slice found by bisection, and most passages have none.  Candidates must also
share one of the template's rarest words, which every passage above one half
has (`Templates`).  What is left is compared exactly.

Edge cases: a null or empty text has no passages and no licence; of templates
with the same coefficient the smaller name wins; a passage found as line,
paragraph and text counts once, at its longest; repeated rows are scanned one
by one; an empty table gives an empty result; columns other than id and text
are not read.
"""

from __future__ import annotations

import bisect
import os
import pkgutil
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hackney.llm.common import map_batches, texts

THRESHOLD = 0.8

# Short notices of common licences, by SPDX identifier.  Callers
# may pass their own (name -> list of texts), whole licence texts included.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "BSD-3-Clause": ["Released under the 3-Clause BSD License.", "Licensed under the BSD 3-Clause License."],
    "BSD-2-Clause": ["Released under the 2-Clause BSD License.", "Licensed under the BSD 2-Clause License."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright to this work."],
}

# Whole texts in ``licence_texts``, by the same identifiers.
TEXTS = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-SA-4.0", "CC0-1.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC",
         "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0")
_GNU = {"GPL": ("General", "1 2 3"), "LGPL": ("Lesser General", "2.1 3"), "AGPL": ("Affero General", "3")}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
       "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def siblings() -> dict[str, list[str]]:
    """Short notices and standard headers of all versions of the GNU and
    Creative Commons licences, so that each one's notice meets its own."""
    out: dict[str, list[str]] = defaultdict(list)
    gnu = [(f"{k}-{v if '.' in v else v + '.0'}", kind, v) for k, (kind, vs) in _GNU.items() for v in vs.split()]
    for name, kind, v in [*gnu, ("LGPL-2.0", "Library General", "2")]:
        can = (f"you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the "
               "Free Software Foundation")
        rest = ("is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
                f"of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details.")
        what = "library" if name.startswith("LGPL-2") else "program"
        later, only = f"either version {v} of the License, or (at your option) any later version.", f"version {v} of the License."
        out[name] += [f"This work is licensed under the GNU {kind} Public License, version {v}.",
                      f"Licensed under the GNU {kind} Public License v{v}.", f"Released under the GNU {kind} Public License v{v}."]
        out[name] += [f"This {what} is free software: {can}, {end}{more}" for end in (later, only) for more in ("", f" This {what} {rest}")]
    for code, words in _CC.items():
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            kind = {"3.0": "Unported", "4.0": "International"}.get(v, "Generic")
            out[f"CC-{code}-{v}"] += [f"Licensed under CC {code} {v}.", f"Creative Commons {words} {v} {kind} License",
                                      f"This work is licensed under a Creative Commons {words} {v} {kind} License."]
    return dict(out)


def all_notices() -> dict[str, list[str]]:
    """`NOTICES`, `siblings` and the whole texts."""
    out: dict[str, list[str]] = defaultdict(list)
    for name in TEXTS:
        out[name].append(pkgutil.get_data(__package__, os.path.join("licence_texts", f"{name}.txt")).decode())
    for more in (NOTICES, siblings()):
        for name, given in more.items():
            out[name] += [t for t in given if t not in out[name]]
    return dict(out)


_WORDS = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
_SPANS = re.compile(_WORDS.pattern, re.ASCII | re.IGNORECASE)
# Spelling variants that licences are printed with.
_SAME = {"licence": "license", "licences": "licenses", "licenced": "licensed", "licensed": "licensed", "v": "version"}
_BREAK = re.compile(r"\n[ \t\r]*\n")


def normalised(text: str) -> list[str]:
    return [_SAME.get(w, w) for w in _WORDS.findall(text.lower())]


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:], strict=False))


def dice(a: Counter, b: Counter, size_a: int, size_b: int) -> float:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    shared = sum(min(n, large[g]) for g, n in small.items() if g in large)
    return 2 * shared / (size_a + size_b) if size_a + size_b else 0.0


@dataclass
class Templates:
    """Templates by number of bigrams, each with anchor words.  A template's
    anchors touch more than (1 - least share) of its bigrams, so that a passage
    without any anchor shares too few to reach the threshold."""
    names: list[str]
    grams: list[Counter]
    sizes: list[int]
    anchors: list[frozenset[str]]
    every_anchor: frozenset[str]
    threshold: float
    holders: dict[tuple[str, str], list[int]] = field(default_factory=dict)      # bigram -> its templates

    @staticmethod
    def of(notices: dict[str, list[str]], threshold: float = THRESHOLD) -> Templates:
        rows = sorted(((bigrams(normalised(t)), n) for n, ts in notices.items() for t in ts), key=lambda r: (sum(r[0].values()), r[1]))
        rows = [r for r in rows if r[0]]
        seen = Counter(w for g, _ in rows for w in {w for pair in g for w in pair})
        # shared >= t (a + b) / 2 and a >= b t / (2 - t): at least this share of a template.
        least = threshold / (2 - threshold)
        anchors = []
        for g, _ in rows:
            size, touched, chosen = sum(g.values()), 0, set()
            left = Counter(g)
            words = {w for pair in g for w in pair}
            # Words in few templates first, so that common words anchor none.
            for w in sorted(words, key=lambda w: (seen[w] + 10 * (w in _COMMON), w)):
                if touched > (1 - least) * size + 1e-9:
                    break
                hit = [pair for pair in left if w in pair]
                if hit:
                    chosen.add(w)
                    touched += sum(left.pop(pair) for pair in hit)
            anchors.append(frozenset(chosen))
        holders: dict[tuple[str, str], list[int]] = defaultdict(list)
        for k, (g, _) in enumerate(rows):
            for pair in g:
                holders[pair].append(k)
        return Templates([n for _, n in rows], [g for g, _ in rows], [sum(g.values()) for g, _ in rows], anchors,
                         frozenset().union(*anchors) if anchors else frozenset(), threshold, dict(holders))

    def slice_for(self, n: int) -> tuple[int, int]:
        """Templates whose size lets a passage of ``n`` bigrams reach the threshold."""
        t = self.threshold
        return (bisect.bisect_left(self.sizes, n * t / (2 - t) - 1e-9), bisect.bisect_right(self.sizes, n * (2 - t) / t + 1e-9))

    def best(self, passage: str) -> tuple[str, float] | None:
        """(name, coefficient) of the best template at or above the threshold."""
        words = normalised(passage)
        lo, hi = self.slice_for(len(words) - 1)
        if lo >= hi:
            return None
        here = set(words)
        if here.isdisjoint(self.every_anchor):
            return None
        grams, found = None, None
        for k in range(lo, hi):
            if here.isdisjoint(self.anchors[k]):
                continue
            grams = grams if grams is not None else bigrams(words)
            d = dice(grams, self.grams[k], len(words) - 1, self.sizes[k])
            if d >= self.threshold and (found is None or (-d, self.names[k]) < (-found[1], found[0])):
                found = self.names[k], d
        return found

    def windows(self, text: str, taken: list[tuple[int, int]]) -> list[tuple[str, float, int, int]]:
        """(name, coefficient, start, end) of windows of words outside the spans
        ``taken``, at or above the threshold and apart from each other.  Of
        windows that overlap the one with the most to spare, (coefficient -
        threshold) (bigrams of both), stays: of siblings the likelier one, of a
        text and a notice inside it the text."""
        hits: dict[int, list[int]] = defaultdict(list)
        spans: list[tuple[int, int]] = []
        words: list[str] = []
        pairs: list[tuple[str, str] | None] = []
        for m in _SPANS.finditer(text):
            w = m.group().lower()
            w = _SAME.get(w, w)
            if words:
                pair = (words[-1], w)
                for k in self.holders.get(pair, ()):
                    hits[k].append(len(words) - 1)
                pairs.append(pair)
            words.append(w)
            spans.append(m.span())
        if not hits:
            return []
        blocked = np.zeros(len(pairs), bool)
        begins, ends = (np.asarray([s[k] for s in spans]) for k in (0, 1))
        for a, b in taken:          # bigrams that touch the span
            blocked[max(0, np.searchsorted(ends, a, "right") - 1):np.searchsorted(begins, b, "left")] = True
        tries: list[tuple[float, float, str, int, int]] = []
        for k, at in hits.items():
            if len(at) >= self.sizes[k] * self.threshold / (2 - self.threshold) - 1e-9:
                place = np.asarray(at)
                tries += self._windows_of(k, place[~blocked[place]], pairs, blocked)
        found: list[tuple[str, float, int, int]] = []
        used = blocked
        for _, d, name, first, last in sorted(tries, key=lambda w: (-w[0], -w[1], w[2], w[3])):
            if not used[first:last + 1].any():
                used[max(0, first - 1):last + 2] = True          # a word is in one window
                found.append((name, d, spans[first][0], spans[last + 1][1]))
        return found

    def _windows_of(self, k: int, place: np.ndarray, pairs: list, blocked: np.ndarray) -> list[tuple[float, float, str, int, int]]:
        """(to spare, coefficient, name, first and last bigram) of the best window
        from each of the bigrams at ``place``, which template ``k`` has."""
        t, size, grams = self.threshold, self.sizes[k], self.grams[k]
        # A window reaches t only if 2 shared - t n >= t size; the largest such
        # sum over hits as they are (the template's counts only lower it).
        gain = 2 - t * np.diff(place, prepend=place[:1] - 1)
        total = np.cumsum(gain)
        if not len(place) or (total - np.minimum.accumulate(total)).max() + 2 - t < t * size - 1e-6:
            return []
        number: dict[tuple[str, str], int] = {}
        code = np.asarray([number.setdefault(pairs[p], len(number)) for p in place.tolist()])
        most = np.asarray([grams[g] for g in number])
        before, rank = np.zeros(len(number), np.int64), np.zeros(len(place), np.int64)
        for j, c in enumerate(code.tolist()):
            before[c] += 1
            rank[j] = before[c]
        before[:] = 0
        bounds = np.searchsorted(place, place + size * (2 - t) / t + 1e-9, "right")
        wall = np.flatnonzero(blocked)
        if len(wall):               # no window goes over what is taken
            nearest = np.searchsorted(wall, place)
            stop = np.where(nearest < len(wall), wall[np.minimum(nearest, len(wall) - 1)], len(pairs))
            bounds = np.minimum(bounds, np.searchsorted(place, stop))
        need, out = size * t / (2 - t) - 1e-9, []
        for j in range(len(place)):
            end = bounds[j]
            if end - j >= need:
                own = code[j:end]
                d = 2 * np.cumsum(rank[j:end] - before[own] <= most[own]) / (place[j:end] - place[j] + 1 + size)
                best = int(d.argmax())
                if d[best] >= t:
                    n = int(place[j + best] - place[j] + 1)
                    out.append(((float(d[best]) - t) * (n + size), float(d[best]), self.names[k], int(place[j]), int(place[j + best])))
            before[code[j]] += 1
        return out

    @property
    def most_words(self) -> int:
        """No passage of more words than this needs to be looked at."""
        return int(max(self.sizes, default=0) * (2 - self.threshold) / self.threshold) + 2


_COMMON = frozenset("a an and any at be by for in is it license licensed of on or the this to under version with work you".split())


def passages(text: str) -> list[tuple[int, int]]:
    """(start, end) of the text, its paragraphs and its lines, longest first."""
    spans = {(0, len(text))}
    at = 0
    for cut in [*_BREAK.finditer(text), None]:
        end = cut.start() if cut else len(text)
        spans.add((at, end))
        at = cut.end() if cut else end
    at = 0
    for line in text.split("\n"):
        spans.add((at, at + len(line)))
        at += len(line) + 1
    return sorted((s for s in spans if s[0] < s[1]), key=lambda s: (s[0] - s[1], s[0]))


def _more_words(text: str, most: int) -> bool:
    """Whether ``text`` has more than ``most`` words, which no template's size
    bound allows; stops at the first word too many."""
    return next(islice(_WORDS.finditer(text.lower()), most, None), None) is not None


def scan_text(text: str, templates: Templates) -> list[tuple[str, float, int, int]]:
    """(name, coefficient, start, end) of the licence passages and windows, in
    text order; inside a found passage no shorter one is looked for."""
    found: list[tuple[str, float, int, int]] = []
    most = templates.most_words
    for start, end in passages(text):
        if any(a <= start and end <= b for _, _, a, b in found):
            continue
        part = text[start:end]
        if len(part) > 8 * most and _more_words(part, most):
            continue
        best = templates.best(part)
        if best:
            found.append((*best, start, end))
    found += templates.windows(text, [f[2:] for f in found])
    return sorted(found, key=lambda f: f[2])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: dict[str, list[str]] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """``id, licenses (distinct, sorted, comma-joined), n_passages, best_dice,
    matches (array of name, dice, start, end)`` for each row."""
    templates = Templates.of(notices or all_notices(), threshold)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan_text(t, templates) for t in texts(batch.column(1))]
        kind = pa.list_(pa.struct([("name", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("stop", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([",".join(sorted({f[0] for f in fs})) for fs in found], pa.string()),
             pa.array([len(fs) for fs in found], pa.int64()), pa.array([max((f[1] for f in fs), default=0.0) for fs in found], pa.float64()),
             pa.array([[dict(zip(("name", "dice", "start", "stop"), f, strict=True)) for f in fs] for fs in found], kind)],
            [id_col, "licenses", "n_passages", "best_dice", "matches"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run,
                       f"`{id_col}` {kind}, licenses string, n_passages long, best_dice double, "
                       "matches array<struct<name:string,dice:double,start:long,stop:long>>")
