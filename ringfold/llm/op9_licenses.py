"""License scan: winnowed fingerprints pick candidates, a banded alignment confirms them.

Templates are license notices and full short licenses. Their words (lower case, ASCII punctuation
as white space) are hashed in windows of GRAM words; the minima of every WINDOW
consecutive hashes, with the first and last of each template, are its fingerprints and go into an inverted index of
(template, position). All windows of a whole document are looked up. A candidate is a stretch of BAND neighbouring diagonals on which
one in LEADS of the template's fingerprints is found, and one at least; around it a banded
alignment (up to BAND words, or a quarter of a short template, off the diagonal) of template
and document finds the aligned words. A match at COVERAGE has a fifth of the template's words replaced at most, each of which
breaks GRAM windows at most, so two in five windows are left when the replacements are spread evenly and more when they
are not; insertions beside replacements can break more and go unfound. A candidate needs COVERAGE or more of its words matched. The words that tell siblings
apart (MARKS, and the number of a version) must all be matched, and none of MARKS may stand unmatched between matched words. Of matches
that overlap, the one with the most matched words stays. Spans are code points of the text.

The index is made of the templates, an argument of the caller's; those of the library have a few hundred fingerprints, so
nothing that grows with the data is sent to executors, and a document is one row in, its matches out.

Edge cases: null or empty text has no match; a license repeated in a text is
reported once for each place; a text with very many hits costs an alignment only where enough different ones lie on one stretch; repeated
rows each report their matches; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.llm.common import map_rows, table, utf8
from ringfold.llm.op7_minhash import WordHash

GRAM, WINDOW, BAND, COVERAGE, LEADS = 3, 3, 8, 0.8, 3
MARKS = frozenset(b"affero lesser library nc sa nd noncommercial sharealike noderivatives noderivs".split())

# Notices and licenses as their publishers word them.
TEMPLATES = {
    "MIT/notice": "Released under the MIT License.",
    "MIT/notice-2": "Licensed under the MIT License.",
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "GPL-3.0/notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0/notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "LGPL-2.1/notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MPL-2.0/notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-NC-4.0/notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0/notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0/sentence": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-2.0/header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "AGPL-3.0/notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-3.0/notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "CC-BY-ND-4.0/notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0/notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0/notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-3.0/notice": "Licensed under CC BY 3.0.",
    "CC-BY-SA-3.0/notice": "Licensed under CC BY-SA 3.0.",
    "CC-BY-SA-4.0/sentence": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0/sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "MIT/license": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "ISC/license": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause/license": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause/license": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "Unlicense/license": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}

_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()
_WORD = re.compile(rb"[^ ]+")


def split_words(raw: bytes) -> list[bytes]:
    return raw.translate(_PLAIN).split()


def grams(words: list[bytes], cache: WordHash) -> np.ndarray:
    h = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
    n = len(h) - GRAM + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    s = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        s = (s ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        s ^= s >> np.uint64(29)
    return s


def winnow(hashes: np.ndarray) -> list[int]:
    """Positions of the rightmost minimum of each WINDOW hashes, and both ends."""
    picked = {0, len(hashes) - 1}
    for i in range(max(1, len(hashes) - WINDOW + 1)):
        w = hashes[i : i + WINDOW]
        picked.add(i + len(w) - 1 - int(np.argmin(w[::-1])))
    return sorted(picked)


class Licenses:
    def __init__(self, templates: dict[str, str] = TEMPLATES) -> None:
        self.cache = WordHash()
        self.names = list(templates)
        self.words = [split_words(utf8(t)) for t in templates.values()]
        self.band = [min(BAND, max(1, len(w) // 4)) for w in self.words]
        self.marks = [Counter(x for k, x in enumerate(w) if x in MARKS or (x.isdigit() and (len(w) <= 16 or w[k - 1] in (b"version", b"v")))) for w in self.words]
        index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.least = []
        for t, w in enumerate(self.words):
            hashes = grams(w, self.cache)
            picked = winnow(hashes) if len(hashes) else []
            self.least.append(max(1, -(-len(picked) // LEADS)))
            for p in picked:
                index[int(hashes[p])].append((t, p))
        self.index = dict(index)
        self.keys = np.array(sorted(index), dtype=np.uint64)

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, start, end, matched words) with spans in code points of text."""
        raw = utf8(text) if text else b""
        w = split_words(raw)
        if len(w) < GRAM:
            return []
        h = grams(w, self.cache)
        at = np.searchsorted(self.keys, h)
        at[at == len(self.keys)] = 0
        hits = np.flatnonzero(self.keys[at] == h)
        if not len(hits):
            return []
        leads: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for d in hits.tolist():
            for t, p in self.index[int(h[d])]:
                leads[t].add((d - p, p))
        found = set()
        for t, places in leads.items():
            for lead in apart(sorted(places), self.band[t], self.least[t]):
                if (m := self.align(t, w, lead)) and self.same_kind(t, w, m):
                    found.add((len(m), t, m[0], m[-1]))
        starts: list[int] = []
        out: list[tuple] = []
        for x in sorted(found, key=lambda x: (-x[0], -x[0] / len(self.words[x[1]]), x[1], x[2])):
            k = bisect_left(starts, x[2])
            if (k == 0 or out[k - 1][3] < x[2]) and (k == len(out) or x[3] < starts[k]):
                starts.insert(k, x[2])
                out.insert(k, x)
        if not out:
            return []
        spans = np.array([m.span() for m in _WORD.finditer(raw.translate(_PLAIN).translate(_SPACE))])
        seen, chars, done = [], 0, 0  # `out` is in order of places, so each byte is decoded once
        for n, t, a, b in out:
            ends = []
            for upto in (int(spans[a, 0]), int(spans[b, 1])):
                chars += len(raw[done:upto].decode("utf-8", "surrogatepass"))
                done = upto
                ends.append(chars)
            seen.append((self.names[t], n / len(self.words[t]), *ends, n))
        return sorted(seen, key=lambda x: (x[2], x[0]))

    def same_kind(self, t: int, w: list[bytes], m: list[int]) -> bool:
        """Enough words are matched, those that tell siblings apart among them, and no mark of a sibling stands between."""
        if len(m) < COVERAGE * len(self.words[t]) or self.marks[t] - Counter(w[d] for d in m):
            return False
        mine = set(m)
        return not any(w[d] in MARKS and d not in mine for d in range(m[0], m[-1] + 1))

    def align(self, t: int, w: list[bytes], lead: int) -> list[int]:
        """Document positions of the longest common subsequence within the band around the diagonal `lead`."""
        tw, band = self.words[t], self.band[t]
        width = 2 * band + 1
        best = [[0] * (width + 1) for _ in range(len(tw) + 1)]
        for i in range(len(tw) - 1, -1, -1):
            row, below = best[i], best[i + 1]
            for k in range(width - 1, -1, -1):  # k: place in the band; document word i + lead + k - band
                d = i + lead + k - band
                skip_doc, skip_tpl = row[k + 1] if k + 1 < width else 0, below[k - 1] if k else 0
                row[k] = max(skip_doc, skip_tpl, below[k] + 1 if 0 <= d < len(w) and w[d] == tw[i] else 0)
        i, k, taken = 0, max(range(width), key=lambda k: (best[0][k], k)), []
        while i < len(tw) and 0 <= k < width and best[i][k]:
            d = i + lead + k - band
            if 0 <= d < len(w) and w[d] == tw[i] and best[i][k] == best[i + 1][k] + 1:
                taken.append(d)
                i += 1
            elif k + 1 < width and best[i][k] == best[i][k + 1]:
                k += 1
            else:
                i, k = i + 1, k - 1
        return taken


_SPACE = bytes(32 if c in b"\t\n\x0b\x0c\r" else c for c in range(256))


def apart(places: list[tuple[int, int]], band: int, least: int) -> list[int]:
    """The first diagonal of each stretch of `band` neighbouring ones that has `least` different fingerprints; places: (diagonal, fingerprint) in order."""
    out: list[int] = []
    i = 0
    while i < len(places):
        j = i
        while j < len(places) and places[j][0] <= places[i][0] + band:
            j += 1
        if len({p for _, p in places[i:j]}) >= least:
            out.append(places[i][0])
        i = j
    return out


class _Scanner:
    def __init__(self, templates: dict[str, str]) -> None:
        self.templates = templates

    def __call__(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        licenses = Licenses(self.templates)
        for doc_id, text in rows:
            for name, coverage, start, end, n in licenses.scan(text):
                yield doc_id, name.split("/")[0], name, coverage, start, end, n


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, license, template, coverage, start, end, n_matched: a row for each license found in docs. templates: texts by license/name."""
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), _Scanner(templates), "doc_id long, license string, template string, coverage double, start long, end long, n_matched long")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
