"""License scans: winnowed template fingerprints in an inverted index, then banded alignment.

A template's fingerprints are the least hashes of three words in every window of two, so a run of four words
shared with a text always has one. Every three words of a text are looked up. A template so short that the words it
may lack can break every run of four has all its pairs of words as fingerprints, which are looked up likewise. Hits of one template whose
diagonals (place in the text less place in the template) lie within the template's band are one candidate, which
a Smith-Waterman alignment inside the band turns into matched words and spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices

GRAM, WINDOW = 3, 2
#: Words of a fingerprint of short templates.
PAIR = 2
#: Templates of more words together are refused: their index is broadcast.
MAX_TEMPLATE_WORDS = 2_000_000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_KNOWN = 200_000

# Notices by which the common public licenses are granted, in the wording their stewards give.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "Apache-2.0-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ "
        "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "GPL-2.0-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.1-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "AGPL-3.0-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "MPL-2.0-title": "Mozilla Public License Version 2.0",
    "EPL-2.0-title": "Eclipse Public License - v 2.0",
    "BSL-1.0-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "CC-BY-4.0-title": "Creative Commons Attribution 4.0 International Public License",
    "CC-BY-SA-4.0-title": "Creative Commons Attribution-ShareAlike 4.0 International Public License",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.",
}

# Identifiers of the SPDX license list, as a source file names them behind its tag.
IDENTIFIERS = (
    "0BSD", "AFL-3.0", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-2.0",
    "BSD-2-Clause", "BSD-2-Clause-Patent", "BSD-3-Clause", "BSD-3-Clause-Clear", "BSD-4-Clause", "BSL-1.0", "CC-BY-3.0",
    "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0",
    "CC0-1.0", "CDDL-1.0", "CDDL-1.1", "CECILL-2.1", "EPL-1.0", "EPL-2.0", "EUPL-1.1", "EUPL-1.2", "GFDL-1.3-only",
    "GFDL-1.3-or-later", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
    "ISC", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL", "MS-RL", "MulanPSL-2.0", "NCSA",
    "ODbL-1.0", "OFL-1.1", "OSL-3.0", "PostgreSQL", "Python-2.0", "Unlicense", "UPL-1.0", "Vim", "WTFPL", "Zlib")
#: Templates of which every word must be met: a word less names another license.
TAGS = {f"SPDX:{i}": f"SPDX-License-Identifier: {i}" for i in IDENTIFIERS}


def _words(text: bytes) -> tuple[list[bytes], list[tuple[int, int]]]:
    """Words in lower case (A-Z) and their byte spans."""
    found = list(_WORD.finditer(text.lower()))
    return [m.group() for m in found], [m.span() for m in found]


def _grams(words: list[bytes], known: dict[bytes, int], size: int = GRAM) -> np.ndarray:
    if len(known) > _KNOWN:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w, 3)
    h = np.array([known[w] for w in words], np.uint64)
    out = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        out = (out ^ h[k:k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
    return out


def winnow(grams: np.ndarray) -> list[int]:
    """Places of the least gram (the last among equals) of every window."""
    if not len(grams):
        return []
    return sorted({max(range(i, min(i + WINDOW, len(grams))), key=lambda j: (-int(grams[j]), j))
                   for i in range(max(1, len(grams) - WINDOW + 1))})


def align(template: list[bytes], text: list[bytes], low: int, high: int) -> tuple[int, int, int, int]:
    """Best local alignment with a diagonal from ``low`` to ``high``: matched words, alignment score, and the
    first and end place in the text. A match counts 2, an edit -1."""
    previous: dict[int, tuple[int, int, int]] = {}  # place in the text -> (score, matched, first place)
    best = (0, 0, 0, 0)
    for i, word in enumerate(template):
        row: dict[int, tuple[int, int, int]] = {}
        for j in range(max(0, i + low), min(len(text), i + high + 1)):
            score, matched, first = previous.get(j - 1, (0, 0, j))
            if score <= 0:
                score, matched, first = 0, 0, j
            same = text[j] == word
            options = [(score + 2, matched + 1, first) if same else (score - 1, matched, first)]
            if j in previous:
                options.append((previous[j][0] - 1, *previous[j][1:]))
            if j - 1 in row:
                options.append((row[j - 1][0] - 1, *row[j - 1][1:]))
            row[j] = top = max(options, key=lambda o: (o[0], o[1], -o[2]))
            if top[0] > best[0]:
                best = (top[0], top[1], top[2], j + 1)
        previous = row
    return best[1], best[0], best[2], best[3]


class TemplateIndex:
    """The inverted index: sorted fingerprints with template and place."""

    def __init__(self, templates: dict[str, str], coverage: float = 0.8, tags: dict[str, str] | None = None):
        both = templates | (tags or {})
        self.names = sorted(both)
        self.words = [_words(both[n].encode())[0] for n in self.names]
        #: Share of the words that each template needs; all of a tag's.
        self.needs = [1.0 if n in (tags or {}) else coverage for n in self.names]
        if sum(map(len, self.words)) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"the templates hold more than {MAX_TEMPLATE_WORDS} words")
        entries: dict[int, list[tuple[int, int, int]]] = {GRAM: [], PAIR: []}
        for t, words in enumerate(self.words):
            lacking = int((1 - self.needs[t]) * len(words) + 1e-9)
            if len(words) >= GRAM and len(words) - lacking <= (GRAM + WINDOW - 2) * (lacking + 1):
                entries[PAIR] += [(int(g), t, p) for p, g in enumerate(_grams(words, {}, PAIR))]
            else:
                grams = _grams(words, {})
                entries[GRAM] += [(int(grams[p]), t, p) for p in winnow(grams)]
        #: By the size of the grams: sorted fingerprints, templates, places.
        self.tables = {}
        for size, rows in entries.items():
            rows.sort()
            self.tables[size] = (np.array([e[0] for e in rows], np.uint64),
                                 *(np.array([e[k] for e in rows], np.int64) for k in (1, 2)))
        self.sets = [frozenset(w) for w in self.words]

    def band(self, t: int) -> int:
        return max(1, len(self.words[t]) // 5)

    def candidates(self, grams: np.ndarray, size: int = GRAM) -> Iterator[tuple[int, int, int]]:
        """(template, least diagonal, largest diagonal) of hits that lie together."""
        keys, templates, places = self.tables[size]
        low = np.searchsorted(keys, grams, "left")
        hit = np.flatnonzero((low < len(keys)) & (keys[np.minimum(low, len(keys) - 1)] == grams)) \
            if len(keys) else np.zeros(0, np.int64)
        if not len(hit):
            return
        many = np.searchsorted(keys, grams[hit], "right") - low[hit]
        entry = np.repeat(low[hit] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        template, diagonal = templates[entry], np.repeat(hit, many) - places[entry]
        order = np.lexsort((diagonal, template))
        held = None
        for t, d in zip(template[order].tolist(), diagonal[order].tolist()):
            if held and held[0] == t and d - held[1] <= self.band(t):
                held[2] = d
            else:
                if held:
                    yield tuple(held)
                held = [t, d, d]
        yield tuple(held)

    def find(self, text: bytes, coverage: float, known: dict[bytes, int]) -> list[tuple]:
        """Matches, the best first taking the places it covers: (template, coverage, words, spans)."""
        words, spans = _words(text)
        found = []
        for size in self.tables:
            for t, low, high in self.candidates(_grams(words, known, size), size):
                template, band = self.words[t], self.band(t)
                least = max(coverage, self.needs[t]) * len(template)
                start = max(0, low - band)
                near = words[start:high + len(template) + band]
                if sum(map(self.sets[t].__contains__, near)) < least:
                    continue
                matched, score, first, end = align(template, near, low - band - start, high + band - start)
                if matched >= least:
                    found.append((-score, -matched / len(template), start + first, start + end, matched, t))
        taken, out = [], []
        for score, share, first, end, matched, t in sorted(found):
            if all(end <= a or b <= first for a, b in taken):
                taken.append((first, end))
                out.append((self.names[t], -share, matched, first, end, spans[first][0], spans[end - 1][1]))
        return sorted(out, key=lambda r: r[3])


def find_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = 0.8,
                  id_col: str = "doc_id", text_col: str = "text", tags: dict[str, str] | None = None) -> DataFrame:
    """One row per match: ``doc_id``, ``template``, ``coverage`` (share of the template's words that the text has
    in order), ``matched_words``, ``first_word`` and ``end_word``, ``first_byte`` and ``end_byte`` in the text.

    ``templates`` match from ``coverage`` on, ``tags`` (a line that names a license by its identifier) only whole; without either
    the built-in notices and tags are taken. Of an expression of several identifiers the first is reported.
    Of matches that overlap, the one with the highest alignment score stays, among equals the one with the higher
    coverage, then the first by place and name. Templates of fewer than three words have no fingerprint and match nothing. Where lacking words and inserted
    ones together leave no run of four words of a longer template, its fingerprints can miss the match. Null and
    empty texts match nothing; long texts are scanned whole; repeated rows and null ids are reported as they are;
    other columns are not read; an empty table gives an empty result.
    """
    index = docs.sparkSession.sparkContext.broadcast(TemplateIndex(
        *((TEMPLATES, coverage, TAGS) if templates is None and tags is None else (templates or {}, coverage, tags))))
    fields = [("template", pa.string()), ("coverage", pa.float64()), ("matched_words", pa.int32()),
              ("first_word", pa.int32()), ("end_word", pa.int32()), ("first_byte", pa.int64()), ("end_byte", pa.int64())]

    def scan(text: Column) -> Column:
        @F.arrow_udf("array<struct<template: string, coverage: double, matched_words: int, first_word: int, "
                     "end_word: int, first_byte: bigint, end_byte: bigint>>")
        def matches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known: dict[bytes, int] = {}
            for texts in batches:
                for rows in text_slices(texts):
                    yield pa.array([[dict(zip((n for n, _ in fields), m)) for m in index.value.find(t or b"", coverage, known)]
                                    for t in rows], pa.list_(pa.struct(fields)))
        return matches(text)
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .select("doc_id", F.inline(scan(F.col("text")))))
