"""Licence scan: text segments compared with licence templates by Dice coefficient over word bigrams.

A segment is a line, or a paragraph (a run of lines without a blank line
between them) of several lines.  In a paragraph that is no match as a whole,
the runs of words that lie in no matching line are searched for windows of any
size that reach the same Dice: a notice may be a sentence of a longer line, or
be wrapped inside a longer comment.  Words are runs of ASCII letters and digits and
non-ASCII characters after lower-casing A-Z; a segment's set holds its distinct
pairs of neighbouring words (its only word, if it has one).  Since
dice = 2 |A and B| / (|A| + |B|) >= t needs |A| between t / (2 - t) * |B| and
(2 - t) / t * |B|, segments whose size fits no template are not compared as a
whole, and a segment meets only the templates whose bounds it is in.  For the
same reason a match holds at least t / (2 - t) * |B| of the template's bigrams;
texts without any word of a set that leaves fewer bigrams are passed over.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package

THRESHOLD = 0.8
#: On lower-cased UTF-8: ASCII letters and digits, and the bytes of non-ASCII characters.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BLANK_LINE = re.compile(rb"\n[ \t\r]*\n")
#: Words that are taken last when texts are picked by a template's words.
COMMON = frozenset(b"a an and any are as at by do following for from in is it may not of on or that the this to under use with without work you".split())

# Customary licence notices and paragraphs of licence texts (public texts), by SPDX-like id.
NOTICES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    "gpl-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    ),
    "lgpl-2.1": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",),
    "lgpl-3.0": ("This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "agpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "epl-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "bsd-3-clause": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",),
    "bsl-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc0-1.0": (
        "This work is dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "all-rights-reserved": ("All rights reserved.",),
}
# The identifiers that source headers name a licence by.
IDENTIFIERS: dict[str, tuple[str, ...]] = {
    "mit": ("MIT",), "apache-2.0": ("Apache-2.0",), "mpl-2.0": ("MPL-2.0",), "epl-2.0": ("EPL-2.0",),
    "gpl-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"), "gpl-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "lgpl-2.1": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"), "lgpl-3.0": ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "agpl-3.0": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), "bsd": ("BSD-2-Clause",), "bsd-3-clause": ("BSD-3-Clause",),
    "isc": ("ISC",), "zlib": ("Zlib",), "bsl-1.0": ("BSL-1.0",), "unlicense": ("Unlicense",),
    "cc-by-4.0": ("CC-BY-4.0",), "cc-by-nc-4.0": ("CC-BY-NC-4.0",), "cc-by-sa-4.0": ("CC-BY-SA-4.0",), "cc0-1.0": ("CC0-1.0",),
}
TAG = "SPDX-License-Identifier:"
TEMPLATES: dict[str, tuple[str, ...]] = {name: texts + tuple(f"{TAG} {x}" for x in IDENTIFIERS.get(name, ())) for name, texts in NOTICES.items()}

# Words that tell sibling licences apart, by a word of their template: a match has one of each group that the template has, and none of the others.
SIBLINGS: tuple[tuple[frozenset[bytes], tuple[frozenset[bytes], ...]], ...] = (
    (frozenset([b"cc", b"creative"]), (frozenset([b"noncommercial", b"commercial", b"nc"]), frozenset([b"sharealike", b"alike", b"sa"]), frozenset([b"noderivatives", b"noderivs", b"derivatives", b"nd"]))),
    (frozenset([b"gnu", b"gpl"]), (frozenset([b"lesser", b"library", b"lgpl"]), frozenset([b"affero", b"agpl"]))),
)
VERSION = re.compile(r"-([0-9]+)(?:\.[0-9]+)*$")  # of an id; a match has its first number if the template has it


def telling(name: str, words: set[bytes]) -> tuple[tuple[frozenset[bytes], ...], frozenset[bytes]]:
    """(groups of which a match has a word each, words that no match has) of a template."""
    need, never = [], frozenset()
    for family, groups in SIBLINGS:
        if family & words:
            need += [g for g in groups if g & words]
            never = never.union(*[g for g in groups if not g & words])
    if (m := VERSION.search(name)) and m.group(1).encode() in words:
        need.append(frozenset([m.group(1).encode()]))
    tag = frozenset(WORD.findall(TAG.encode().lower()))
    if tag <= words:  # the tag alone reaches the dice of a short identifier
        need += [frozenset([w]) for w in sorted(words - tag)]
    return tuple(need), never


def bigrams(words: list[bytes]) -> set[tuple[bytes, ...]]:
    """Distinct pairs of neighbouring words (the only word of a one-word text)."""
    return set(zip(words, words[1:], strict=False)) if len(words) > 1 else {(w,) for w in words}


def anchors(grams: set[tuple[bytes, ...]], fewest: int) -> set[bytes]:
    """Words without which a text has less than ``fewest`` of the bigrams."""
    left, out = set(grams), set()
    while len(left) >= fewest:
        held: dict[bytes, int] = {}
        for w in {(w, g) for g in left for w in g}:
            held[w[0]] = held.get(w[0], 0) + 1
        word = min(held, key=lambda w: (w in COMMON or w.isdigit(), -held[w], -len(w), w))
        left = {g for g in left if word not in g}
        out.add(word)
    return out


class Templates:
    """Template texts with their size bounds, and the templates of every bigram."""

    def __init__(self, templates: dict[str, tuple[str, ...]], threshold: float):
        self.threshold = threshold
        self.rows: list[tuple[str, int, int, int]] = []  # licence, size, fewest and most bigrams of a match
        self.of: dict[tuple[bytes, ...], list[int]] = {}
        self.telling: list[tuple[tuple[frozenset[bytes], ...], frozenset[bytes]]] = []
        picked: set[bytes] = set()
        for name, texts in templates.items():
            for text in texts:
                words = WORD.findall(text.encode().lower())
                grams = bigrams(words)
                self.telling.append(telling(name, set(words)))
                low, high = threshold / (2 - threshold) * len(grams), (2 - threshold) / threshold * len(grams)
                for g in grams:
                    self.of.setdefault(g, []).append(len(self.rows))
                self.rows.append((name, len(grams), math.ceil(low - 1e-9), math.floor(high + 1e-9)))
                picked |= anchors(grams, math.ceil(low - 1e-9))
        self.fewest = min((r[2] for r in self.rows), default=0)
        self.most = max((r[3] for r in self.rows), default=-1)
        self.known = set(self.of)
        self.anchor = re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + b"|".join(sorted(picked)) + rb")(?![0-9a-z\x80-\xff])" if picked else rb"(?!)")

    def told(self, t: int, words) -> bool:
        """Whether the words that tell template ``t`` from its siblings are there, and none of theirs."""
        need, never = self.telling[t]
        return not never.intersection(words) and all(not g.isdisjoint(words) for g in need)

    def match(self, words: list[bytes]) -> tuple[dict[str, float], str | None]:
        """Best dice per licence that reaches the threshold, and the best licence told from its siblings, for the words of one segment."""
        # n words have at most n - 1 bigrams, and at least one less than there are different words.
        if max(len(words) - 1, 1) < self.fewest or len(set(words)) - 1 > self.most:
            return {}, None
        grams = bigrams(words)
        n = len(grams)
        if not self.fewest <= n <= self.most:
            return {}, None
        both: dict[int, int] = {}
        for g in grams & self.known:
            for t in self.of[g]:
                both[t] = both.get(t, 0) + 1
        best: dict[str, float] = {}
        told: dict[str, float] = {}
        for t, k in both.items():
            name, size, fewest, most = self.rows[t]
            if fewest <= n <= most and 2 * k >= self.threshold * (n + size):
                best[name] = max(best.get(name, 0.0), 2.0 * k / (n + size))
                if self.told(t, words):
                    told[name] = max(told.get(name, 0.0), 2.0 * k / (n + size))
        return best, min(told, key=lambda name: (-told[name], name), default=None)

    def windows(self, words: list[bytes]) -> list[tuple[float, str, int, int]]:
        """(dice, licence, first word, end) of the told windows that reach the threshold, best first, without overlaps."""
        pairs = list(zip(words, words[1:], strict=False))
        found = [(1.0, self.rows[t][0], p, p + 1) for p, w in enumerate(words) for t in self.of.get((w,), ())]
        places: dict[int, list[int]] = {}
        for p, g in enumerate(pairs):
            for t in self.of.get(g, ()):
                places.setdefault(t, []).append(p)
        for t, own in places.items():
            name, size, fewest, most = self.rows[t]
            if len({pairs[p] for p in own}) < fewest:
                continue
            shared = set(own)
            for i in own:  # the best window begins and ends with a bigram of the template
                seen, k, best = set(), 0, None
                for j in range(i, len(pairs)):
                    if j > i and pairs[j] == pairs[i]:  # without its first word the window holds the same bigrams
                        break
                    if pairs[j] not in seen:
                        seen.add(pairs[j])
                        k += j in shared
                        if len(seen) > most:
                            break
                        dice = 2.0 * k / (len(seen) + size)
                        if j in shared and 2 * k >= self.threshold * (len(seen) + size) and (best is None or dice > best[0]):
                            best = (dice, name, i, j + 2)
                        if k == size:
                            break
                if best and self.told(t, words[i : best[3]]):
                    found.append(best)
        taken, out = bytearray(len(words)), []
        for dice, name, i, j in sorted(found, key=lambda x: (-x[0], x[1], x[2], x[3])):
            if not any(taken[i:j]):
                taken[i:j] = b"\1" * (j - i)
                out.append((dice, name, i, j))
        return out

    def scan(self, low: bytes) -> list[tuple[str, int, str, float, bool, int, int]]:
        """(kind, pos, licence, dice, chosen, first byte, end) of all matches in a lower-cased text."""
        if not self.anchor.search(low):
            return []
        out, starts, ends = [], [], []
        start = 0
        for pos, line in enumerate(low.split(b"\n")):
            end = start + len(line)
            if self.anchor.search(line):
                found, chosen = self.match(WORD.findall(line))
                out += [("line", pos, name, dice, name == chosen, start, end) for name, dice in found.items()]
                if chosen:
                    starts.append(start)
                    ends.append(end)
            start = end + 1
        start = 0
        for pos, blank in enumerate([*BLANK_LINE.finditer(low), None]):
            end = blank.start() if blank else len(low)
            if self.anchor.search(low, start, end):
                spans = [m.span() for m in WORD.finditer(low, start, end)]
                whole, chosen = self.match([low[a:b] for a, b in spans]) if low.find(b"\n", start, end) >= 0 else ({}, None)
                out += [("paragraph", pos, name, dice, name == chosen, start, end) for name, dice in whole.items()]
                run: list[tuple[int, int]] = []
                for a, b in [] if chosen else [*spans, (end, end)]:
                    at = bisect_right(starts, a) - 1
                    if a < b and not (at >= 0 and a < ends[at]):
                        run.append((a, b))
                    elif run:
                        found = self.windows([low[x:y] for x, y in run])
                        out += [("part", run[i][0], name, dice, True, run[i][0], run[j - 1][1]) for dice, name, i, j in found]
                        run = []
            start = blank.end() if blank else end
        return out


def find_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, mark, kind, pos, segment, license, dice, chosen``: every segment's best template of each licence that reaches the threshold.

    ``chosen`` is true for one licence of a segment at most: the one of highest
    dice (ties by name) among those whose telling words are there (version,
    noncommercial, ...) without words that tell a sibling.

    ``kind`` is line or paragraph, ``pos`` its number in the text (from 0); or
    kind is part, a window inside a paragraph, and pos its first byte in the
    text (parts are chosen, and don't overlap each other or lines and
    paragraphs with a chosen licence).
    ``mark`` is a hash of the text (rows that share an id are told apart by it).
    Null and empty texts have no segments with words; repeated rows give one
    set of matches; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    index = Templates(templates or TEMPLATES, threshold)

    def scan(batches):
        for batch in batches:
            out = []
            for doc, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = text.as_buffer()
                low = raw.to_pybytes().lower() if raw else b""  # bytes.lower() touches A-Z only
                for kind, pos, name, dice, chosen, start, end in index.scan(low):
                    out.append((doc, mark, kind, pos, raw.to_pybytes()[start:end].decode(), name, round(dice, 6), chosen))
            cols = list(zip(*out, strict=True)) if out else [()] * 8
            types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "mark", "kind", "pos", "segment", "license", "dice", "chosen"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(scan, "doc_id long, mark long, kind string, pos int, segment string, license string, dice double, chosen boolean")
    return found.distinct()


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, n_matches, licenses, best_dice`` for every row of ``docs``, over the chosen licences (sorted, comma-joined)."""
    hits = find_licenses(docs, id_col, text_col, **options).where("chosen")
    found = hits.groupBy("doc_id", "mark").agg(
        F.count("*").alias("n_matches"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"), F.max("dice").alias("best_dice")
    )
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("mark")).alias("b")
    out = base.join(found.alias("f"), F.expr("b.doc_id <=> f.doc_id and b.mark = f.mark"), "left")
    return out.select("b.doc_id", F.coalesce("n_matches", F.lit(0)).alias("n_matches"), F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("best_dice", F.lit(0.0)).alias("best_dice"))
