"""License notices in texts by conditional compression.

A stretch of text around licence words is compressed by itself and with each
template as zstandard raw dictionary.  Templates that save nothing are out, the
others are ranked by the bytes they save.  Down that ranking the words of the
text are aligned with a template's, until the differences confirm one.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: licence notices as their licensors word them; fixed values
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
            "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
            '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
            "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
            "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS "
            'IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
            "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
            "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
            "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
]

#: a stretch is looked at if it has one of these
TRIGGER = r"(?i)licen[cs]|copyright|creative\s+commons|redistribut|permission\s"
#: part of a template's words that may differ
MAX_DIFFERENT = 0.1
_LEVEL = 9
#: bytes that a compressor's size tells nothing about: of templates that save so nearly as much, the wording decides
NOISE = 4
#: words on either side of a licence word, in the narrow look at a stretch where no template confirms
NARROW = 24
#: code points of a stretch; a longer one is looked at in parts that overlap by a template's reach
LONGEST = 20_000
_WORD = re.compile(r"[^\W_]+(?:[.'’-][^\W_]+)*")


def words(text: str) -> list[tuple[str, int, int]]:
    """(word in lower case, start, end) of the words of a text."""
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def _costs(template: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Fewest differences of the first i words of ``template`` from a stretch of ``text`` that ends before word j."""
    m, n = len(template), len(text)
    cost = np.zeros((m + 1, n + 1), np.int32)
    cost[:, 0] = np.arange(m + 1)
    steps = np.arange(n + 1)
    for i in range(1, m + 1):
        row = np.minimum(cost[i - 1] + 1, np.concatenate([[i], cost[i - 1, :-1] + (text != template[i - 1])]))
        cost[i] = np.minimum.accumulate(row - steps) + steps
    return cost


def _trace(cost: np.ndarray, template: list[str], text: list[str], end: int) -> tuple[int, int, int, list[str]]:
    """The alignment that ends before word ``end``: (differences, first, end, their list)."""
    i, j, told = len(template), end, []
    while i:
        same = j and template[i - 1] == text[j - 1]
        if j and cost[i, j] == cost[i - 1, j - 1] + (not same):
            i, j = i - 1, j - 1
            if not same:
                told.append(f"{template[i]}>{text[j]}")
        elif cost[i, j] == cost[i - 1, j] + 1:
            i -= 1
            told.append(f"-{template[i]}")
        else:
            j -= 1
            told.append(f"+{text[j]}")
    return int(cost[len(template), end]), j, end, told[::-1]


def alignment(template: list[str], text: list[str]) -> tuple[int, int, int, list[str]]:
    """The stretch of ``text`` with fewest words added, left out or changed: (differences, first, end, their list).

    Of stretches with equally few the first that ends.
    """
    number = {w: i for i, w in enumerate(dict.fromkeys(template))}
    cost = _costs(np.array([number[w] for w in template], np.int32), np.array([number.get(w, -1) for w in text], np.int32))
    return _trace(cost, template, text, int(cost[-1].argmin()))


class Scanner:
    """Finds the templates that stretches of a text come nearest to."""

    def __init__(self, templates=TEMPLATES):
        self.names = [name for name, _ in templates]
        self.words = [[w for w, _, _ in words(t)] for _, t in templates]
        self.number = {w: i for i, w in enumerate(dict.fromkeys(w for own in self.words for w in own))}
        self.coded = [np.array([self.number[w] for w in own], np.int32) for own in self.words]
        self.reach = 2 * max((len(t) for _, t in templates), default=0)
        self.trigger = re.compile(TRIGGER)
        params = zstandard.ZstdCompressionParameters.from_level(_LEVEL, min_match=3, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.alone = zstandard.ZstdCompressor(compression_params=params)
        self.given = [zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(
            (" ".join(w) + " ").encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for w in self.words]

    def stretches(self, text: str) -> Iterator[tuple[int, int]]:
        """Parts of the text around licence words, as far as any template reaches; parts that touch are one."""
        for lo, hi in self._around(text):
            step = max(LONGEST, 2 * self.reach)
            while hi - lo > step:
                yield lo, lo + step
                lo += step - self.reach
            yield lo, hi

    def _around(self, text: str) -> Iterator[tuple[int, int]]:
        lo = hi = -1
        for m in self.trigger.finditer(text):
            a, b = max(0, m.start() - self.reach), min(len(text), m.end() + self.reach)
            if a > hi:
                if hi >= 0:
                    yield lo, hi
                lo = a
            hi = b
        if hi >= 0:
            yield lo, hi

    def _sizes(self, said: list[str]) -> tuple[int, list[int]]:
        """Compressed size of the words alone, and with each template."""
        plain = " ".join(said).encode()
        return len(self.alone.compress(plain)), [len(c.compress(plain)) for c in self.given]

    def _confirms(self, told: list[str]) -> bool:
        """No word differs that has a number (a version is no wording)."""
        return not any(c.isdigit() for t in told for c in t)

    def _aligned(self, k: int, own: list[str], limit: float, confirmed: bool) -> list[tuple[int, int, int, list[str]]]:
        """Alignments of template ``k`` with fewest differences, at most ``limit``, that do not overlap.

        Confirmed: those that confirm.  A template that lacks more of its words in
        the stretch than may differ has no such alignment.
        """
        template, text = self.coded[k], np.array([self.number.get(w, -1) for w in own], np.int32)
        there = np.zeros(len(self.number) + 1, bool)  # the last place takes the words of no template
        there[text] = True
        if not len(template) or np.count_nonzero(~there[template]) > limit:
            return []
        cost, kept = _costs(template, text), []
        ends = np.flatnonzero(cost[-1] <= limit)
        for end in ends[np.argsort(cost[-1][ends], kind="stable")].tolist():
            if kept and cost[-1, end] > kept[0][0]:
                break
            one = _trace(cost, self.words[k], own, end)
            if max(one[1], kept[-1][2] if kept else 0) == one[1] < end and (not confirmed or self._confirms(one[3])):
                kept.append(one)
        return kept

    def ranked(self, said: list[str]) -> tuple[int, list[tuple[int, int]]]:
        """Compressed size of the words alone, and (size, template) of the templates that save bytes, most saved first.

        Of templates that save equally much the longer.
        """
        alone, sizes = self._sizes(said)
        return alone, sorted(((size, k) for k, size in enumerate(sizes) if size < alone), key=lambda r: (r[0], -len(self.words[r[1]]), r[1]))

    def _winner(self, said: list[str], confirmed: bool):
        """(template, bytes alone, bytes given, alignments) of the first of the ranking whose wording is near enough, else None."""
        alone, rank = self.ranked(said)
        best = None
        for size, k in rank:
            if best is not None and size > best[2] + NOISE:
                break
            limit = MAX_DIFFERENT * len(self.words[k]) if confirmed else len(self.words[k]) // 2
            found = self._aligned(k, said, limit, confirmed)
            if found and (best is None or found[0][0] * len(self.words[best[0]]) < best[3][0][0] * len(self.words[k])):
                best = (k, alone, size, found)
        return best

    def _narrow(self, own: list[tuple[str, int, int]], text: str) -> list[tuple[int, int]]:
        """Words around each licence word of a stretch, apart: (from, to)."""
        at, spans = [a for _, a, _ in own], []
        for m in self.trigger.finditer(text, own[0][1], own[-1][2]):
            i = bisect_right(at, m.start())
            spans.append((max(0, i - NARROW), min(len(own), i + NARROW)))
        return spans

    def _look(self, own: list[tuple[str, int, int]], text: str):
        """(first word, winner, confirmed) in a stretch: all of it, then around each licence word, then whatever is nearest."""
        said = [w for w, _, _ in own]
        won = self._winner(said, True)
        if won:
            return 0, won, True
        seen: set[tuple[str, ...]] = set()
        spans = []
        for lo, hi in self._narrow(own, text):
            if (part := tuple(said[lo:hi])) not in seen:
                seen.add(part)
                spans.append((lo, hi))
                if won := self._winner(said[lo:hi], True):
                    return lo, won, True
        if won := self._winner(said, False):
            return 0, won, False
        for lo, hi in spans:
            if won := self._winner(said[lo:hi], False):
                return lo, won, False
        return None

    def find(self, text: str) -> list[tuple]:
        """(start, length, licence, wording, bytes alone, bytes given, differences, their list, confirmed) of the notices."""
        out = []
        for lo, hi in self.stretches(text):
            parts = [[(w, a + lo, b + lo) for w, a, b in words(text[lo:hi])]]
            while parts:
                own = parts.pop()
                if not own or not self.trigger.search(text[own[0][1]:own[-1][2]]):
                    continue
                got = self._look(own, text)
                if got is None:
                    continue
                base, (k, alone, given, found), good = got
                at = 0
                for n, first, end, told in sorted(found, key=lambda f: f[1]):
                    first, end = base + first, base + end
                    out.append((own[first][1], own[end - 1][2] - own[first][1], self.names[k], k, alone, given, n, " ".join(told), good))
                    parts.append(own[at:first])  # what is before and behind may hold others
                    at = end
                parts.append(own[at:])
        out, clear = sorted(set(out), key=lambda f: (not f[-1], f[6], f)), []
        for f in out:  # overlapping parts may tell one notice twice: the clearest counts
            if all(f[0] >= g[0] + g[1] or g[0] >= f[0] + f[1] for g in clear if abs(g[0] - f[0]) < LONGEST):
                clear.append(f)
        return sorted(clear)


_COLUMNS = [("start", pa.int64()), ("length", pa.int64()), ("license", pa.string()), ("wording", pa.int32()), ("bytes_alone", pa.int64()),
            ("bytes_given", pa.int64()), ("n_differences", pa.int32()), ("differences", pa.string()), ("confirmed", pa.bool_())]
_FOUND = ("doc_id long, start long, length long, license string, wording int, bytes_alone long, bytes_given long, n_differences int, "
          "differences string, confirmed boolean")


def _scan(templates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = scanner.find(text)
                rows += [i] * len(own)
                found += own
            cols = list(zip(*found)) if found else [()] * len(_COLUMNS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64()))] + [pa.array(c, kind) for c, (_, kind) in zip(cols, _COLUMNS)],
                names=["doc_id"] + [n for n, _ in _COLUMNS])
    return run


def scan_licenses(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per notice found: doc_id, start, length, license, wording, bytes_alone, bytes_given,
    n_differences, differences, confirmed.

    start and length are code points of the text; wording numbers the template;
    bytes_alone and bytes_given are the stretch's compressed size without and
    with it; differences lists the words changed (``a>b``), left out (``-a``) and
    added (``+b``).  Confirmed notices differ from their template in at most a
    tenth of its words, and in none with a digit; others, in at most half, are told unconfirmed.  A text
    may have any number of notices; null and empty texts and texts without
    licence words have none; rows without id and repeated rows are scanned each;
    texts count whole; an empty table gives no rows; other columns are not read.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.filter(F.col("text").rlike(TRIGGER)).mapInArrow(_scan(list(templates)), _FOUND)
