"""Licence scan: units of text against licence templates by Dice coefficient over word bigrams.

A unit is a line, or a block between blank lines.  Units and templates are normalised
(lower case, runs of anything but a-z and 0-9 become one space, digit runs become 0) and turned
into sets of word bigrams.  Dice(A, B) = 2 |A and B| / (|A| + |B|) can reach the threshold only if
the sizes differ by a factor of at most (2 - t) / t, so only templates inside that bound are
compared, and a unit outside every bound is skipped before its bigrams are made.

A licence that no unit shows is looked for in windows of the whole text's normalised words (of as
many words as the size bound allows, wherever lines, comment marks and CRLF fall): a notice inside
a longer line, or wrapped over lines in a longer block.  Windows inside a unit that shows a licence
are left out (the unit was judged whole); overlapping ones that reach the threshold count as one
unit, with the best Dice.  ``HEADERS`` are compared in windows only.  SQL
tells the units, not the windows.

Null and empty texts have no units; ties keep every template that reaches the threshold; rows
that are repeated are scanned each; a null doc_id stays null; an empty table gives no rows;
only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sortpub.llm.text import small_batches

THRESHOLD = 0.8

# Licence notices (public texts).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
                         "except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "mit": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 'associated documentation files (the "Software"), to deal in the Software without restriction, '
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                 "furnished to do so, subject to the following conditions:",
    "gpl": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                  "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                  "License, or (at your option) any later version.",
    "lgpl": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl": "This work is licensed under the GNU Affero General Public License, version 3.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met:",
    "bsd-notice": "Licensed under the BSD 3-Clause License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
           "to this work.",
}

# The standard file headers as a whole (public texts).
HEADERS = {
    "apache-2.0-notice": TEMPLATES["apache-2.0-header"] + " Unless required by applicable law or agreed to in writing, "
                         'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
                         "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                         "governing permissions and limitations under the License.",
    "gpl-notice": TEMPLATES["gpl-header"] + " This program is distributed in the hope that it will be useful, but WITHOUT "
                  "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
                  "See the GNU General Public License for more details. You should have received a copy of the GNU General "
                  "Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
}

# Bounds are taken a little wider than floating point gives them; the Dice value itself decides.
_EPS = 1e-6
_OTHER = re.compile(r"[^a-z0-9]+")
_DIGITS = re.compile(r"[0-9]+")


def normalise(text: str) -> list[str]:
    return _DIGITS.sub("0", _OTHER.sub(" ", text.lower())).split()


def bigrams(words: list[str]) -> frozenset[tuple[str, str]]:
    return frozenset(zip(words, words[1:]))


def units(text: str) -> list[str]:
    """Lines, and blocks of several lines."""
    return text.split("\n") + [b for b in text.split("\n\n") if "\n" in b]


def _word_spans(text: str, chosen: list[int]) -> list[tuple[int, int]]:
    """First word and end of the chosen ``units``, among the words of ``text``."""
    if not chosen:
        return []
    spans: list[tuple[int, int]] = []
    for sep in ("\n", "\n\n"):
        at = 0
        for part in text.split(sep):
            n = len(normalise(part))
            if sep == "\n" or "\n" in part:
                spans.append((at, at + n))
            at += n
    return [spans[i] for i in sorted(set(chosen))]


class Scanner:
    """Templates by size; ``scan`` returns {name: (dice, units that reach the threshold)}."""

    def __init__(self, templates: dict[str, str], threshold: float, headers: dict[str, str] | None = None):
        self.threshold = threshold
        rows = sorted((len(b), name, b) for name, t in templates.items() if (b := bigrams(normalise(t))))
        self.sizes, self.rows = [r[0] for r in rows], rows
        self.ratio = (2 - threshold) / threshold
        # A unit of u characters has u / 2 words at most; b bigrams need b + 1 words of one
        # character and the spaces between.
        self.least_chars = 2 * (min(self.sizes, default=0) / self.ratio - _EPS) + 1
        self.words = {w for _, _, b in rows for pair in b for w in pair}
        more = [(len(b), name, b) for name, t in (headers or {}).items() if (b := bigrams(normalise(t)))]
        self.sought = rows + more
        self.pairs = frozenset(pair for _, _, b in self.sought for pair in b)

    def scan(self, text: str) -> dict[str, tuple[float, int]]:
        found: dict[str, tuple[float, int]] = {}
        shown: list[int] = []
        for at, unit in enumerate(units(text)):
            if len(unit) < self.least_chars:
                continue
            words = normalise(unit)
            # Dice >= t needs t / 2 of the larger set in common: every common bigram has its
            # first word among the templates' words.
            if 2 * sum(w in self.words for w in words) < self.threshold * (len(set(words)) - 1) - _EPS:
                continue
            have = bigrams(words)
            n = len(have)
            for size, name, want in self.rows[bisect_left(self.sizes, n / self.ratio - _EPS):bisect_right(self.sizes, n * self.ratio + _EPS)]:
                dice = 2 * len(have & want) / (n + size)
                if dice >= self.threshold:
                    best, k = found.get(name, (0.0, 0))
                    found[name] = (max(best, dice), k + 1)
                    shown.append(at)
        self._scan_windows(text, found, shown)
        return found

    def _scan_windows(self, text: str, found: dict[str, tuple[float, int]], shown: list[int]) -> None:
        """Add the licences that only windows of ``text`` show; ``shown``: the units that show one."""
        words = normalise(text)
        present = self.pairs.intersection(zip(words, words[1:]))
        if not present:
            return
        places = None
        for size, name, want in self.sought:
            # A window of n bigrams with k in common has n >= k and 2 k >= t (n + size), so
            # n >= size / ratio and k >= size / ratio; it begins and ends with a common one at best.
            need = size / self.ratio - _EPS
            if name in found or len(want & present) < need:
                continue
            if places is None:
                places = [(i, g) for i, g in enumerate(zip(words, words[1:])) if g in present]
                spans = _word_spans(text, shown)
                inside = [0] * len(words)            # where the widest such unit around a word ends
                for a, b in spans:
                    inside[a:b] = [max(b, e) for e in inside[a:b]]
            at = [(i, g) for i, g in places if g in want]
            longest = int(size * self.ratio + _EPS)
            best, k, end = 0.0, 0, -1
            for x, (begin, _) in enumerate(at):
                y = x + max(1, math.ceil(need)) - 1
                if y >= len(at) or at[y][0] - begin >= longest:
                    continue
                common: set[tuple[str, str]] = set()
                have: set[tuple[str, str]] = set()
                done = begin
                for i, g in at[x:]:
                    if i - begin >= longest:
                        break
                    common.add(g)
                    have.update(zip(words[done:i + 1], words[done + 1:i + 2]))
                    done = i + 1
                    dice = 2 * len(common) / (len(have) + size)
                    if dice >= self.threshold and i + 2 > inside[begin]:
                        k += begin > end             # a window apart from those before
                        best, end = max(best, dice), max(end, i)
            if k:
                found[name] = (best, k)


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice (best unit), n_units: a row per document and licence found."""
    small_batches(docs.sparkSession)
    templates, headers = (TEMPLATES, HEADERS) if templates is None else (templates, {})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold, headers)
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for name, (dice, k) in sorted(scanner.scan(text.as_py() or "").items()):
                    for col, v in zip(out, (doc, name, dice, k)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.float64()),
                 pa.array(out[3], pa.int64())], names=["doc_id", "license", "dice", "n_units"])

    return (docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
                .mapInArrow(task, "doc_id long, license string, dice double, n_units long"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _norm_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'), '[0-9]+', '0', 'g')"


SQL = f"""
WITH templates(name, body) AS (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in TEMPLATES.items())}),
units AS (
  SELECT doc_id, unnest(list_concat(string_split(text, chr(10)),
    list_filter(string_split(text, chr(10) || chr(10)), lambda b: contains(b, chr(10))))) AS u
  FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT row_number() OVER () AS id, doc_id, u FROM units),
words AS (SELECT id, doc_id, list_filter(string_split({_norm_sql('u')}, ' '), lambda w: w <> '') AS w FROM numbered),
grams AS (
  SELECT id, doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM words WHERE len(w) > 1),
tw AS (SELECT name, list_filter(string_split({_norm_sql('body')}, ' '), lambda w: w <> '') AS w FROM templates),
tg AS (SELECT name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM tw),
shared AS (
  SELECT a.id, a.doc_id, a.n, b.name, b.m, count(*) AS k
  FROM (SELECT id, doc_id, len(g) AS n, unnest(g) AS x FROM grams) a
  JOIN (SELECT name, len(g) AS m, unnest(g) AS x FROM tg) b ON a.x = b.x
  GROUP BY ALL),
scored AS (SELECT doc_id, id, name, 2 * k / (n + m)::DOUBLE AS dice FROM shared)
SELECT doc_id, name AS license, max(dice) AS dice, count(*) AS n_units
FROM scored WHERE dice >= {THRESHOLD} GROUP BY doc_id, name
"""
