"""Licence scans by the Dice coefficient over word bigrams (dealt operator 6).

Every whole text is cut into units: each line, each block (a run of lines that are not
blank) and the text itself.  A unit is normalised to its lower-cased words of letters and
digits; its set of word bigrams is compared to each template's:

    dice = 2 * common / (size of the one + size of the other)

A template can only reach the threshold t with a unit whose set has between t / (2 - t) and
(2 - t) / t times its size, which rules out most templates before any set is compared.
Bigrams of all lines are first looked up in the templates' union (sorted hashes); units
without one have a coefficient of 0 and go no further.

A unit gives one row, for its best template (ties: by name).  A block that is one line, or a
text that is one block, is reported once, as the smaller unit.

A licence need not be a unit, so windows are looked for over the whole text as well: runs of
words that begin and end with a bigram of a template and have at most (2 - t) / t times its
words.  From each begin the window with the highest coefficient counts (ties: the shortest); of
those that reach the threshold the one with most common bigrams, weighted by its coefficient,
comes first.  A window is left out if it overlaps one of the same licence, or if over half of
its common bigrams are explained: they lie in a unit or window reported before and belong to its
template (so the BSD-2 passage of a BSD-3 text is no second licence).

Defined cases: null, empty and blank texts have no units; a unit of one word has no bigram
and matches nothing; equal lines give a row each; repeated rows are scanned as often as
they come; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import chunks, hash_spans, mix, separators, spans

THRESHOLD = 0.85
_WORDS = separators(string.ascii_letters + string.digits)

# Notices and opening passages of public licences, by SPDX-like id.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details. You should have received a copy of the GNU General Public License along "
        "with this program. If not, see <https://www.gnu.org/licenses/>."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may "
        "be used to endorse or promote products derived from this software without specific prior written permission."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution."),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def _bigrams(word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(word[:-1] * np.uint64(0xD6E8FEB86659FD93) + word[1:])


def template_sets(templates: dict[str, str]) -> list[tuple[str, np.ndarray]]:
    """(name, sorted distinct bigram hashes) of the templates that have any, by name."""
    out = []
    for name in sorted(templates):
        raw = np.frombuffer(templates[name].encode(), np.uint8)
        starts, ends, _ = spans(raw, np.array([0, len(raw)]), _WORDS)
        grams = np.unique(_bigrams(hash_spans(raw, starts, ends)))
        if len(grams):
            out.append((name, grams))
    return out


def template_words(templates: dict[str, str]) -> dict[str, int]:
    raw = {name: np.frombuffer(t.encode(), np.uint8) for name, t in templates.items()}
    return {name: len(spans(r, np.array([0, len(r)]), _WORDS)[0]) for name, r in raw.items()}


def best_template(grams: np.ndarray, sets: list[tuple[str, np.ndarray]], least: float) -> tuple[float, str] | None:
    """The best template of a unit's distinct bigrams, if one reaches ``least``."""
    best = None
    for name, own in sets:
        if min(len(own), len(grams)) * (2 - least) < least * max(len(own), len(grams)) * (1 - 1e-12):
            continue  # too small or too large for the threshold
        dice = 2 * len(np.intersect1d(own, grams, assume_unique=True)) / (len(own) + len(grams))
        if dice >= least and (best is None or dice > best[0]):
            best = dice, name
    return best


def _windows(grams: np.ndarray, doc_of: np.ndarray, at: np.ndarray, ids: np.ndarray, sets: list[tuple[str, np.ndarray]],
             member: np.ndarray, longest: list[int], explained: np.ndarray, least: float) -> list[tuple[int, int, int, float]]:
    """(template, first bigram, last bigram, dice) of the windows to report.  ``at`` are the bigrams that are in
    any template, ``ids`` their places in ``member`` (template x bigram); ``explained`` says which
    lie in a reported unit of each template (template x ``at``)."""
    found = []
    done = (explained & member[:, ids]).any(axis=0)
    stop = np.searchsorted(doc_of, doc_of[at], side="right") - 1  # a text's last word begins no bigram
    for k, (_, own) in enumerate(sets):
        here = np.flatnonzero(member[k][ids])
        pos, m = at[here], len(own)
        fewest = int(np.ceil(least * m / (2 - least) * (1 - 1e-12)))
        if len(pos) < fewest:
            continue
        end = np.searchsorted(pos, np.minimum(pos + longest[k], stop[here]))
        new = np.concatenate([[0], np.cumsum(~done[here])])
        many = (end - np.arange(len(pos)) >= fewest) & (2 * (new[end] - new[:-1]) >= fewest)
        for i in np.flatnonzero(many).tolist():
            a, b = int(pos[i]), int(pos[end[i] - 1]) + 1
            first = np.zeros(b - a, dtype=bool)
            first[np.unique(grams[a:b], return_index=True)[1]] = True
            common = np.zeros(b - a, dtype=np.int64)
            common[pos[i : end[i]] - a] = 1
            common = np.cumsum(common * first)
            dice = 2 * common / (m + np.cumsum(first))
            best = int(np.argmax(dice))
            if dice[best] >= least:
                found.append((float(common[best] * dice[best]), k, a, a + best, float(dice[best])))
    out: list[tuple[int, int, int, float]] = []
    for _, k, a, b, dice in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
        if any(k == o[0] and a <= o[2] and o[1] <= b for o in out):
            continue
        lo, hi = np.searchsorted(at, a), np.searchsorted(at, b, side="right")
        own = member[k][ids[lo:hi]]
        if 2 * len(np.unique(ids[lo:hi][own & ~done[lo:hi]])) < len(np.unique(ids[lo:hi][own])):
            continue
        done[lo:hi] |= own
        out.append((k, a, b, dice))
    return out


def _units(blank: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """(kind, first line, last line) of a text's blocks that are more than a line, and of the text if it is more than a block."""
    full = np.flatnonzero(~blank)
    if not len(full):
        return
    cut = np.flatnonzero(np.diff(full) > 1)
    begin, end = full[np.concatenate([[0], cut + 1])], full[np.concatenate([cut, [len(full) - 1]])]
    for b, e in zip(begin.tolist(), end.tolist(), strict=True):
        if e > b:
            yield "block", b, e
    if len(begin) > 1:
        yield "text", int(full[0]), int(full[-1])


def license_hits(docs: DataFrame, templates: dict[str, str] | None = None, least: float = THRESHOLD) -> DataFrame:
    """One row for each unit or window that matches: doc_id, unit (line, block, text, window), first_line
    and n_lines (from 0), license, dice and the unit's text."""
    sets = template_sets(TEMPLATES if templates is None else templates)
    union = np.unique(np.concatenate([g for _, g in sets])) if sets else np.zeros(0, np.uint64)
    member = np.array([np.isin(union, g) for _, g in sets]).reshape(len(sets), len(union))
    place = {name: k for k, (name, _) in enumerate(sets)}
    words = template_words(TEMPLATES if templates is None else templates)
    longest = [int(words[name] * (2 - least) / least) - 1 for name, _ in sets]  # bigrams of a window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for row, raw, at in chunks(batch.column(1)):
                starts, ends, _ = spans(raw, at, _WORDS)
                if len(starts) < 2 or not len(union):
                    continue
                # lines: a text begins one, and every line break ends one
                edge = np.unique(np.concatenate([at, np.flatnonzero(raw == 10) + 1]))
                line = np.searchsorted(edge, starts, side="right") - 1
                grams, together = _bigrams(hash_spans(raw, starts, ends)), line[:-1] == line[1:]
                near = np.minimum(np.searchsorted(union, grams), len(union) - 1)
                doc_of = np.searchsorted(at, starts, side="right") - 1
                hit = (union[near] == grams) & (doc_of[:-1] == doc_of[1:])
                if not hit.any():
                    continue
                hits = np.flatnonzero(hit)
                explained = np.zeros((len(sets), len(hits)), dtype=bool)

                def unit(a: int, b: int) -> np.ndarray:
                    """Distinct bigrams of lines a to b."""
                    lo, hi = np.searchsorted(line, a), np.searchsorted(line, b, side="right")
                    return np.unique(grams[lo : max(lo, hi - 1)])

                def add(doc: int, kind: str, a: int, b: int, base: int) -> None:
                    best = best_template(unit(a, b), sets, least)
                    if best:
                        lo, hi = np.searchsorted(line, a), np.searchsorted(line, b, side="right") - 1
                        explained[place[best[1]], np.searchsorted(hits, lo) : np.searchsorted(hits, hi)] = True
                        end = edge[b + 1] if b + 1 < len(edge) else len(raw)
                        text = raw[edge[a] : end].tobytes().decode("utf-8", "replace").strip("\r\n")
                        out.append((ids[row + doc], kind, a - base, b - a + 1, best[1], best[0], text))

                for ln in np.unique(line[:-1][hit & together]).tolist():
                    doc = int(np.searchsorted(at, edge[ln], side="right")) - 1
                    add(doc, "line", ln, ln, int(np.searchsorted(edge, at[doc])))
                for doc in np.unique(doc_of[:-1][hit]).tolist():
                    base = int(np.searchsorted(edge, at[doc]))
                    stop = int(np.searchsorted(edge, at[doc + 1]))
                    worded = np.isin(np.arange(base, stop), line)
                    for kind, a, b in _units(~worded):
                        lo, hi = np.searchsorted(line, base + a), np.searchsorted(line, base + b, side="right")
                        if hit[lo : max(lo, hi - 1)].any():
                            add(doc, kind, base + a, base + b, base)
                for k, a, b, dice in _windows(grams, doc_of, hits, near[hits], sets, member, longest, explained, least):
                    doc = int(doc_of[a])
                    top = int(line[a])
                    out.append((ids[row + doc], "window", top - int(np.searchsorted(edge, at[doc])), int(line[b + 1]) - top + 1, sets[k][0], dice,
                                raw[starts[a] : ends[b + 1]].tobytes().decode("utf-8", "replace")))
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["doc_id", "unit", "first_line", "n_lines", "license", "dice", "matched"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, unit string, first_line long, n_lines long, license string, dice double, matched string")
