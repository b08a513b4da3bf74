"""License scan: winnowed fingerprints pick candidates, banded alignment reports coverage.

Words are runs of letters and digits, lower-cased for A-Z; other signs are ignored. Templates
and documents are fingerprinted alike: hashes of ``GRAM`` consecutive words, of which every
``WINNOW`` consecutive ones keep their least. Any run of GRAM + WINNOW - 1 words that a document
shares with a template shares a fingerprint. Hits of the templates' inverted index are grouped
by template and diagonal (document position minus template position); a local alignment of
the words in a band around each group's diagonals, with matches, mismatches and gaps, gives
the matched part: ``coverage`` (share of the template's words matched), word and character
spans in the document and word span in the template. What lies left and right of a matched
part is aligned again in the same band, so notices that follow each other closely are a row
each. Of matches that overlap in a document
the one with most words matched stays.

Templates are a parameter of the job, not a table: the index is built from them in each task
and holds one entry for every few template words. Documents are scanned where they are read,
with no shuffle; one document's alignments are the largest unit of work.

Null and empty texts have no match. Templates under GRAM words are refused. Equal rows have
equal matches. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from typing import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import map_arrow, need
from riskframe.llm.textcols import LETTERS, Words, row_groups, text_bytes, window_hashes, window_starts

GRAM, WINNOW = 2, 2
BAND = 8
MATCH, MISMATCH, GAP = 2, -1, -1

# Short public notices by which a text states its licence, and the opening
# grants of common licences.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "mit-line": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "all-rights-reserved": "All rights reserved.",
}


class Tokens:
    """Words of a group of rows: hash, byte span, and bounds of the rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        w = Words(data, offsets, LETTERS)
        letters = LETTERS[data[w.start]] == 1 if len(w) else np.zeros(0, dtype=bool)
        self.hash = w.hashes(lower=True)[letters]
        self.start, self.end = w.start[letters], w.end[letters]
        self.first = np.searchsorted(w.row[letters], np.arange(len(offsets)))


def fingerprints(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, word position and row of the winnowed grams."""
    at, row = window_starts(first, GRAM)
    grams = window_hashes(words, at, GRAM)
    keep = np.zeros(len(at), dtype=bool)
    if len(at) >= WINNOW:
        sel = np.arange(len(at) - WINNOW + 1)
        best = sel.copy()
        for k in range(1, WINNOW):
            best = np.where(grams[sel + k] <= grams[best], sel + k, best)
        keep[best[row[sel] == row[sel + WINNOW - 1]]] = True
    few = np.diff(np.searchsorted(row, np.arange(len(first)))) < WINNOW
    keep |= few[row]  # rows with fewer grams than a winnowing window keep them all
    return grams[keep], at[keep], row[keep]


class Index:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = list(templates)
        data, offsets = text_bytes(pa.array([templates[n] for n in self.names], pa.string()))
        t = Tokens(data, offsets)
        self.words = [t.hash[t.first[i]: t.first[i + 1]] for i in range(len(self.names))]
        h, at, row = fingerprints(t.hash, t.first)
        order = np.argsort(h, kind="stable")
        self.key, self.row, self.at = h[order], row[order], (at - t.first[:-1][row])[order]

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each hash that occurs: its index in ``h`` and the entry of the index."""
        lo, hi = np.searchsorted(self.key, h, side="left"), np.searchsorted(self.key, h, side="right")
        n = hi - lo
        which = np.repeat(np.arange(len(h)), n)
        return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]

    def dense(self, at: np.ndarray, row: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Hits with enough others of their row and template within BAND diagonals, by row.

        A tenth of the template's words is asked for: without gaps in the document, a match of
        four fifths of a template's words holds a fingerprint for every five of them."""
        t = self.row[entry]
        least = np.maximum(1, np.array([len(w) for w in self.words]) // 10)[t]
        place = ((row * len(self.words) + t) << 34) + (at - self.at[entry]) + (1 << 33)
        order = np.argsort(place, kind="stable")
        p = place[order]
        near = np.searchsorted(p, p + BAND, side="right") - np.searchsorted(p, p - BAND, side="left")
        return order[near >= least[order]]


def _scores(doc: np.ndarray, template: np.ndarray, low: int, high: int) -> np.ndarray:
    """Best score of a local alignment that ends at each template word and diagonal."""
    width = high - low + 1
    j = np.arange(width)
    best = np.zeros((len(template) + 1, width), dtype=np.int64)
    for i in range(1, len(template) + 1):
        at = i - 1 + low + j  # document position that this column pairs with template word i - 1
        inside = (at >= 0) & (at < len(doc))
        same = np.zeros(width, dtype=bool)
        same[inside] = doc[at[inside]] == template[i - 1]
        pair = np.where(inside, best[i - 1] + np.where(same, MATCH, MISMATCH), 0)
        down = np.append(best[i - 1][1:], 0) + GAP  # the template word stands alone
        row = np.maximum(np.maximum(pair, down), 0)
        # document words stand alone: a linear gap is a running maximum
        best[i] = np.maximum(np.maximum.accumulate(row - GAP * j) + GAP * j, 0)
    return best


def align(doc: np.ndarray, template: np.ndarray, low: int, high: int) -> tuple[int, list[tuple[int, int]]]:
    """Best local alignment with document minus template position within [low, high]:
    its score and the matched (document, template) positions."""
    width = high - low + 1
    best = _scores(doc, template, low, high)
    i, c = np.unravel_index(int(best.argmax()), best.shape)
    score, pairs = int(best[i, c]), []
    while i > 0 and best[i, c] > 0:
        at = i - 1 + low + c
        if 0 <= at < len(doc):
            same = doc[at] == template[i - 1]
            if best[i, c] == best[i - 1, c] + (MATCH if same else MISMATCH):
                if same:
                    pairs.append((int(at), int(i - 1)))
                i -= 1
                continue
        if c + 1 < width and best[i, c] == best[i - 1, c + 1] + GAP:
            i, c = i - 1, c + 1
        elif c > 0 and best[i, c] == best[i, c - 1] + GAP:
            c -= 1
        else:
            break
    return score, pairs[::-1]


def alignments(doc: np.ndarray, template: np.ndarray, low: int, high: int, least: int) -> Iterator[list[tuple[int, int]]]:
    """Matched positions of the alignments of ``least`` words or more that share no document
    word: the best one, then the best of what lies left and right of it, and so on.

    A local alignment spans at most three times the template's words of the document. So what
    is found changes the scores of as many words to its right only, and they alone are aligned
    again: the work grows with the document's words, not with their product with the notices."""
    reach = 3 * len(template)

    def band(a: int, b: int) -> tuple:
        return doc[a:b], template, max(low, a - len(template)) - a, min(high, b) - a

    def ends(a: int, b: int) -> np.ndarray:
        """Best score of an alignment within doc[a:b] that ends at each of its words."""
        out = np.zeros(b - a, dtype=np.int64)
        part, _, lo, hi = band(a, b)
        if hi >= lo:
            best = _scores(part, template, lo, hi)
            for i in range(len(template)):
                x, y = max(0, i + lo), min(b - a, i + hi + 1)
                if x < y:
                    out[x:y] = np.maximum(out[x:y], best[i + 1, x - i - lo: y - i - lo])
        # too few of the template's words before this end
        n = np.append(0, np.cumsum(known[a:b]))
        stop = np.arange(1, b - a + 1)
        return np.where(n[stop] - n[np.maximum(stop - reach, 0)] < least, 0, out)

    known = np.isin(doc, template)
    taken = np.zeros(len(doc), dtype=bool)
    score = ends(0, len(doc))
    while len(score):
        end = int(score.argmax()) + 1
        if score[end - 1] <= 0:
            return
        a = max(0, end - reach)
        before = np.flatnonzero(taken[a:end])
        a = a + int(before[-1]) + 1 if len(before) else a
        _, pairs = align(*band(a, end))
        if not pairs:
            score[end - 1] = 0
            continue
        pairs = [(a + x, y) for x, y in pairs]
        first, last = pairs[0][0], max(end, pairs[-1][0] + 1)
        if len(pairs) >= least:
            yield pairs
        taken[first:last], score[first:last] = True, 0
        b = min(len(doc), last + reach)
        after = np.flatnonzero(taken[last:b])
        b = last + int(after[0]) if len(after) else b
        if b > last:
            score[last:b] = ends(last, b)


def _matches(doc: np.ndarray, index: Index, at: np.ndarray, entry: np.ndarray, least: float) -> list[tuple]:
    """(template, coverage, document span, template span, words matched) of one document's hits."""
    out = []
    t, diagonal = index.row[entry], at - index.at[entry]
    order = np.lexsort((at, diagonal, t))
    t, diagonal, at = t[order], diagonal[order], at[order]
    cut = np.flatnonzero((t[1:] != t[:-1]) | (diagonal[1:] - diagonal[:-1] > BAND)) + 1
    for a, b in zip(np.append(0, cut), np.append(cut, len(t))):
        template = index.words[t[a]]
        lo = max(0, int(diagonal[a]) - BAND)
        hi = min(len(doc), int(diagonal[b - 1]) + len(template) + BAND)
        part = doc[lo:hi]
        low, high = int(diagonal[a]) - lo - BAND, int(diagonal[b - 1]) - lo + BAND
        # as many words as make coverage >= least
        words = next((k for k in range(1, len(template) + 1) if k / len(template) >= least), len(template) + 1)
        for pairs in alignments(part, template, low, high, words):
            out.append((int(t[a]), len(pairs) / len(template), lo + pairs[0][0], lo + pairs[-1][0] + 1,
                        pairs[0][1], pairs[-1][1] + 1, len(pairs)))
    return out


def distinct_spans(found: list[tuple]) -> list[tuple]:
    """Of matches that overlap in the document, the one with most words matched (then the
    best covered, then the first template)."""
    kept: list[tuple] = []
    for m in sorted(found, key=lambda m: (-m[6], -m[1], m[0])):
        i = bisect_left(kept, m[2], key=lambda k: k[2])
        if (i == 0 or kept[i - 1][3] <= m[2]) and (i == len(kept) or m[3] <= kept[i][2]):
            kept.insert(i, m)
    return kept


MATCHES = ("doc_id long, template string, coverage double, word_start int, word_end int, char_start int, char_end int, "
           "template_start int, template_end int, template_words int")


def _scan_batches(templates: Mapping[str, str], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        schema = pa.schema([("doc_id", pa.int64()), ("template", pa.string()), ("coverage", pa.float64()),
                            *((c, pa.int32()) for c in ("word_start", "word_end", "char_start", "char_end",
                                                        "template_start", "template_end", "template_words"))])
        for batch in batches:
            ids = batch.column("doc_id")
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_groups(offsets):
                own, bounds = data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
                tokens = Tokens(own, bounds)
                h, at, row = fingerprints(tokens.hash, tokens.first)
                which, entry = index.hits(h)
                if not len(which):
                    continue
                at, row = at[which], row[which]
                dense = index.dense(at - tokens.first[row], row, entry)
                at, row, entry = at[dense], row[dense], entry[dense]
                if not len(row):
                    continue
                rows = []
                for x, y in zip(*(lambda u: (u[:-1], u[1:]))(np.flatnonzero(np.append(np.append(True, row[1:] != row[:-1]), True)))):
                    r = row[x]
                    first, last = tokens.first[r], tokens.first[r + 1]
                    found = _matches(tokens.hash[first:last], index, at[x:y] - first, entry[x:y], least)
                    chars_before = np.append(0, np.cumsum((own[bounds[r]: bounds[r + 1]] & 0xC0) != 0x80))
                    for t, coverage, a, b, ta, tb, _ in distinct_spans(found):
                        chars = [int(chars_before[z - bounds[r]]) for z in (tokens.start[first + a], tokens.end[first + b - 1])]
                        rows.append((ids[lo + int(r)].as_py(), index.names[t], coverage, a, b, *chars, ta, tb, len(index.words[t])))
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in rows], schema=schema)

    return run


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None, coverage: float = 0.8) -> DataFrame:
    """One row per matched part: document, template, coverage and spans."""
    need(docs, "doc_id", "text")
    templates = dict(TEMPLATES if templates is None else templates)
    if any(len(w) < GRAM for w in Index(templates).words):
        raise ValueError(f"a template needs {GRAM} words")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, _scan_batches(templates, coverage), MATCHES)
