"""Repeated passages by recompression.

A document's words are the symbols of level 0. A round names runs of one symbol, then names
pairs: every symbol is drawn to the left or right half of the alphabet by a bit of its name
and the round, and a left symbol followed by a right one becomes one symbol. A name is a
64-bit function of the names it stands for, so all tasks agree on it without a dictionary
of the corpus, and equal substrings get equal symbols except near their ends. How near is
tracked exactly: each symbol carries the interval of words on which it depends, and is
*interior* to any substring that covers the interval.

Every window of ``window`` words therefore has interior symbols that its words alone
determine. One of them is the window's anchor: of the highest level that has any, the one
with the least name, the leftmost of equals. Windows with the same anchor in a document are
consecutive; the words that they cover are the anchor's neighbourhood.

As Spark rounds over anchors (about one to twelve words; the words themselves are never
shuffled one by one):
1. name: count each anchor symbol over the corpus; symbols that occur once end here, since a
   repeated window would repeat its anchor;
2. name the neighbourhoods of the shared ones and count them: where a neighbourhood recurs,
   all of its windows do;
3. only if one symbol stands in different neighbourhoods (at the ends of repeats), the
   windows of one occurrence of each are named by 128 bits and counted.
Counts are combined before the shuffle and joined back by key, so a passage that a third of
the documents share is one row on one side of a join that adaptive execution splits.

Windows are judged on the input. Texts under ``window`` words and null or empty texts lose
nothing. Rows that share a doc_id are told apart by their text; equal rows are repeats of
each other. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import map_arrow, need, text_key, written
from riskframe.llm.textcols import (
    WORDS, WORDS_B, U, Words, mix, row_groups, row_sums, text_bytes, window_hashes, window_starts)


class Level:
    """Symbols of one level: ``name``, the words [start, end) they stand for, the words
    [low, high) they depend on, and their row."""

    __slots__ = ("name", "start", "end", "low", "high", "row")

    def __init__(self, name, start, end, low, high, row):
        self.name, self.start, self.end, self.low, self.high, self.row = name, start, end, low, high, row


def _neighbours(s: Level) -> tuple[np.ndarray, np.ndarray]:
    """What a symbol depends on if it looks at its left and right neighbour. At a row's ends
    that is a place one beyond the row, which no window covers; bounds stay sorted."""
    if not len(s.name):
        return s.low, s.high
    low, high = np.empty_like(s.low), np.empty_like(s.high)
    low[1:], high[:-1] = s.low[:-1], s.high[1:]
    other = np.flatnonzero(s.row[1:] != s.row[:-1])
    begin, finish = np.append(0, other + 1), np.append(other, len(s.name) - 1)
    low[begin] = s.start[begin] - 1
    high[finish] = s.end[finish] + 1
    return low, high


def name_runs(s: Level) -> Level:
    """Each maximal run of one symbol becomes a symbol; it depends on both neighbours."""
    low, high = _neighbours(s)
    begin = np.ones(len(s.name), dtype=bool)
    begin[1:] = (s.name[1:] != s.name[:-1]) | (s.row[1:] != s.row[:-1])
    at = np.flatnonzero(begin)
    last = np.concatenate([at[1:], [len(begin)]]) - 1
    length = (last - at + 1).astype(np.uint64)
    name = s.name[at]
    name = np.where(length > 1, mix(name ^ mix(length)), name)
    return Level(name, s.start[at], s.end[last], low[at], high[last], s.row[at])


def name_pairs(s: Level, level: int) -> Level:
    """A left symbol followed by a right symbol becomes one; others stay, depending on the
    neighbour that might have joined them."""
    right = (mix(s.name ^ U(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> U(40)) & U(1) == 1
    low, high = _neighbours(s)
    joins = np.zeros(len(s.name), dtype=bool)
    joins[:-1] = ~right[:-1] & right[1:] & (s.row[1:] == s.row[:-1])
    joined = np.concatenate([[False], joins[:-1]])
    own_low = np.where(right & ~joined, low, s.low)
    own_high = np.where(right | joins, s.high, high)
    at = np.flatnonzero(~joined)
    second = np.minimum(at + 1, len(s.name) - 1)
    two = joins[at]
    name = np.where(two, mix(s.name[at] * U(3) ^ mix(s.name[second])), s.name[at])
    return Level(name, s.start[at], np.where(two, s.end[second], s.end[at]), own_low[at],
                 np.where(two, s.high[second], own_high[at]), s.row[at])


def levels(words: np.ndarray, row: np.ndarray, rounds: int) -> list[Level]:
    at = np.arange(len(words))
    s = Level(words, at, at + 1, at, at + 1, row)
    out = [s]
    for k in range(1, rounds + 1):
        s = name_pairs(name_runs(s), k)
        out.append(s)
    return out


def _least(priority: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the least priority in each [lo, hi), the leftmost of equals; lo < hi."""
    out = np.empty(len(lo), dtype=np.int64)
    size = hi - lo
    k = (np.frexp(size.astype(np.float64))[1] - 1).astype(np.int64)
    best = np.arange(len(priority))
    for level in range(int(k.max()) + 1 if len(k) else 0):
        mine = np.flatnonzero(k == level)
        if len(mine):
            a, b = best[lo[mine]], best[hi[mine] - (1 << level)]
            out[mine] = np.where(priority[b] < priority[a], b, a)
        step = 1 << level
        if step < len(best):
            a, b = best[:-step], best[step:]
            best = np.concatenate([np.where(priority[b] < priority[a], b, a), best[len(best) - step:]])
    return out


def anchors(words: np.ndarray, first: np.ndarray, window: int, rounds: int) -> dict[str, np.ndarray]:
    """Anchors of all windows: ``row``, ``at`` (word at which their first window starts),
    ``n`` (windows), ``name`` and ``around`` (hash of the neighbourhood)."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at, at_row = window_starts(first, window)
    key = np.full(len(at), -1, dtype=np.int64)  # anchor of each window: level and symbol
    name = np.zeros(len(at), dtype=np.uint64)
    offset = np.zeros(len(at), dtype=np.int64)
    todo = np.arange(len(at))
    for number, s in reversed(list(enumerate(levels(words, row, rounds)))):
        if not len(todo):
            break
        w = at[todo]
        lo = np.searchsorted(s.low, w, side="left")
        hi = np.searchsorted(s.high, w + window, side="right")
        some = hi > lo
        mine, lo, hi = todo[some], lo[some], hi[some]
        if len(mine):
            got = _least(mix(s.name), lo, hi)
            key[mine] = (number << 48) + got
            # the words a symbol depends on are part of its name here: they make it selective
            depends = window_hashes_spans(words, s.low, s.high, got)
            name[mine] = mix(s.name[got] ^ depends ^ U(number))
            offset[mine] = s.start[got]
        todo = todo[~some]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (at_row[1:] != at_row[:-1])
    begin = np.flatnonzero(new)
    n = np.diff(np.concatenate([begin, [len(at)]]))
    place = (offset[begin] - at[begin]).astype(np.uint64)
    around = WORDS.spans(lambda a, b: words[a:b], at[begin], at[begin] + n + window - 1) if len(begin) else name[:0]
    return {"row": at_row[begin], "at": at[begin] - first[at_row[begin]], "n": n, "name": name[begin],
            "around": mix(around ^ mix(place + U(1)))}


def window_hashes_spans(words: np.ndarray, low: np.ndarray, high: np.ndarray, got: np.ndarray) -> np.ndarray:
    """Hash of the words each chosen symbol depends on."""
    used, back = np.unique(got, return_inverse=True)
    lo, hi = low[used], high[used]
    prefix = WORDS_B.prefix_at
    order = np.argsort(hi, kind="stable")
    top = np.empty(len(hi), dtype=np.uint64)
    top[order] = prefix(lambda a, b: words[a:b], hi[order])
    return mix((top - prefix(lambda a, b: words[a:b], lo)) * WORDS_B.inverse_at(lo))[back]


ANCHORS = "doc_id long, text_key long, name long, around long, at int, n int"


def _anchor_batches(window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_groups(offsets):
                w = Words(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                if not (w.count >= window).any():
                    continue
                a = anchors(w.hashes(), w.first, window, rounds)
                take = pa.array(a["row"] + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("text_key").take(take),
                     pa.array(a["name"].view(np.int64)), pa.array(a["around"].view(np.int64)),
                     pa.array(a["at"].astype(np.int32)), pa.array(a["n"].astype(np.int32))],
                    ["doc_id", "text_key", "name", "around", "at", "n"])

    return run


WINDOWS = "doc_id long, text_key long, at int, edge boolean, a long, b long"


def _window_batches(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            marks = batch.column("marks")
            for i in range(batch.num_rows):
                w = Words(data[offsets[i]: offsets[i + 1]], offsets[i: i + 2] - offsets[i])
                m = marks[i].as_py()
                at = np.concatenate([np.arange(x["at"], x["at"] + x["n"]) for x in m])
                edge = np.repeat([x["edge"] for x in m], [x["n"] for x in m])
                order = np.argsort(at, kind="stable")
                at, edge = at[order], edge[order]
                h = w.hashes()
                same = np.zeros(len(at), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(same + i)), batch.column("text_key").take(pa.array(same + i)),
                     pa.array(at.astype(np.int32)), pa.array(edge),
                     pa.array(window_hashes(h, at, window).view(np.int64)),
                     pa.array(window_hashes(h, at, window, WORDS_B).view(np.int64))],
                    ["doc_id", "text_key", "at", "edge", "a", "b"])

    return run


def _by_document(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """``docs`` (doc_id, text_key, text) with the marks of each; null ids meet null ids."""
    m = marks.withColumnsRenamed({"doc_id": "_m_id", "text_key": "_m_text"})
    cond = docs.doc_id.eqNullSafe(m["_m_id"]) & (docs.text_key == m["_m_text"])
    return docs.join(m, cond, how).drop("_m_id", "_m_text")


def repeated_spans(docs: DataFrame, window: int = 35, rounds: int = 2) -> DataFrame:
    """``doc_id, text_key, at, n``: word positions of ``n`` consecutive repeated windows.

    ``docs`` has doc_id, text_key and text."""
    found = written(map_arrow(docs, _anchor_batches(window, rounds), ANCHORS), "anchors")
    shared = found.groupBy("name").agg(
        F.count(F.lit(1)).alias("held"), (F.min("around") != F.max("around")).alias("varied")).where("held > 1")
    # written: a join of two plain tables is one that adaptive execution can split at a hot name
    shared = written(shared.drop("held"), "shared-names")
    common = written(found.join(shared, "name"), "shared-anchors")
    # a symbol in one neighbourhood only: all its windows recur
    alike = common.where(~F.col("varied")).select("doc_id", "text_key", "at", "n")
    mixed = common.where("varied").withColumn("pick", F.xxhash64("doc_id", "text_key", "at"))
    around = mixed.groupBy("name", "around").agg(F.count(F.lit(1)).alias("held"), F.min("pick").alias("first"))
    mixed = written(mixed.join(written(around, "neighbourhoods"), ["name", "around"]), "mixed-anchors")
    again = mixed.where("held > 1").select("doc_id", "text_key", "at", "n")
    # one occurrence of each neighbourhood; those that occur once are edges to be judged
    ends = mixed.where("held = 1 or pick = first").dropDuplicates(["doc_id", "text_key", "at"]).groupBy(
        "doc_id", "text_key").agg(F.collect_list(F.struct("at", "n", (F.col("held") == 1).alias("edge"))).alias("marks"))
    windows = written(map_arrow(_by_document(docs, ends, "inner"), _window_batches(window), WINDOWS), "end-windows")
    twice = windows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("held")).where("held > 1").drop("held")
    judged = windows.where("edge").join(written(twice, "repeated-ends"), ["a", "b"]).select("doc_id", "text_key", "at", F.lit(1).alias("n"))
    return alike.unionByName(again).unionByName(judged)


KEPT = "doc_id long, text_key long, n_words long, n_removed long, kept string"


def _cover(marks, n_words: int, window: int) -> np.ndarray:
    step = np.zeros(n_words + 1, dtype=np.int64)
    at = np.array([x["at"] for x in marks], dtype=np.int64)
    n = np.array([x["n"] for x in marks], dtype=np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + n + window - 1, -1)
    return np.cumsum(step)[:-1] > 0


def _cut_batches(window: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, marks = batch.column("text"), batch.column("marks")
            data, offsets = text_bytes(text)
            counts, removed, out = [], [], []
            for i in range(batch.num_rows):
                words = data[offsets[i]: offsets[i + 1]].tobytes().split()
                n = len(words)
                if marks[i].is_valid:
                    gone = _cover(marks[i].as_py(), n, window)
                    words = [words[k] for k in np.flatnonzero(~gone)]
                kept = b" ".join(words)
                counts.append(n)
                removed.append(n - len(words))
                out.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(out, pa.string())],
                ["doc_id", "text_key", "n_words", "n_removed", "kept"])

    return run


def substring_dedup(docs: DataFrame, window: int = 35, rounds: int = 2, digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, n_removed, kept (the words not
    covered by a repeated window, joined by a space; with ``digest`` its SHA-256 in hex)."""
    need(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    spans = repeated_spans(rows, window, rounds).distinct()
    marks = spans.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("at", "n")).alias("marks"))
    return map_arrow(_by_document(rows, marks.hint("shuffle_hash"), "left"), _cut_batches(window, digest), KEPT)
