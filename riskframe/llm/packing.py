"""Best-fit packing by a configuration linear program.

Documents are tokenised, closed by id 0 and cut into pieces of at most ``capacity`` ids.
Only the histogram of piece lengths (at most ``capacity`` rows) reaches the driver. There
the configuration LP - how often to use each multiset of lengths that fits a sequence, so
that every piece has a place, with the fewest sequences - is solved approximately by
multiplicative weights: lengths carry weights, a knapsack dynamic program prices the best
configuration, used configurations lower the weights of what they serve. The fractional
counts are rounded down, and what is left is filled best-fit: again and again the fullest
configuration of the remaining lengths, used as often as the counts allow. That is done with all
configurations and with the fuller ones only (shares ``FULLER`` of what the program uses, and
those without room), and the plan with the fewest sequences is used.

The result is a plan: for each configuration a count, and so for each length ranges of
piece ranks that go to a range of sequences. Its size depends on ``capacity`` and
``rounds``, not on the corpus. Pieces are ranked within their length by Spark (length and a
salt of doc_id are counted, then ranked within length and salt, so a length that a third of
the pieces share is spread over tasks), and each finds its place in the plan with a binary
search.

Null text is empty: one piece, the closing id. Equal rows are separate pieces. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
import os
import re
import unicodedata
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.shared import map_arrow, need, written
from riskframe.llm.textcols import Words, row_groups, text_bytes

ROWS_PER_SALT = 1_000_000
FULLER = (0.75, 0.5, 0.25)
CACHE_WORDS = 1_500_000  # about 60 MB


class WordIds:
    """Token ids of words, remembered in a task: a word tokenizer never joins across the
    white space that separates words, so a text's ids are those of its words in turn.

    Words are told apart by their 64-bit hash. New plain words (letters, with or without
    common signs after them) are encoded many at a time, set apart by a space; each run of
    letters and each run of signs then ends in one token that closes a word, by which the ids
    are dealt out. All others, and lists whose count of such tokens is off, are encoded alone."""

    def __init__(self, path: str):
        # one thread a task: Spark runs as many tasks as there are cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            self.closes[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # sorted hashes, and the place of each
        self.place = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words in the order of their encoding, their numbers of ids, and the ids."""
        parts = [_plain(w) for w in words] if self.closes.any() else [0] * len(words)
        together = [i for i, n in enumerate(parts) if n]
        alone = [i for i, n in enumerate(parts) if not n]
        lists = [together[k: k + 500] for k in range(0, len(together), 500)]
        found = self.tokenizer.encode_batch_fast([" ".join([words[i] for i in own]) for own in lists], add_special_tokens=False)
        order, lengths, flat = [], [], []
        for own, e in zip(lists, found):
            ids = np.array(e.ids, dtype=np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            last = np.cumsum([parts[i] for i in own])
            if len(ends) != last[-1] or ends[-1] != len(ids):
                alone += own
                continue
            order.append(own)
            lengths.append(np.diff(ends[last - 1], prepend=0))
            flat.append(ids)
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False)]
        order.append(alone)
        lengths.append(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))
        flat.append(np.fromiter(itertools.chain.from_iterable(ids), dtype=np.uint32))
        return np.concatenate([np.array(x, dtype=np.int64) for x in order]), np.concatenate(lengths), np.concatenate(flat)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        order, lengths, flat = self.encode(words)
        place = np.concatenate([self.place, len(self.lengths) + np.arange(len(order))])
        known = np.concatenate([self.known, hashes[order]])
        sort = np.argsort(known, kind="stable")
        self.known, self.place = known[sort], place[sort]
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat])

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a group of rows, each closed by 0, and the bounds of the rows."""
        w = Words(data, offsets)
        if len(self.known) > CACHE_WORDS:
            self.clear()
        hashes, first, back = np.unique(w.hashes(), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[at] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            raw = data.tobytes()
            self.learn(hashes[new], [raw[a:b].decode() for a, b in zip(w.start[first[new]].tolist(), w.end[first[new]].tolist())])
        at = self.place[np.searchsorted(self.known, hashes)][back] if len(hashes) else back
        n = self.lengths[at]
        starts = (np.cumsum(self.lengths) - self.lengths)[at]
        own = np.concatenate([[0], np.cumsum(n)])
        bounds = own[w.first] + np.arange(len(offsets))  # one more place a row for the closing 0
        out = np.zeros(int(bounds[-1]), dtype=np.uint32)
        every = np.arange(own[-1])
        out[every + np.repeat(w.row, n)] = self.flat[every + np.repeat(starts - own[:-1], n)]
        return out, bounds


_SIGNS = re.compile(r"([^\W\d_]+)([.,;:!?*#%&$|<>()]*)")


def _plain(word: str) -> int:
    """Runs in a word of letters with common signs after them; 0 for any other word."""
    if word.isascii() and word.isalpha():
        return 1
    m = _SIGNS.fullmatch(word)
    if not m or not (m[1].isascii() or unicodedata.normalize("NFC", m[1]).lower().isalpha()):
        return 0
    return 1 + bool(m[2])


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES_WITH_IDS = PIECES + ", ids array<int>"


def _piece_batches(tokenizer: str, capacity: int, ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds(tokenizer)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_groups(offsets):
                flat, bounds = known.texts(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                pieces = -(-np.diff(bounds) // capacity)
                row = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                begin = bounds[row] + start
                end = np.minimum(begin + capacity, bounds[row + 1])
                raw = memoryview(flat.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(begin.tolist(), end.tolist())]
                cols = [batch.column("doc_id").take(pa.array(row + lo)), pa.array(piece.astype(np.int32)),
                        pa.array(start.astype(np.int64)), pa.array((end - begin).astype(np.int64)), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if ids:  # pieces are gapless, so their bounds are those of the list
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(flat)).astype(np.int32)),
                                                         pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, ids: bool = False) -> DataFrame:
    """The pieces of every document; with ``ids`` their token ids as well."""
    need(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, _piece_batches(tokenizer, capacity, ids), PIECES_WITH_IDS if ids else PIECES)


# --- the plan, on the driver, from the histogram ------------------------------------------


def knapsack(lengths: np.ndarray, weights: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: best weight of each room, and the length to take there (-1: none)."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    until = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        k = until[c]
        if k:
            v = weights[:k] + best[c - lengths[:k]]
            i = int(v.argmax())
            if v[i] > best[c]:
                best[c], pick[c] = v[i], i
    return best, pick


def _taken(pick: np.ndarray, lengths: np.ndarray, room: int, conf: dict[int, int]) -> dict[int, int]:
    while room > 0:
        if pick[room] < 0:
            room -= 1
            continue
        n = int(lengths[pick[room]])
        conf[n] = conf.get(n, 0) + 1
        room -= n
    return conf


def configuration_lp(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int,
                     step: float = 0.25, slack: float = 0.02) -> tuple[list, np.ndarray]:
    """Multiplicative weights: [(configuration, fractional count)], and how many times over
    each length's count they serve it.

    The weight of a length is its price in the dual program. It begins with its share of the
    capacity, which is what it costs if nothing is wasted, and falls exponentially with how
    far the length has been served. A round prices configurations with one knapsack: the best
    one for each length it may begin with, the least served first. Those within ``slack`` of
    the best price are used, each until a length in it has been served ``step`` of its count
    more in this round. Ends when every length has been served ``enough`` times over."""
    enough = 4.0
    served = np.zeros(len(lengths))
    place = {int(n): i for i, n in enumerate(lengths)}
    used: dict[tuple, float] = {}
    for _ in range(rounds):
        weights = lengths / capacity * np.exp(-(served - served.min()))
        best, pick = knapsack(lengths, weights, capacity)
        price = weights + best[capacity - lengths]
        until = served + step
        for i in np.argsort(served, kind="stable"):
            if price[i] < (1 - slack) * price.max():
                continue
            n = int(lengths[i])
            conf = _taken(pick, lengths, capacity - n, {n: 1})
            at = np.array([place[m] for m in conf])
            per = np.array([conf[m] for m in conf]) / counts[at]
            amount = float(((until[at] - served[at]) / per).min())
            if amount > 1e-9:
                served[at] += amount * per
                key = tuple(sorted(conf.items(), reverse=True))
                used[key] = used.get(key, 0.0) + amount
        if served.min() >= enough:
            break
    return [(dict(k), v) for k, v in used.items()], served


def fullest(lengths: np.ndarray, left: np.ndarray, capacity: int) -> dict[int, int]:
    """A fullest configuration of the remaining pieces that begins with the longest one:
    subset sums of the counted lengths, longest first."""
    top = int(np.flatnonzero(left)[-1])
    room = capacity - int(lengths[top])
    conf = {int(lengths[top]): 1}
    # reach[c]: index of the length that first filled c exactly, longer lengths first
    reach = np.full(room + 1, -1)
    copies = np.zeros(room + 1, dtype=np.int64)
    full = np.zeros(room + 1, dtype=bool)
    full[0] = True
    for i in range(int(np.searchsorted(lengths, room, side="right")) - 1, -1, -1):
        have = int(left[i]) - (i == top)
        if have <= 0:
            continue
        n = int(lengths[i])
        base = full.copy()
        for k in range(1, min(have, room // n) + 1):
            reached = np.zeros(room + 1, dtype=bool)
            reached[n * k:] = base[: room + 1 - n * k]
            new = reached & ~full
            reach[new], copies[new] = i, k
            full |= new
        if full[room]:
            break
    c = int(np.flatnonzero(full)[-1])
    while c > 0:
        n = int(lengths[reach[c]])
        conf[n] = conf.get(n, 0) + int(copies[c])
        c -= n * int(copies[c])
    return conf


def _rounded(lengths: np.ndarray, counts: np.ndarray, found: list, scale: float, capacity: int,
             waste: int) -> tuple[list[tuple[dict[int, int], int]], int]:
    """The configurations rounded down and the rest filled best-fit, and how many sequences the
    program placed. Configurations that leave more than ``waste`` are left to the filling."""
    left = counts.copy()
    place = {int(n): i for i, n in enumerate(lengths)}
    plan = []

    def use(conf: dict[int, int], times: int) -> None:
        for n, k in conf.items():
            left[place[n]] -= k * times
        plan.append((conf, times))

    for conf, amount in sorted(found, key=lambda x: (-sum(n * k for n, k in x[0].items()), -x[1])):
        if capacity - sum(n * k for n, k in conf.items()) > waste:
            continue
        times = min([math.floor(amount / scale), *(int(left[place[n]]) // k for n, k in conf.items())])
        if times > 0:
            use(conf, times)
    placed = sum(times for _, times in plan)
    while left.any():
        conf = fullest(lengths, left, capacity)
        use(conf, min(int(left[place[n]]) // k for n, k in conf.items()))
    return plan, placed


def rounded_plans(histogram: dict[int, int], capacity: int, rounds: int = 60) -> list[tuple[list, int]]:
    """Ways to round the program, (plan, sequences placed by the program): all of its
    configurations rounded down, then only the fuller ones by shares of what it uses, and last
    those without room."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    counts = np.array([histogram[int(n)] for n in lengths], dtype=np.int64)
    found, served = configuration_lp(lengths, counts.astype(float), capacity, rounds)
    scale = max(1.0, float(served.min()))
    room = np.array([capacity - sum(n * k for n, k in conf.items()) for conf, _ in found])
    order = np.argsort(room, kind="stable")
    used = np.cumsum(np.array([amount for _, amount in found])[order])
    shares = [int(room[order][min(np.searchsorted(used, f * used[-1]), len(found) - 1)]) for f in FULLER]
    wastes = sorted({capacity, 0, *shares}, reverse=True)
    return [_rounded(lengths, counts, found, scale, capacity, w) for w in wastes]


def packing_plan(histogram: dict[int, int], capacity: int, rounds: int = 60) -> list[tuple[dict[int, int], int]]:
    """Configurations with whole counts that place every piece exactly once: the plan with fewer
    sequences; of equals the one that rounds the most configurations."""
    if not histogram:
        return []
    return min((plan for plan, _ in rounded_plans(histogram, capacity, rounds)), key=lambda plan: sum(t for _, t in plan))


def plan_ranges(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, sequence base, copies, offset), sorted: ranks of a length
    from the first rank on go ``copies`` to a sequence, from the sequence base on."""
    taken: dict[int, int] = {}
    rows, base = [], 0
    for conf, times in plan:
        offset = 0
        for n in sorted(conf, reverse=True):
            rows.append((n, taken.get(n, 0), base, conf[n], offset))
            taken[n] = taken.get(n, 0) + conf[n] * times
            offset += n * conf[n]
        base += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _placer(ranges: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.searchsorted(ranges[:, 0], np.arange(ranges[:, 0].max() + 2 if len(ranges) else 1))
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.zeros(len(length), dtype=np.int64)
            for n in np.unique(length):
                mine = length == n
                lo, hi = bounds[n], bounds[n + 1]
                at[mine] = lo + np.searchsorted(ranges[lo:hi, 1], rank[mine], side="right") - 1
            r = ranges[at]
            within = rank - r[:, 1]
            seq = r[:, 2] + within // r[:, 3]
            offset = r[:, 4] + within % r[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(seq), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, rounds: int = 60) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = written(pieces(docs, tokenizer, capacity), "pieces")
    histogram = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges = plan_ranges(packing_plan(histogram, capacity, rounds))
    salts = max(1, math.ceil(sum(histogram.values()) / ROWS_PER_SALT), cut.sparkSession.sparkContext.defaultParallelism)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.join(offsets, ["length", "salt"]).withColumn(
        "rank", F.row_number().over(within) - 1 + F.col("before")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "rank")
    # equal rows may share a rank only if their (length, salt) differ: row_number is unique
    return map_arrow(ranked, _placer(ranges), PIECES + ", sequence_id long, offset long")
