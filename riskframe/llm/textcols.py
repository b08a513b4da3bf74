"""Word and line positions of whole Arrow text columns, as numpy arrays.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; UTF-8 continuation
bytes never fall into that set, so working on bytes equals working on characters.
Hashes are 64-bit polynomial hashes with random byte values, finished by a bit mixer;
words over ``LONG_WORD`` bytes are hashed with BLAKE2b instead. They are pure functions
of the bytes, so every task and every re-execution names a word alike.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 22  # rows are handled in groups of about so many bytes of text
LONG_WORD = 64
_STEP = 1 << 18

U = np.uint64
_M64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection on 64-bit words."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & _M64], dtype=np.uint64))[0])


class Rolling:
    """Hashes of spans of a sequence from prefix sums of value * base**position (mod 2**64)."""

    def __init__(self, base: int):
        self.base = base | 5  # odd, 1 modulo 4
        self.inverse = pow(self.base, -1, 1 << 64)
        self._pow = self._powers(self.base)
        self._inv = self._powers(self.inverse)

    @staticmethod
    def _powers(b: int) -> np.ndarray:
        out = np.full(_STEP, b, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def prefix_at(self, values, at: np.ndarray) -> np.ndarray:
        """Prefix sums (exclusive) at the sorted positions ``at``; ``values(lo, hi)`` gives a slice.

        Runs in steps, so that scratch memory doesn't grow with the sequence."""
        out = np.zeros(len(at), dtype=np.uint64)
        if not len(at):
            return out
        carry, scale, lo, end = 0, 1, 0, int(at[-1])
        i = int(np.searchsorted(at, 0, side="right"))
        while lo < end:
            hi = min(lo + _STEP, end)
            part = np.cumsum(values(lo, hi) * self._pow[: hi - lo], dtype=np.uint64)
            j = int(np.searchsorted(at, hi, side="right"))
            out[i:j] = part[at[i:j] - lo - 1] * U(scale) + U(carry)
            carry = (carry + int(part[-1]) * scale) & _M64
            scale = scale * pow(self.base, hi - lo, 1 << 64) & _M64
            lo, i = hi, j
        return out

    def inverse_at(self, at: np.ndarray) -> np.ndarray:
        q, r = np.divmod(at, _STEP)
        out = self._inv[r]
        if len(q) and q[-1] > 0:
            high = np.ones(int(q.max()) + 1, dtype=np.uint64)
            high[1:] = U(pow(self.inverse, _STEP, 1 << 64))
            out = out * np.cumprod(high, dtype=np.uint64)[q]
        return out

    def spans(self, values, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mixed hash of each span [start, end); both arrays sorted. Includes the length."""
        raw = (self.prefix_at(values, ends) - self.prefix_at(values, starts)) * self.inverse_at(starts)
        return mix(raw ^ (ends - starts).astype(np.uint64) * U(0x9E3779B97F4A7C15))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
BYTES = Rolling(0xD6E8FEB86659FD91)
WORDS = Rolling(0xA0761D6478BD642D)
WORDS_B = Rolling(0xE7037ED1A0B428D9)

# Kinds of bytes: 0 separates, and a word ends where the kind changes. WORD knows one kind of
# word; LETTERS tells letters, digits and all beyond ASCII from other signs.
WORD = np.ones(256, dtype=np.uint8)
WORD[[0x20, *range(0x09, 0x0E)]] = 0
LETTERS = WORD * 2
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    LETTERS[_lo:_hi] = 1


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string_view(col.type) or pa.types.is_null(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes, or of one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = hi


class Words:
    """Words of a group of rows: ``start``/``end`` byte positions, ``row`` of each word and
    ``first`` (word index at which each row starts, one more at the end). ``kinds`` is WORD
    unless another table of byte kinds is given."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray | None = None):
        kinds = WORD if kinds is None else kinds
        self.data, self.offsets = data, offsets
        kind = kinds[data]
        inside = kind > 0
        change = kind[1:] != kind[:-1]
        begin = inside.copy()
        begin[1:] &= change
        finish = inside.copy()
        finish[:-1] &= change
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begin[edges[inside[edges]]] = True
        finish[edges[inside[edges - 1]] - 1] = True
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, lower: bool = False) -> np.ndarray:
        data = self.data
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        out = hash_spans(data, self.start, self.end)
        for i in np.flatnonzero(self.end - self.start > LONG_WORD):
            digest = hashlib.blake2b(data[self.start[i]: self.end[i]].tobytes(), digest_size=8).digest()
            out[i] = np.frombuffer(digest, dtype=np.uint64)[0]
        return out


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans (sorted, not overlapping)."""
    return BYTES.spans(lambda lo, hi: _BYTE_VALUE[data[lo:hi]], starts, ends)


def first_of_equals(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Indexes of the spans that equal no earlier span of their group. Equal hashes are only a hint
    (long spans can be made to collide): spans that share one are told apart by 128 bits of BLAKE2b."""
    key = mix(hash_spans(data, starts, ends) ^ (group.astype(np.uint64) * U(0x9E3779B97F4A7C15)))
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    alone = n[back] == 1
    firsts = np.flatnonzero(alone)
    seen, more = set(), []
    for i in np.flatnonzero(~alone):
        name = (int(group[i]), hashlib.blake2b(data[starts[i]: ends[i]].tobytes(), digest_size=16).digest())
        if name not in seen:
            seen.add(name)
            more.append(i)
    return np.sort(np.concatenate([firsts, np.array(more, dtype=np.int64)]))


def window_hashes(words: np.ndarray, starts: np.ndarray, size, by: Rolling = WORDS) -> np.ndarray:
    """Hashes of the windows of ``size`` words at the sorted word positions ``starts``."""
    return by.spans(lambda lo, hi: words[lo:hi], starts, starts + size)


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which a window of ``size`` words of one row starts, and its row."""
    n = np.maximum(np.diff(first) - size + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[:-1][row]
    return at, row


def shingles(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each ``size``-word shingle; a shorter row's whole sequence is one."""
    at, row = window_starts(first, size)
    out = window_hashes(words, at, size)
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        own = window_hashes(words, first[:-1][short], count[short])
        row, out = np.concatenate([row, short]), np.concatenate([out, own])
        order = np.argsort(row, kind="stable")
        row, out = row[order], out[order]
    return out, row


def distinct_per_row(values: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Values sorted and made distinct within each row, and the bounds of each row."""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    v, r = v[new], r[new]
    return v, np.searchsorted(r, np.arange(n_rows + 1))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each [first[i], first[i + 1])."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
