"""Benchmark decontamination by SimHash of item-sized windows.

A benchmark item of m words is compared with every window of m words of every document, on
weighted 5-word shingles (weight: how often the shingle stands there): similarity is the sum
of the smaller weights over the sum of the larger ones, and ``percent`` or more of it makes a
hit. Words are lower-cased for A-Z. An item under five words is one shingle. A document with
fewer words than the item is one window, while its length can still reach ``percent``.

1. The items' shingles, alone and together with the item's size, set bits in a bitmap, which
   the document pass carries. Rows with enough bits for some size are looked at size by size.
   A window can only reach ``percent`` if enough of its shingles are an item's: with R and S
   shingles on the two sides, at least percent / (100 + percent) of R + S. Windows with fewer
   set bits have no fingerprint taken; none that could be a hit is lost.
2. The other windows get a 128-bit SimHash. Fingerprints are cut into 16 blocks of 8 bits. Two
   that differ in at most 47 bits differ in at most 2 bits of some block, so each item is
   indexed under all 37 values within 2 bits of each block, and a join on (item size, block,
   value) meets every pair within radius 47. At similarity 0.75 the expected distance is 22
   with a standard deviation of 4.3: the radius leaves a margin of almost 6.
3. Pairs within the radius are verified on the exact weighted shingles.

The bitmap has 256 bits or more for each entry, as items of one shingle need it sparse, between
2**24 and 2**28 bits (32 MB) in all; beyond a million entries it is less selective, never wrong. Item sizes are at most as many as
the longest item has words, and all else - items, index, windows - is joined by key. A document with a hit is told by its windows only;
texts are never shuffled.

Null and empty texts and items have no window. Equal documents have equal hits. Equal items
are hit alike, each under its item_id. Extra columns are ignored; empty tables give an empty
result.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import map_arrow, need, text_key, written
from riskframe.llm.textcols import U, Words, mix, row_groups, text_bytes, window_hashes, window_starts

SHINGLE = 5
BITMAP_BITS = (24, 28)  # the least and the most, as powers of two
BLOCKS, BLOCK_BITS, BLOCK_ERRORS = 16, 8, 2
RADIUS = BLOCKS * (BLOCK_ERRORS + 1) - 1


def simhash(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128-bit fingerprints (rows x 2, uint64) of the weighted shingles in each range of
    ``values``; equal shingles add their weight."""
    out = np.zeros((len(bounds) - 1, 2), dtype=np.uint64)
    if len(bounds) < 2:
        return out
    for half, seed in enumerate((0x8CB92BA72F3D8DD7, 0x632BE59BD9B4E019)):
        bits = np.unpackbits(mix(values ^ U(seed)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes = np.add.reduceat(bits.astype(np.int32) * 2 - 1, bounds[:-1], axis=0)
        out[:, half] = np.packbits(votes > 0, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller weights over sum of larger weights of two shingle lists."""
    av, an = np.unique(a, return_counts=True)
    bv, bn = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(av, bv, assume_unique=True, return_indices=True)
    common = int(np.minimum(an[i], bn[j]).sum())
    return common / (len(a) + len(b) - common) if len(a) else 0.0


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = Words(data, offsets)
    return w.hashes(lower=True), w.first


ITEMS = "item_id long, m int, fa long, fb long, shingles binary"


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        h, first = _words(data, offsets)
        rows = []
        for i, item in enumerate(batch.column("item_id").to_pylist()):
            m = int(first[i + 1] - first[i])
            if m:
                k = min(m, SHINGLE)
                sh = window_hashes(h, np.arange(first[i], first[i + 1] - k + 1), k)
                f = simhash(sh, np.array([0, len(sh)]))[0].view(np.int64)
                rows.append((item, m, int(f[0]), int(f[1]), sh.tobytes()))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("item_id", "m", "fa", "fb", "shingles"), r)) for r in rows],
            schema=pa.schema([("item_id", pa.int64()), ("m", pa.int32()), ("fa", pa.int64()), ("fb", pa.int64()),
                              ("shingles", pa.binary())]))


def _bit_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, _ = text_bytes(batch.column("shingles"))
            sh = np.frombuffer(data.tobytes(), dtype=np.uint64)
            m = batch.column("m").to_numpy(zero_copy_only=False)
            sized = of_size(sh, np.repeat(m, np.maximum(m - SHINGLE + 1, 1)).astype(np.uint64))
            at = np.unique(np.concatenate([sh, sized]) >> U(64 - width))
            bit = np.left_shift(U(1), at & U(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> U(6)).astype(np.int32)), pa.array(bit)], ["word", "bit"])

    return run


def of_size(shingles: np.ndarray, m) -> np.ndarray:
    """Hash of a shingle as one of an item of m words."""
    return mix(shingles ^ mix(np.asarray(m, dtype=np.uint64)))


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    top = hashes >> U(64 - (len(bits).bit_length() + 5))
    return (bits[top >> U(6)] >> (top & U(63))) & U(1)


def bitmap_width(shingles: int) -> int:
    """The power of two with 256 bits or more for both entries of each shingle, within bounds."""
    return min(max((512 * shingles).bit_length(), BITMAP_BITS[0]), BITMAP_BITS[1])


def bitmap(items: DataFrame, shingles: int) -> np.ndarray:
    """Bits of the items' shingles, of which there are so many: 32 MB at most."""
    width = bitmap_width(shingles)
    words = map_arrow(items, _bit_batches(width), "word int, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()
    out = np.zeros(1 << (width - 6), dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bit"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


WINDOWS = "doc_id long, text_key long, start int, m int, fa long, fb long, shingles binary"


def least_common(r: int, s: int, percent: int) -> int:
    """How many of r and s shingles must be common for a similarity of percent / 100."""
    return -(-percent * (r + s) // (100 + percent))


def _window_batches(bits: np.ndarray, sizes: np.ndarray, percent: int):
    by_shingle = {k: sizes[np.minimum(sizes, SHINGLE) == k] for k in sorted(set(np.minimum(sizes, SHINGLE).tolist()))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_groups(offsets):
                h, first = _words(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                for k, own in by_shingle.items():
                    at, row = window_starts(first, k)
                    sh = window_hashes(h, at, k)
                    total = np.concatenate([[0], np.cumsum(in_bitmap(bits, sh), dtype=np.int64)])
                    bounds = np.searchsorted(row, np.arange(hi - lo + 1))
                    per_row = total[bounds[1:]] - total[bounds[:-1]]
                    # percent of an item's shingles must be there, however long the row
                    for r in np.flatnonzero(per_row >= -(-percent * int(own.min() - k + 1) // 100)):
                        yield from _of_row(batch, lo + int(r), sh[bounds[r]: bounds[r + 1]], bits, own - k + 1, own, percent)

    return run


def _of_row(batch, i, sh, bits, counts, sizes, percent):
    out = []
    for s, m in zip(counts.tolist(), sizes.tolist()):
        r = min(s, len(sh))  # a row shorter than the item is its one window
        if 100 * r >= percent * s:
            total = np.concatenate([[0], np.cumsum(in_bitmap(bits, of_size(sh, m)), dtype=np.int64)])
            start = np.flatnonzero(total[r:] - total[:-r] >= least_common(r, s, percent))
            if len(start):
                flat = sh[start[:, None] + np.arange(r)]
                f = simhash(flat.ravel(), np.arange(len(start) + 1) * r).view(np.int64)
                out.append((start, np.full(len(start), m), f, [x.tobytes() for x in flat]))
    if out:
        n = sum(len(x[0]) for x in out)
        own = pa.array(np.full(n, i))
        f = np.concatenate([x[2] for x in out])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(own), batch.column("text_key").take(own),
             pa.array(np.concatenate([x[0] for x in out]).astype(np.int32)),
             pa.array(np.concatenate([x[1] for x in out]).astype(np.int32)),
             pa.array(f[:, 0].copy()), pa.array(f[:, 1].copy()), pa.array([b for x in out for b in x[3]], pa.binary())],
            ["doc_id", "text_key", "start", "m", "fa", "fb", "shingles"])


def _blocks() -> list:
    """The value of each block of a fingerprint."""
    per = 64 // BLOCK_BITS
    return [F.shiftrightunsigned(F.col("fa" if i < per else "fb"), BLOCK_BITS * (i % per)).bitwiseAND((1 << BLOCK_BITS) - 1)
            for i in range(BLOCKS)]


def _near_masks() -> list[int]:
    """Block values with at most BLOCK_ERRORS bits set."""
    return [x for x in range(1 << BLOCK_BITS) if bin(x).count("1") <= BLOCK_ERRORS]


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("shingles", "item_shingles"))
            sim = [similarity(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)) for x, y in zip(a, b)]
            keep = np.flatnonzero(np.array(sim) >= percent / 100) if sim else np.zeros(0, dtype=np.int64)
            cols = [batch.column(c).take(pa.array(keep)) for c in ("doc_id", "text_key", "item_id", "start", "m")]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(np.array(sim, dtype=np.float64)[keep])],
                ["doc_id", "text_key", "item_id", "start", "m", "similarity"])

    return run


def hits(docs: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, text_key, item_id, start (word), m (words of the item), similarity: the best window
    (the first of equals) of each document and item that reach ``percent``."""
    need(docs, "doc_id", "text")
    need(benchmark, "item_id", "text")
    items = written(map_arrow(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), _item_batches, ITEMS), "items")
    of_items = items.groupBy("m").count().collect()
    sizes = np.array(sorted(r["m"] for r in of_items), dtype=np.int64)
    shingles = sum(max(r["m"] - SHINGLE + 1, 1) * r["count"] for r in of_items)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    windows = written(map_arrow(rows, _window_batches(bitmap(items, shingles), sizes, percent), WINDOWS), "windows")
    windows = windows.dropDuplicates(["doc_id", "text_key", "start", "m"])

    blocks = F.posexplode(F.array(*_blocks())).alias("block", "value")
    masks = F.array(*(F.lit(x).cast("long") for x in _near_masks()))
    index = items.select("item_id", "m", F.col("fa").alias("ia"), F.col("fb").alias("ib"), blocks).withColumn(
        "mask", F.explode(masks)).withColumn("value", F.col("value").bitwiseXOR(F.col("mask"))).drop("mask")
    probes = windows.select("doc_id", "text_key", "start", "m", "fa", "fb", blocks)
    apart = F.bit_count(F.col("fa").bitwiseXOR(F.col("ia"))) + F.bit_count(F.col("fb").bitwiseXOR(F.col("ib")))
    near = probes.join(index, ["m", "block", "value"]).where(apart <= RADIUS).select(
        "doc_id", "text_key", "start", "m", "item_id").distinct()
    w = windows.select(*(F.col(c).alias(f"_{c}") for c in ("doc_id", "text_key", "start", "m")), "shingles")
    same = [near[c].eqNullSafe(F.col(f"_{c}")) for c in ("doc_id", "text_key", "start", "m")]
    it = items.select(F.col("item_id").alias("_item"), F.col("shingles").alias("item_shingles")).dropDuplicates(["_item"])
    both = near.join(w, same).join(it, F.col("item_id").eqNullSafe(F.col("_item"))).select(
        "doc_id", "text_key", "item_id", "start", "m", "shingles", "item_shingles")
    found = map_arrow(both, _verifier(percent), "doc_id long, text_key long, item_id long, start int, m int, similarity double")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("minus"), "m")).alias("b")
    return found.groupBy("doc_id", "text_key", "item_id").agg(best).select(
        "doc_id", "text_key", "item_id", (-F.col("b.minus")).alias("start"), F.col("b.m").alias("m"), F.col("b.similarity").alias("similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """The documents without a hit, with all their columns."""
    bad = hits(docs, benchmark, percent).select(F.col("doc_id").alias("\x01h_id"), F.col("text_key").alias("\x01h_text")).distinct()
    cond = F.col("doc_id").cast("long").eqNullSafe(F.col("\x01h_id")) & (text_key(F.col("text")) == F.col("\x01h_text"))
    return docs.join(bad.hint("shuffle_hash"), cond, "left_anti")
