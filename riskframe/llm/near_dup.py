"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct 5-word shingles. Its sketch has ``REGISTERS`` buckets; each
keeps, for the smallest shingle hash that falls into it, the number of leading zeros (6
bits) and the next 10 bits. An empty bucket borrows that of a bucket drawn by a fixed
pseudo-random sequence, so a register agrees with a probability close to the Jaccard
similarity for sets of any size. ``BANDS`` bands of ``ROWS`` registers propose pairs; the
collision-corrected estimate from all registers drops far ones; full sets decide.

As Spark work:
1. one Arrow pass over the texts gives set size, 128-bit set digest and sketch;
2. rows with equal sets become one class with a number of its own, represented by its smallest
   (doc_id, text_key), ids that are null last;
3. band keys of representatives are counted; keys held by one representative go away;
4. in each remaining bucket the member that meets most others over all bands is the hub,
   and every other member of similar size is paired with it: pairs grow with the rows,
   not with the square of a bucket;
5. pairs are verified on whole texts; connected components follow;
6. buckets that still hold several components pair their members across components; pairs
   inside a component cannot change it. The join itself compares fine sketches (``FINE``
   buckets, 4 bits of each minimum) and emits only pairs whose estimate is not far below the
   threshold, in the first band that they share, so that a large bucket of texts that are alike, but not enough, doesn't emit
   its square. These pairs are verified in the same way. So every pair that shares a band is
   connected, verified or estimated to be far, with no cap on any bucket.

With 32 bands of 4 registers a pair of similarity 0.75 shares no band with a probability of
about 5e-6, and less above. Hot buckets, hot texts and hot hubs only meet in sums, or in
joins against one row a key, which adaptive execution splits.

Null and empty texts have no shingles and are linked with nothing. A text under five words
is one shingle. A row is known by (doc_id, text_key): rows that share an id, or have none, but
differ in text are linked by their texts only. A component keeps one row, that of the smallest
key (null ids last), and so do fully equal rows, also without shingles. The smallest doc_id of
a component is its component_id, null if no row has one; rows that share an id without being
alike so have one component_id in two components, and one row of each is kept. Empty tables
give empty results.
"""

from __future__ import annotations

import functools
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.components import connected_components
from riskframe.llm.shared import map_arrow, need, text_key, written
from riskframe.llm.textcols import U, Words, distinct_per_row, mix, row_groups, shingles, text_bytes

REGISTERS, BANDS, ROWS = 128, 32, 4
MANTISSA = 10
MARGIN = 0.2  # estimates under the threshold by more than this (5 standard errors) are dropped
EMPTY = 0xFFFF
# order of the rows of a component: smallest (doc_id, text_key), null ids last, one of equal rows
KEY_NAMES = ("without", "doc_id", "text_key", "row")
FINE, FINE_ERRORS = 512, 4.8  # buckets of the fine sketch, standard errors of its margin


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and the bounds of the rows."""
    w = Words(data, offsets)
    h, row = shingles(w.hashes(lower=True), w.first, size)
    return distinct_per_row(h, row, len(offsets) - 1)


@functools.lru_cache(1)
def _donors() -> np.ndarray:
    """For each register a fixed order in which it asks the others when it is empty."""
    order = mix(np.arange(1, REGISTERS * REGISTERS + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
    return np.argsort(order.reshape(REGISTERS, REGISTERS), axis=1)


def sketches(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (rows x REGISTERS, uint16); rows without shingles stay EMPTY."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    h = mix(sets ^ U(0x5851F42D4C957F2D))
    bucket = (h & U(REGISTERS - 1)).astype(np.int64)
    rest = mix(h) | U(1)
    least = np.full(n * REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, row * REGISTERS + bucket, rest)
    full = least != np.iinfo(np.uint64).max
    # leading zeros by the exponent of the float value of the upper 53 bits
    zeros = 53 - np.frexp((least >> U(11)).astype(np.float64))[1]
    zeros = np.minimum(zeros, 62).astype(np.uint64)
    below = (least << zeros) << U(1)  # bits after the first one
    out = (zeros << U(MANTISSA)) | (below >> U(64 - MANTISSA))
    out = np.where(full, out, U(EMPTY)).astype(np.uint16).reshape(n, REGISTERS)
    full = full.reshape(n, REGISTERS)
    todo = np.flatnonzero(full.any(axis=1) & ~full.all(axis=1))
    if len(todo):
        got, have, donors = out[todo], full[todo], _donors()
        filled = have.copy()
        for k in range(REGISTERS):
            ask = donors[:, k]
            take = ~filled & have[:, ask]
            got = np.where(take, out[todo][:, ask], got)
            filled |= take
            if filled.all():
                break
        out[todo] = got
    return out


def fine_sketches(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows x FINE / 16 words of 4-bit values: 0 for an empty bucket, else 1 to 15."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    h = mix(sets ^ U(0x3C6EF372FE94F82B))
    least = np.full(n * FINE, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, row * FINE + (h & U(FINE - 1)).astype(np.int64), h >> U(9))
    value = np.where(least != np.iinfo(np.uint64).max, mix(least) % U(15) + U(1), U(0)).reshape(n, FINE // 16, 16)
    return np.bitwise_or.reduce(value << (np.arange(16, dtype=np.uint64) * U(4)), axis=2)


def _not_far(x: str, y: str, percent: int):
    """Condition on two fine sketches: of the buckets full on either side, the share that
    agrees is not under the threshold (raised by chance agreement) by FINE_ERRORS errors."""
    j = percent / 100 + (1 - percent / 100) / 15
    least = j - FINE_ERRORS * (percent / 100 * (1 - percent / 100) / FINE) ** 0.5

    def lanes(v):
        v = v.bitwiseOR(F.shiftrightunsigned(v, 1))
        return F.bit_count(v.bitwiseOR(F.shiftrightunsigned(v, 2)).bitwiseAND(F.lit(0x1111111111111111)))

    def excess(a, b):
        return lanes(a.bitwiseXOR(b)) * 10_000 - lanes(a.bitwiseOR(b)) * int(10_000 * (1 - least))

    return F.aggregate(F.zip_with(x, y, excess), F.lit(0), lambda t, v: t + v) <= 0


def accidental(n: float, m: float) -> float:
    """Probability that a register of two disjoint sets of n and m shingles agrees by chance."""
    n, m = max(1.0, n / REGISTERS), max(1.0, m / REGISTERS)
    z = np.arange(0, 40)[:, None]
    j = np.arange(1 << MANTISSA)[None, :]
    low = np.ldexp(1.0 + j / (1 << MANTISSA), -z - 1)
    high = low + np.ldexp(1.0, -z - 1 - MANTISSA)
    # chance that the minimum of k uniform values lies in [low, high)
    p = [np.power(1 - low, k) - np.power(1 - np.minimum(high, 1.0), k) for k in (n, m)]
    return float((p[0] * p[1]).sum())


@functools.lru_cache(4096)
def _accidental(a: int, b: int) -> float:
    return accidental(2.0 ** (a / 2), 2.0 ** (b / 2))


def estimate(x: np.ndarray, y: np.ndarray, n: int, m: int) -> float:
    """Jaccard estimate from registers, corrected for accidental agreement."""
    share = float((x == y).mean())
    c = _accidental(*sorted((int(2 * np.log2(max(n, 1))), int(2 * np.log2(max(m, 1))))))
    return max(0.0, (share - c) / (1 - c))


SKETCH_SCHEMA = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, sketch binary, keys array<long>, fine array<long>"


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for lo, hi in row_groups(offsets):
            sets, bounds = shingle_sets(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
            size = np.diff(bounds)
            digest = []
            for seed in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47):
                total = np.concatenate([[U(0)], np.cumsum(mix(sets ^ U(seed)), dtype=np.uint64)])
                digest.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
            sk = sketches(sets, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key")]
                + [pa.array(size, pa.int64()), *map(pa.array, digest),
                   pa.array([r.tobytes() for r in sk], pa.binary()),
                   _lists(band_keys(sk)), _lists(fine_sketches(sets, bounds))],
                ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "sketch", "keys", "fine"])


def band_keys(sk: np.ndarray) -> np.ndarray:
    """One key per band of registers; keys of different bands differ."""
    salt = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    return mix(mix(np.ascontiguousarray(sk).view(np.uint64)) ^ salt)


def _lists(values: np.ndarray) -> pa.Array:
    """A list column of the rows of a matrix of 64-bit words."""
    return pa.FixedSizeListArray.from_arrays(pa.array(values.view(np.int64).ravel()), values.shape[1]).cast(pa.list_(pa.int64()))


def _verifier(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict = {}
        for batch in batches:
            u, v = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v"))
            n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("size_u", "size_v"))
            sk = [np.frombuffer(text_bytes(batch.column(c))[0].tobytes(), dtype=np.uint16).reshape(-1, REGISTERS)
                  for c in ("sketch_u", "sketch_v")]
            good = np.zeros(len(u), dtype=bool)
            for i in range(len(u)):
                if estimate(sk[0][i], sk[1][i], int(n[i]), int(m[i])) < percent / 100 - MARGIN:
                    continue
                pair = []
                for c, k in (("text_u", int(u[i])), ("text_v", int(v[i]))):
                    if k not in sets:
                        while sum(len(s) for s in sets.values()) > 1 << 22 or len(sets) > 256:
                            sets.pop(next(iter(sets)))
                        sets[k] = shingle_sets(*text_bytes(batch.column(c).slice(i, 1)))[0]
                    pair.append(sets[k])
                common = len(np.intersect1d(*pair, assume_unique=True))
                good[i] = 100 * common >= percent * (len(pair[0]) + len(pair[1]) - common)
            yield pa.RecordBatch.from_arrays(
                [pa.array(u[good]), pa.array(v[good])], ["u", "v"])

    return verify


def _similar_sizes(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    side = lambda s: texts.select(F.col("rep").alias(s), F.col("text").alias(f"text_{s}"),
                                  F.col("sketch").alias(f"sketch_{s}"), F.col("n_shingles").alias(f"size_{s}"))
    both = pairs.select("u", "v").join(side("v"), "v").join(side("u"), "u")
    return map_arrow(both, _verifier(percent), "u long, v long")


def classes(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id of every row of ``docs``, and whether it is the
    one that its component keeps."""
    need(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    sk = written(map_arrow(rows, _sketch_batches, SKETCH_SCHEMA).withColumn("row", F.monotonically_increasing_id()), "sketches")
    # a number for every class, fixed by being written; what it is decides no result
    reps = sk.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(
        F.min(F.struct(F.isnull("doc_id").alias("without"), *KEY_NAMES[1:], "sketch", "keys", "fine")).alias("r")).select(
        "set_a", "set_b", "n_shingles", F.monotonically_increasing_id().alias("rep"), F.struct(*(f"r.{c}" for c in KEY_NAMES)).alias("first"),
        F.col("r.sketch").alias("sketch"), F.col("r.keys").alias("keys"), F.col("r.fine").alias("fine"))
    reps = written(reps, "set-classes")

    # what rows are joined to by a key that may be hot is written first: a join of two plain
    # tables is one that adaptive execution can split
    bands = reps.select("rep", "n_shingles", F.posexplode("keys").alias("band", "key"))
    shared = written(bands.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "shared-keys")
    buckets = written(bands.join(shared, "key"), "buckets")

    met = buckets.groupBy("rep").agg(F.sum("held").alias("met"), F.first("n_shingles").alias("n_shingles"))
    hub = buckets.join(met.select("rep", "met"), "rep").groupBy("key").agg(
        F.max(F.struct("met", (-F.col("rep")).alias("minus"), F.col("n_shingles").alias("hub_size"))).alias("h"))
    hub = written(hub.select("key", (-F.col("h.minus")).alias("hub"), "h.hub_size"), "hubs")
    near = buckets.join(hub, "key").where(
        (F.col("rep") != F.col("hub")) & _similar_sizes("n_shingles", "hub_size", percent))
    pairs = written(near.select(F.col("hub").alias("u"), F.col("rep").alias("v")).distinct(), "pairs")

    # texts of the representatives that meet any other, once, for all verification
    some = reps.join(met.select("rep"), "rep", "left_semi").select(
        F.col("rep"), F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key"), "sketch", "n_shingles")
    texts = written(rows.join(some.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
                    .select("rep", "text", "sketch", "n_shingles").dropDuplicates(["rep"]), "texts")
    links = written(_verified(pairs, texts, percent), "links")
    found = connected_components(links)

    # what is left: members of one bucket in different components
    labels = found.select(F.col("node").alias("rep"), "component")
    labelled = buckets.join(labels, "rep", "left").select(
        "key", "band", "rep", "n_shingles", F.coalesce("component", "rep").alias("label"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b")
    mixed = written(mixed.select("key"), "mixed-keys")
    open_ = written(labelled.join(mixed, "key").join(reps.select("rep", "keys", "fine"), "rep"), "open")
    x, y = (open_.select("key", *(F.col(c).alias(c + s) for c in ("band", "rep", "label", "n_shingles", "keys", "fine"))) for s in "xy")
    earlier = F.arrays_overlap(F.slice("keysx", F.lit(1), F.col("bandx")), F.slice("keysy", F.lit(1), F.col("bandx")))
    cond = ((x.key == y.key) & (F.col("labelx") < F.col("labely")) & _similar_sizes("n_shinglesx", "n_shinglesy", percent)
            & ~earlier & _not_far("finex", "finey", percent))
    rest = x.join(y, cond).select(
        F.least("repx", "repy").alias("u"), F.greatest("repx", "repy").alias("v")).distinct()
    tried = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    rest = rest.join(tried, ["u", "v"], "left_anti")
    more = written(_verified(rest, texts, percent), "links")
    if not more.isEmpty():
        found = connected_components(links.union(more))

    of_rep = written(reps.join(found, F.col("rep") == F.col("node"), "left").select(
        "set_a", "set_b", F.col("n_shingles").alias("_n"), "first", F.coalesce("component", "rep").alias("label")), "of-class")
    first = written(of_rep.groupBy("label").agg(F.min("first").alias("kept_row")), "first-rows")
    of_set = of_rep.drop("first").join(first, "label")
    s = sk.drop("sketch", "keys", "fine")
    cond = (s.set_a == of_set.set_a) & (s.set_b == of_set.set_b) & (s.n_shingles == F.col("_n"))
    out = ["doc_id", "text_key", "n_shingles"]
    linked = s.join(of_set, cond).select(
        *out, F.col("kept_row.doc_id").alias("component_id"), (F.col("row") == F.col("kept_row.row")).alias("kept"))
    bare = s.where("n_shingles = 0")
    ones = bare.groupBy("doc_id", "text_key").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("one"))
    return linked.union(bare.join(ones, "row", "left").select(
        *out, F.col("doc_id").alias("component_id"), F.coalesce("one", F.lit(False)).alias("kept")))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (one row a component)."""
    return classes(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows that represent their component, one of each, with all columns. Of rows equal in
    id and text that differ in other columns any one stays."""
    nodes = classes(docs, percent).groupBy(F.col("doc_id").alias("\x01k_id"), F.col("text_key").alias("\x01k_text")).agg(
        F.count(F.lit(1)).alias("copies"), F.max("kept").alias("kept")).where("kept")
    nodes = written(nodes, "kept-rows")
    cond = F.col("doc_id").cast("long").eqNullSafe(F.col("\x01k_id")) & (text_key(F.col("text")) == F.col("\x01k_text"))

    def of(some: DataFrame) -> DataFrame:
        return docs.join(some.hint("shuffle_hash"), cond, "left_semi")

    again = nodes.where("copies > 1")
    if again.isEmpty():
        return of(nodes)
    # named so that no column of the documents is taken for them
    keys = {"\x01id": F.col("doc_id").cast("long"), "\x01text": text_key(F.col("text"))}
    one = of(again).withColumns(keys).dropDuplicates(list(keys)).drop(*keys)
    return of(nodes.where("copies = 1")).union(one)
