"""Exact Jaccard similarity join of shingle sets by universe partition.

Two sets of sizes a and b that reach the similarity differ in at most
``H = (100 - percent) * (a + b) // (100 + percent)`` shingles. Sets of a size band share one
partition of the universe into segments (by a hash of the shingle), and a set gets keys from
its segments so that any two similar sets share a key:

* a whole subset (the shingles of one segment) is broken by one different shingle;
* a subset with its one-deletion neighbourhood (the subset, and it less each shingle in turn)
  is broken by two. So a set with u such segments that fail differs in at most H - 2 u shingles
  elsewhere.
* Of the whole subsets a set needs only the first ``H - 2 u + 1`` in an order that all sets
  share: at most H - 2 u of them differ, so the first ones of two similar sets meet. Cheap ones
  come first: those with a shingle that is not frequent, then the larger ones.
* A set with fewer subsets than that gives all it has. Two such sets could still miss each other,
  so they alone get keys by further partitions, until one has enough subsets for each of them.

The costs decide how many segments of a band take neighbourhoods (``allocate``): the rows they
need against the meetings expected from the share of frequent shingles, which one pass over all
texts measures. Sets also get keys in the next band up if partners may lie there. Costs only
steer the amount of work; which pairs are found does not depend on them.

As Spark work:
1. one pass counts shingles that are frequent within a block of texts and the sizes of the bands;
2. one pass makes each row's set digest, keys and parity bitmap;
3. rows with equal sets are one class, and what follows is between classes; keys of one class go;
4. every member of a bucket is paired with the bucket's smallest member (a hub): pairs grow
   with the rows, not with the square of a bucket; pairs are verified on full sets, and connected;
5. buckets with the same members count once. In those that still hold several components every
   member is paired with the next one, in an order drawn anew each turn: again no more pairs than
   rows. What is linked becomes one component; turns end when they link few;
6. buckets that still hold several components pair their members across components. The join
   compares sizes and parity bitmaps, whose distance is never more than that of the sets, so what
   it drops is certain to be too far; the rest is verified. Pairs within a component can't
   change it. No bucket is capped.

Null and empty texts have no shingles and are linked with nothing. A text under five words is one
shingle. Repeated rows are in one class. The smallest doc_id of a component is its
component_id; ids may repeat, null ids are linked by their texts and give no component_id
unless another row does. Empty tables give empty results. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.components import connected_components
from riskframe.llm.shared import discard, map_arrow, need, text_key, written
from riskframe.llm.textcols import U, Words, distinct_per_row, mix, mix_int, row_groups, shingles, text_bytes

MOST_FREQUENT = 1 << 16  # frequent shingles that are told apart; beyond it the less frequent count as rare
FREQUENT_ROWS, FREQUENT_SHARE = 8, 64  # frequent: in at least so many rows of a block, and one of so many
PER_SEGMENT = 2.5  # shingles of the largest set of a band in a segment of its own
NEIGHBOURS = 8  # and in one with a neighbourhood
SEEDS = 8
MIN_BITS, MAX_BITS = 128, 1 << 14
TURNS, TURN_SHARE = 8, 256  # at most so many turns; one more if the last linked one of so many components
NARROW_BITS = 1024  # of the bitmap that travels with every key of a bucket


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and the bounds of the rows."""
    w = Words(data, offsets)
    h, row = shingles(w.hashes(lower=True), w.first)
    return distinct_per_row(h, row, len(offsets) - 1)


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for lo, hi in row_groups(offsets):
            yield batch, lo, hi, *shingle_sets(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])


# --- bands and their costs

@dataclass(frozen=True)
class Band:
    """Sets of low to high - 1 shingles: segments with neighbourhoods, and plain ones."""

    level: int
    neighbours: int
    plain: int

    @property
    def low(self) -> int:
        return 1 << self.level

    @property
    def high(self) -> int:
        return 2 << self.level


def difference(a, b, percent: int):
    """Most shingles in which similar sets of sizes a and b differ."""
    return (100 - percent) * (a + b) // (100 + percent)


def budget(n: np.ndarray, band: Band, percent: int) -> np.ndarray:
    """Most shingles in which sets of sizes n differ from similar sets of the band that are as
    large or larger, or -1 if there can be none."""
    largest = np.minimum(band.high - 1, 100 * n // percent)
    return np.where(largest >= np.maximum(n, band.low), difference(n, largest, percent), -1)


def allocate(level: int, rows: int, frequent: float, percent: int) -> Band:
    """The number of segments with neighbourhoods that costs least for a band of ``rows`` sets of
    which a share ``frequent`` of the shingles is frequent. Cost: keys, and sets met under them."""
    low, high = 1 << level, 2 << level
    most = int(difference(high - 1, high - 1, percent))
    share = min(max(frequent, 1e-3), 0.99)
    best = None
    for k in range((most + 1) // 2 + 1):
        size = min(NEIGHBOURS, low)
        left = max(high - k * size, 0)
        need_plain = max(most + 1 - 2 * k, 0)
        plain = max(int(np.ceil(left / PER_SEGMENT)), 2 * need_plain if low < 16 else need_plain)
        if need_plain and plain <= need_plain and k:
            continue
        if k * size > low and k > 1:
            break
        per = left / plain if plain else 0.0
        keys = k * (1 + size) + need_plain
        met = rows * (k * (1 + size) * share ** max(size - 1, 1) + need_plain * share ** max(per, 1.0))
        if best is None or keys + met < best[0]:
            best = (keys + met, Band(level, k, plain if need_plain else 0))
    return best[1]


# --- keys

_SALT = 0xA24BAED4963EE407


def _segments(tokens: np.ndarray, seed: int, band: Band) -> np.ndarray:
    """Segment of each shingle: those with neighbourhoods come first and are wider."""
    weight = max(1, round(NEIGHBOURS / PER_SEGMENT))
    wide = band.neighbours * weight
    if not band.plain:
        weight, wide = 1, band.neighbours
    at = ((mix(tokens ^ U(mix_int(seed))) >> U(32)) * U(max(wide + band.plain, 1)) >> U(32)).astype(np.int64)
    return np.where(at < wide, at // weight, band.neighbours + at - wide)


def _subsets(tokens: np.ndarray, row: np.ndarray, n_rows: int, seed: int, band: Band, frequent: np.ndarray):
    """The subsets of all rows: row, segment, size, sum of shingle values, whether all are
    frequent; and the shingle values in that order with the subset of each."""
    count = band.neighbours + band.plain
    seg = _segments(tokens, seed, band)
    order = np.argsort(row * count + seg, kind="stable")
    at = (row * count + seg)[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = at[1:] != at[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(bool), z.astype(np.uint64), z
    value = mix(tokens[order] ^ U(mix_int(seed + 101)))
    size = np.diff(np.append(first, len(at)))
    common = np.add.reduceat(frequent[order].astype(np.int64), first) == size
    return at[first] // count, at[first] % count, size, np.add.reduceat(value, first), common, value, np.repeat(np.arange(len(first)), size)


def _key(total: np.ndarray, segment, seed: int, band: Band) -> np.ndarray:
    return mix(total ^ mix(np.asarray(segment).astype(np.uint64) * U(64) + U(band.level) + U(mix_int(_SALT + seed))))


def _first_of(row: np.ndarray, common: np.ndarray, size: np.ndarray, key: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Indices of the first ``wanted[row]`` subsets of each row, cheap ones first."""
    order = np.lexsort((key, -size, common, row))
    r = row[order]
    start = np.searchsorted(r, r, side="left")
    return order[np.arange(len(r)) - start < wanted[r]]


def band_keys(tokens: np.ndarray, row: np.ndarray, n: np.ndarray, band: Band, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of sets of sizes ``n`` in one band. ``row`` is sorted."""
    most = budget(n, band, percent)
    rows_out, keys_out = [], []
    r, seg, size, total, common, value, of = _subsets(tokens, row, len(n), 0, band, frequent)
    key = _key(total, seg, 0, band)
    wide = seg < band.neighbours
    live = most[r] > 0  # no difference allowed: only equal sets, which are one class
    whole = wide & live
    rows_out.append(r[whole])
    keys_out.append(key[whole])
    several = (whole & (size > 1))[of]
    less = of[several]
    rows_out.append(r[less])
    keys_out.append(_key(total[less] - value[several], seg[less], 0, band))
    usable = np.bincount(r[wide & (size > 1)], minlength=len(n))
    wanted = np.where(most > 0, most - 2 * usable + 1, 0)
    plain = np.flatnonzero(~wide & live)
    pick = plain[_first_of(r[plain], common[plain], size[plain], key[plain], np.maximum(wanted, 0))]
    rows_out.append(r[pick])
    keys_out.append(key[pick])
    have = np.bincount(r[plain], minlength=len(n))
    poor = (wanted > 0) & (have < wanted)
    # further partitions for those with too few subsets, without neighbourhoods
    single = Band(band.level, 0, max(2 * band.high, 8))
    for seed in range(1, SEEDS + 1):
        if not poor.any():
            break
        mine = poor[row]
        r, seg, size, total, common, _, _ = _subsets(tokens[mine], row[mine], len(n), seed, single, frequent[mine])
        key = _key(total, seg, seed, single)
        pick = _first_of(r, common, size, key, np.where(poor, most + 1, 0))
        rows_out.append(r[pick])
        keys_out.append(key[pick])
        poor = poor & (np.bincount(r, minlength=len(n)) < most + 1)
    if poor.any():  # too few in every partition: these meet under one key a band
        rest = np.flatnonzero(poor)
        rows_out.append(rest)
        keys_out.append(np.full(len(rest), mix_int(_SALT ^ band.level), dtype=np.uint64))
    return np.concatenate(rows_out), np.concatenate(keys_out)


def set_keys(sets: np.ndarray, bounds: np.ndarray, bands: dict[int, Band], frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of each row, and the bounds of the rows."""
    n = np.diff(bounds)
    level = np.where(n > 0, np.frexp(np.maximum(n, 1).astype(np.float64))[1] - 1, -1)
    marked = np.zeros(len(sets), dtype=bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, sets), len(frequent) - 1)
        marked = frequent[at] == sets
    rows_out, keys_out = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    for up in (0, 1):
        for lv in np.unique(level[level >= 0]).tolist():
            band = bands.get(lv + up)
            if band is None:
                continue
            rows = np.flatnonzero(level == lv)
            rows = rows[budget(n[rows], band, percent) > 0]
            if not len(rows):
                continue
            size = n[rows]
            row = np.repeat(np.arange(len(rows)), size)
            at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + bounds[:-1][rows][row]
            r, k = band_keys(sets[at], row, size, band, marked[at], percent)
            rows_out.append(rows[r])
            keys_out.append(k)
    return distinct_per_row(np.concatenate(keys_out), np.concatenate(rows_out), len(n))


def parity_bits(level: int) -> int:
    return min(max(MIN_BITS, 4 << level), MAX_BITS)


def parities(sets: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Per row words of 64 bits: each bit is the parity of the shingles that fall on it. Two of
    them differ in no more bits than the sets in shingles. The length grows with the size."""
    h = mix(sets ^ U(0x6C62272E07BB0142))
    out = []
    for i in range(len(bounds) - 1):
        n = int(bounds[i + 1] - bounds[i])
        bits = parity_bits(max(n, 1).bit_length() - 1)
        odd = np.bincount((h[bounds[i]: bounds[i + 1]] & U(bits - 1)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64))
    return out


def narrow(words: np.ndarray) -> np.ndarray:
    """A parity bitmap folded to NARROW_BITS at most."""
    while len(words) * 64 > NARROW_BITS:
        words = words[: len(words) // 2] ^ words[len(words) // 2:]
    return words


def _lists(values: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in values])])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(values)))


def _distance(x: str, y: str) -> Column:
    """Bits in which two parity bitmaps differ. A longer one is folded to the length of the other:
    a bit's place is a hash modulo the length, a power of two."""
    def folded(a: str, b: str) -> Column:
        # bands differ by one at most, so by one fold
        half = (F.size(a) / 2).cast("int")
        halves = F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(a) > F.size(b), halves).otherwise(F.col(a))

    both = F.zip_with(folded(x, y), folded(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(both, F.lit(0), lambda t, v: t + v)


def _near_enough(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _most(a: str, b: str, percent: int) -> Column:
    return F.floor((F.col(a) + F.col(b)) * (100 - percent) / (100 + percent))


# --- passes over the texts

def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent shingles of each block (key, rows), and under negative keys -1 - level: rows,
    shingles and frequent shingles of each band."""
    bands = np.zeros((64, 3), dtype=np.int64)
    for _, _, _, sets, bounds in _sets_of(batches):
        n = np.diff(bounds)
        value, count = np.unique(sets, return_counts=True)
        often = count >= max(FREQUENT_ROWS, len(n) // FREQUENT_SHARE)
        value, count = value[often], count[often]
        if len(value):
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(value), dtype=np.int32)), pa.array(value.view(np.int64)), pa.array(count),
                                              pa.nulls(len(value), pa.int64()), pa.nulls(len(value), pa.int64())], _MEASURED)
        inside = np.isin(sets, value) if len(value) else np.zeros(len(sets), dtype=bool)
        level = np.frexp(np.maximum(n, 1).astype(np.float64))[1] - 1
        hits = np.concatenate([[0], np.cumsum(inside)])
        np.add.at(bands, level, np.stack([(n > 0).astype(np.int64), n, hits[bounds[1:]] - hits[bounds[:-1]]], axis=1))
    at = np.flatnonzero(bands[:, 0])
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(at), dtype=np.int32)), pa.array(at.astype(np.int64)), *map(pa.array, bands[at].T)], _MEASURED)


_MEASURED = ["kind", "key", "rows", "shingles", "frequent"]


def measure(texts: DataFrame, percent: int) -> tuple[dict[int, Band], np.ndarray]:
    """The bands with their allocation, and the sorted hashes of the most frequent shingles."""
    found = map_arrow(texts, _measure, "kind int, key long, rows long, shingles long, frequent long").groupBy("kind", "key").agg(
        *(F.sum(c).alias(c) for c in _MEASURED[2:]))
    found = written(found, "measured")
    bands = {r["key"]: r for r in found.where("kind = 1").collect()}  # one row a power of two
    frequent = found.where("kind = 0").orderBy(F.desc("rows"), "key").limit(MOST_FREQUENT).collect()
    frequent = np.sort(np.array([r["key"] for r in frequent], dtype=np.int64).view(np.uint64))
    out = {}
    for level in {lv + up for lv in bands for up in (0, 1)}:
        r = bands.get(level) or bands.get(level - 1)
        out[level] = allocate(level, r["rows"], r["frequent"] / max(r["shingles"], 1), percent)
    return out, frequent


SIGNED = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, parity array<long>, narrow array<long>, keys array<long>"


def _sign(bands: dict[int, Band], frequent: np.ndarray, percent: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lo, hi, sets, bounds in _sets_of(batches):
            digest = []
            for seed in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
                total = np.concatenate([[U(0)], np.cumsum(mix(sets ^ U(seed)), dtype=np.uint64)])
                digest.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
            keys, key_bounds = set_keys(sets, bounds, bands, frequent, percent)
            words = parities(sets, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key")]
                + [pa.array(np.diff(bounds), pa.int64()), *map(pa.array, digest), _lists(words), _lists([narrow(w) for w in words]),
                   pa.ListArray.from_arrays(pa.array(key_bounds, pa.int32()), pa.array(keys.view(np.int64)))],
                ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "parity", "narrow", "keys"])

    return sign


def _verifier(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict = {}
        for batch in batches:
            u, v = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v"))
            good = np.zeros(len(u), dtype=bool)
            for i in range(len(u)):
                pair = []
                for c, k in (("text_u", int(u[i])), ("text_v", int(v[i]))):
                    if k not in sets:
                        while sum(len(s) for s in sets.values()) > 1 << 22 or len(sets) > 256:
                            sets.pop(next(iter(sets)))
                        sets[k] = shingle_sets(*text_bytes(batch.column(c).slice(i, 1)))[0]
                    pair.append(sets[k])
                common = len(np.intersect1d(*pair, assume_unique=True))
                good[i] = 100 * common >= percent * (len(pair[0]) + len(pair[1]) - common)
            yield pa.RecordBatch.from_arrays([pa.array(u[good]), pa.array(v[good])], ["u", "v"])

    return verify


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    side = lambda s: texts.select(F.col("rep").alias(s), F.col("text").alias(f"text_{s}"))
    return map_arrow(pairs.join(side("v"), "v").join(side("u"), "u"), _verifier(percent), "u long, v long")


def _beside(open_: DataFrame, turn: int) -> DataFrame:
    """Members of a bucket and the next one in the turn's order, if it is of another component:
    u, v and their labels."""
    order = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(turn), "key", "rep"), "rep")
    this = F.struct("rep", "label")
    pairs = open_.select("key", "rep", "label").select(this.alias("x"), F.lead(this).over(order).alias("y")).where("x.label <> y.label")
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return pairs.select(F.col("x.rep").alias("u"), F.col("y.rep").alias("v"), F.col("x.label").alias("label_u"), F.col("y.label").alias("label_v")).distinct()


def _relabelled(open_: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows of buckets that still hold several components, once ``joined`` labels are one."""
    now = joined.select(F.col("node").alias("label"), "component")
    rows = open_.join(now, "label", "left").withColumn("label", F.coalesce("component", "label")).drop("component")
    mixed = rows.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("key")
    return written(rows.join(mixed, "key", "left_semi").select(*open_.columns), "open")


def similar_sets(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    need(docs, "doc_id", "text")
    if not 50 <= percent <= 100:
        raise ValueError("percent must be 50 to 100: similar sets lie in one band or in two that follow each other")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    bands, frequent = measure(rows.select("text"), percent)
    full = written(map_arrow(rows, _sign(bands, frequent, percent), SIGNED), "signed")
    signed = written(full.drop("keys"), "sets")
    # classes of equal sets get numbers, fixed by being written; what they are decides no result
    classes = signed.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("doc_id").alias("least"), F.min(F.struct(F.isnull("doc_id").alias("without"), "doc_id", "text_key", "parity", "narrow")).alias("r"))
    classes = written(classes.select("set_a", "set_b", "n_shingles", F.monotonically_increasing_id().alias("rep"), "least",
                                     F.col("r.doc_id").alias("r_id"), F.col("r.text_key").alias("r_key"), F.col("r.parity").alias("parity"), F.col("r.narrow").alias("narrow")), "set-classes")

    # 64 bits of the digest stand for a class here; a pair of them means every class that has them
    keys = full.select(F.explode("keys").alias("key"), "set_a")
    shared = keys.groupBy("key").agg(F.min("set_a").alias("hub"), F.max("set_a").alias("other")).where("hub <> other")
    shared = written(shared.select("key", "hub"), "shared-keys")
    buckets = written(keys.join(shared, "key").select("key", "hub", "set_a"), "buckets")
    discard(full)  # the largest table; all that is read from here on has been written
    discard(shared)
    met = classes.join(buckets.select("set_a").distinct(), "set_a", "left_semi")
    met = written(met.select("set_a", "rep", "n_shingles", "parity", "narrow", "r_id", "r_key"), "met")

    def side(s: str) -> DataFrame:
        return met.select(F.col("set_a").alias(f"set_{s}"), F.col("rep").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("parity").alias(f"parity_{s}"))

    spokes = written(buckets.where("hub <> set_a").select(F.col("hub").alias("set_u"), F.col("set_a").alias("set_v")).distinct(), "spokes")
    close = _near_enough("n_u", "n_v", percent) & (_distance("parity_u", "parity_v") <= _most("n_u", "n_v", percent))
    tried = spokes.join(side("v"), "set_v").join(side("u"), "set_u").where(close)
    tried = written(tried.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), "pairs")
    of = met.select("rep", F.col("r_id"), F.col("r_key"))
    texts = written(rows.join(of.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_key")))
                    .select("rep", "text").dropDuplicates(["rep"]), "texts")
    links = written(_verified(tried, texts, percent), "links")
    found = connected_components(links)

    # what is left: members of one bucket in different components
    labels = found.select(F.col("node").alias("rep"), "component")
    labelled = written(met.join(labels, "rep", "left").select(
        "set_a", "rep", "n_shingles", "narrow", F.coalesce("component", "rep").alias("label")), "labelled")
    members = buckets.select("key", "set_a").join(labelled.select("set_a", "rep", "label"), "set_a")
    # a bucket is its members here: copies of a set share all keys, so equal sums are equal members
    same = [F.sum(F.xxhash64(F.lit(i), "rep").cast("decimal(38,0)")).alias(f"sum_{i}") for i in range(2)]
    mixed = members.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("n"), *same).where("a <> b")
    mixed = written(mixed.groupBy("n", "sum_0", "sum_1").agg(F.min("key").alias("key")).select("key"), "mixed-keys")
    open_ = written(buckets.select("key", "set_a").join(mixed, "key").join(labelled, "set_a").select(
        "key", "rep", "label", "n_shingles", "narrow").distinct(), "open")
    discard(buckets)
    by_rep = lambda s: side(s).drop(f"set_{s}")
    for turn in range(TURNS):
        next_ = written(_beside(open_, turn).join(tried, ["u", "v"], "left_anti"), "beside")
        near = written(next_.join(by_rep("v"), "v").join(by_rep("u"), "u").where(close).select("u", "v"), "pairs")
        tried = tried.union(near)
        found_now = written(_verified(near, texts, percent), "links")
        links = links.union(found_now)
        joined = connected_components(next_.join(found_now, ["u", "v"]).select(F.col("label_u").alias("u"), F.col("label_v").alias("v")))
        n_joined = joined.count()
        discard(next_)
        if not n_joined:
            break
        before = open_
        open_ = _relabelled(open_, joined)
        discard(before)
        if n_joined * TURN_SHARE < open_.select("label").distinct().count():
            break
    x, y = (open_.select("key", *(F.col(c).alias(c + s) for c in ("rep", "label", "n_shingles", "narrow"))) for s in "xy")
    cond = ((x.key == y.key) & (F.col("labelx") < F.col("labely")) & _near_enough("n_shinglesx", "n_shinglesy", percent)
            & (_distance("narrowx", "narrowy") <= _most("n_shinglesx", "n_shinglesy", percent)))
    rest = x.join(y, cond).select(F.least("repx", "repy").alias("u"), F.greatest("repx", "repy").alias("v")).distinct()
    rest = written(rest.join(tried, ["u", "v"], "left_anti"), "open-pairs")
    rest = rest.join(by_rep("v"), "v").join(by_rep("u"), "u").where(close).select("u", "v")
    links = links.union(written(_verified(rest, texts, percent), "links"))
    found = connected_components(links)

    of_class = written(classes.select("set_a", "set_b", "n_shingles", "rep", "least").join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("set_a").alias("a"), F.col("set_b").alias("b"), F.col("n_shingles").alias("n"), "least", F.coalesce("component", "rep").alias("label")), "of-class")
    least = of_class.groupBy("label").agg(F.min("least").alias("component_id"))
    of_set = written(of_class.join(least, "label").select("a", "b", "n", "component_id"), "of-set")
    out = signed.select("doc_id", "n_shingles", "set_a", "set_b")
    linked = out.where("n_shingles > 0").join(
        of_set, (F.col("set_a") == F.col("a")) & (F.col("set_b") == F.col("b")) & (F.col("n_shingles") == F.col("n")))
    return linked.select("doc_id", "n_shingles", "component_id").union(
        out.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
