"""Exact, linearly interpolated quantiles without sorting and without holding a group in one task.

Spark's exact ``percentile`` buffers every value of a group in memory, and a sort or range
partitioning moves the whole column for a few ranks. Here the wanted ranks are selected: a double
becomes a 64-bit key of the same order (the sign bit flipped, negative values inverted), and
``DIGITS`` rounds of one scan each narrow all ranks of all columns and groups at once. A round
counts, among the keys that share the digits known so far, the next 16 bits; where the running
count passes a rank lies its digit. What is shuffled are (column, group, digit) counts, at most
65,536 for a wanted rank and task, whatever the number of rows; after the last round the keys
are complete and give the values back bit by bit.

Same definition as Spark ``percentile`` and DuckDB ``quantile_cont``: ranks ``floor(p (n-1))`` and
``ceil(p (n-1))``, interpolated. NULL values are ignored, NaN is the largest, -0.0 equals 0.0.
"""

from __future__ import annotations

import math
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.plans.broadcast import bounded_broadcast
from riskframe.plans.workers import ship

DIGITS, BITS = 4, 16
ALL = "all"  # the group of all rows; other groups are named "=" and their value, or "-" for NULL
MOST_RANKS = 100_000  # wanted ranks travel to the tasks
_TOP = np.uint64(1 << 63)


def ordered_keys(values: np.ndarray) -> np.ndarray:
    """64-bit keys in the order of the values."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.uint64)
    return np.where(bits >= _TOP, ~bits, bits | _TOP)


def values_of(keys: np.ndarray) -> np.ndarray:
    return np.where(keys >= _TOP, keys ^ _TOP, ~keys).view(np.float64)


def _counter(columns: Sequence[str], done: int, known: dict | None, overall: bool, grouped: bool):
    """Counts of the digit after ``done`` digits, per group, column and known leading digits."""
    left = np.uint64(64 - BITS * done)
    shift, mask = np.uint64(64 - BITS * (done + 1)), np.uint64((1 << BITS) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int, int], list] = {}

        def add(group: str, c: int, keys: np.ndarray) -> None:
            if known is None:
                found = [(0, keys)]
            else:
                heads = known.get((group, c))
                if heads is None:
                    return
                head = keys >> left
                at = np.minimum(np.searchsorted(heads, head), len(heads) - 1)
                hit = heads[at] == head
                keys, at = keys[hit], at[hit]
                found = [(int(heads[i]), keys[at == i]) for i in np.unique(at)]
            for head, k in found:
                digit, n = np.unique((k >> shift) & mask, return_counts=True)
                parts = total.setdefault((group, c, head), [])
                parts.append((digit.astype(np.int64), n))
                if len(parts) > 32:
                    parts[:] = [_merged(parts)]

        for batch in batches:
            groups = []
            if grouped:
                codes = batch.column("_group").dictionary_encode()
                index = codes.indices.to_numpy(zero_copy_only=False)
                groups = [(name, index == i) for i, name in enumerate(codes.dictionary.to_pylist())]
            for c in range(len(columns)):
                column = batch.column(f"_c{c}")
                valid = column.is_valid().to_numpy(zero_copy_only=False)
                keys = ordered_keys(column.to_numpy(zero_copy_only=False).astype(np.float64))
                for name, rows in groups:
                    add(name, c, keys[valid & rows])
                if overall:
                    add(ALL, c, keys[valid])
        for (group, c, head), parts in total.items():
            digit, n = _merged(parts)
            if len(digit):
                k = len(digit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group] * k), pa.array(np.full(k, c, dtype=np.int32)), pa.array(np.full(k, head, dtype=np.uint64).view(np.int64)),
                     pa.array(digit), pa.array(n.astype(np.int64))], ["g", "c", "head", "digit", "n"])

    return count


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    digits, at = np.unique(np.concatenate([d for d, _ in parts]), return_inverse=True)
    return digits, np.bincount(at, np.concatenate([n for _, n in parts]), minlength=len(digits)).astype(np.int64)


def select_ranks(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str | None = None,
                 overall: bool = True) -> list[tuple[str, int, int, dict[int, float]]]:
    """(group, column, n, {rank: value}) for the ranks that ``probs`` need, of every group that has values."""
    spark = df.sparkSession
    ship(spark)
    cols = [F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)]
    if by is not None:
        g = F.col(by).cast("string")
        cols.append(F.when(g.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), g)).alias("_group"))
    slim = df.select(*cols)
    ranks: list[tuple[str, int, int, int, int]] = []  # group, column, rank, leading digits, rank among those
    known, sizes = None, {}
    for done in range(DIGITS):
        counts = slim.mapInArrow(_counter(columns, done, known, overall, by is not None), "g string, c int, head long, digit long, n long")
        counts = counts.groupBy("g", "c", "head", "digit").agg(F.sum("n").alias("n"))
        if done == 0:
            counts = counts.persist()
            sizes = {(r["g"], r["c"]): r["n"] for r in counts.groupBy("g", "c").agg(F.sum("n").alias("n")).collect()}
            for (g, c), n in sizes.items():
                ranks += [(g, c, k, 0, k) for k in sorted({f(p * (n - 1)) for p in map(float, probs) for f in (math.floor, math.ceil)})]
            if len(ranks) > MOST_RANKS:
                raise ValueError(f"{len(ranks)} ranks are wanted, at most {MOST_RANKS} can be selected at once")
        if not ranks:
            break
        # at most 65,536 digits of a group, column and head
        before = Window.partitionBy("g", "c", "head").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        signed = [(g, c, k, int(np.uint64(h).astype(np.int64)), i) for g, c, k, h, i in ranks]
        wanted = spark.createDataFrame(signed, "g string, c int, rank long, head long, inner long")
        hits = placed.join(bounded_broadcast(wanted, len(ranks)), ["g", "c", "head"]).where(
            (F.col("before") <= F.col("inner")) & (F.col("inner") < F.col("before") + F.col("n")))
        ranks = [(r["g"], r["c"], r["rank"], ((r["head"] % (1 << 64)) << BITS) | r["digit"], r["inner"] - r["before"]) for r in hits.collect()]
        if done == 0:
            counts.unpersist()
        known = {}
        for g, c, _, head, _ in ranks:
            known.setdefault((g, c), set()).add(head)
        known = {k: np.array(sorted(v), dtype=np.uint64) for k, v in known.items()}
    out: dict = {}
    for g, c, k, key, _ in ranks:
        out.setdefault((g, c), {})[k] = float(values_of(np.array([key], dtype=np.uint64))[0])
    return [(g, c, sizes[g, c], v) for (g, c), v in sorted(out.items())]


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str | None = None,
                    overall: bool = True) -> DataFrame:
    """``(grp, feature, p, q)``: of all rows (``grp`` "all", with ``overall``) and of each value of ``by``
    ("=" and the value, "-" for NULL). A column without values has no rows. Groups must be few."""
    rows = []
    for g, c, n, at in select_ranks(df, columns, probs, by, overall):
        for p in map(float, probs):
            pos = p * (n - 1)
            lo, hi = at[math.floor(pos)], at[math.ceil(pos)]
            rows.append((g, columns[c], p, lo + (pos - math.floor(pos)) * (hi - lo) if hi != lo else lo))
    return df.sparkSession.createDataFrame(rows, "grp string, feature string, p double, q double")
