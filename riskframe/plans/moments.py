"""Means, variances and covariances of many pairs of columns in one scan.

Every task adds up matrix products of its rows (values times values, values times presence), so a
scan covers all pairs at once; what is shuffled is one row of sums per pair and task, and no plan
lists pairs. Values are shifted by a value of their own column first, so that a large mean does
not swallow the spread; a constant column has a variance of exactly zero.

A pair is judged on the rows that have both values (pairwise complete); NULL and NaN are missing.
Up to ``MOST_PAIRS`` pairs are held per scan; more of them take further scans.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import nan_to_null
from riskframe.plans.workers import ship

MOST_PAIRS = 1 << 20
HEAD_ROWS = 1000
SUMS = ("n", "a", "b", "aa", "bb", "ab")
_ROWS = 1 << 14


@dataclass
class Moments:
    """Per pair (left x right): complete rows, and on those the means, population variances and covariance."""

    n: np.ndarray
    mean_a: np.ndarray
    mean_b: np.ndarray
    var_a: np.ndarray
    var_b: np.ndarray
    cov: np.ndarray

    def correlation(self) -> np.ndarray:
        """NaN where a side is constant or no row is complete."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = self.cov / (np.sqrt(self.var_a) * np.sqrt(self.var_b))
        return np.where((self.var_a > 0) & (self.var_b > 0), out, np.nan)

    def sample_std_a(self) -> np.ndarray:
        """Sample deviation of the left column; NaN under two rows."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.n > 1, np.sqrt(self.var_a * self.n / (self.n - 1)), np.nan)


def _adder(left: Sequence[int], right: Sequence[int], shifts: np.ndarray):
    def columns(batch: pa.RecordBatch, which: Sequence[int]) -> np.ndarray:
        return np.stack([batch.column(f"_c{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in which]) - shifts[list(which), None]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), len(left), len(right)))
        for whole in batches:
            for at in range(0, len(whole), _ROWS):
                batch = whole.slice(at, _ROWS)
                a, b = columns(batch, left), columns(batch, right)
                ha, hb = ~np.isnan(a), ~np.isnan(b)
                a, b = np.where(ha, a, 0.0), np.where(hb, b, 0.0)
                fa, fb = ha.astype(np.float64), hb.astype(np.float64)
                for s, (x, y) in zip(total, ((fa, fb), (a, fb), (fa, b), (a * a, fb), (fa, b * b), (a, b))):
                    s += x @ y.T
        pair = np.arange(total[0].size)
        yield pa.RecordBatch.from_arrays([pa.array(pair), *(pa.array(s.ravel()) for s in total)], ["pair", *SUMS])

    return add


def cross_moments(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> Moments:
    """Moments of every pair of a ``left`` and a ``right`` column."""
    ship(df.sparkSession)
    names = list(dict.fromkeys([*left, *right]))
    at = {c: i for i, c in enumerate(names)}
    slim = df.select(*(nan_to_null(F.col(c).cast("double")).alias(f"_c{i}") for c, i in at.items()))
    shifts = np.zeros(len(names))
    for r in reversed(slim.limit(HEAD_ROWS).collect()):  # the first value of each column near the head
        shifts = np.array([s if v is None or not np.isfinite(v) else v for s, v in zip(shifts, r)])
    sums = np.zeros((len(SUMS), len(left), len(right)))
    step = max(1, MOST_PAIRS // max(1, len(right)))
    schema = "pair long, " + ", ".join(f"{s} double" for s in SUMS)
    for lo in range(0, len(left), step):
        part = left[lo: lo + step]
        add = _adder([at[c] for c in part], [at[c] for c in right], shifts)
        got = slim.mapInArrow(add, schema).groupBy("pair").agg(*(F.sum(s).alias(s) for s in SUMS))
        for r in got.collect():  # one row a pair
            i, j = divmod(r["pair"], len(right))
            sums[:, lo + i, j] = [r[s] for s in SUMS]
    n, a, b, aa, bb, ab = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        ma, mb = a / n, b / n
        va, vb, cov = np.maximum(aa / n - ma * ma, 0.0), np.maximum(bb / n - mb * mb, 0.0), ab / n - ma * mb
    sa, sb = np.array([shifts[at[c]] for c in left])[:, None], np.array([shifts[at[c]] for c in right])[None, :]
    return Moments(n, ma + sa, mb + sb, va, vb, cov)
