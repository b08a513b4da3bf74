"""Embedding whitening by Chebyshev-filtered subspace iteration.

An entry c of a vector becomes the integer x = floor(SCALE * c) + SHIFT, so sums are exact. The
leading eigenvectors of the covariance V of the x-vectors (divisor n, centred first) are found
without ever forming V: what passes over the table compute is V Q = X'(X Q) / n for a block Q of
a few columns.

1. One pass counts the vectors and sums their entries exactly.
2. A short Lanczos run bounds the lower end of the spectrum; its start is a fixed direction.
3. Each round applies a Chebyshev polynomial of V to the block: a three-term recurrence, one pass
   a degree, that is small on the unwanted part of the spectrum (from the lower bound to the
   smallest Ritz value of the block) and grows steeply above. Then QR, and Rayleigh-Ritz from one
   more pass.
4. It ends when the wanted pairs are certified: every residual norm ``|V q - e q|`` is under
   ``TOLERANCE`` times the largest eigenvalue, or doesn't fall any more and is under ``FLOOR``
   times it. By then an eigenvalue is off by no more than its residual. Else it raises.

The block has GUARD columns more than are wanted, so that a wanted pair converges by its distance
to the end of the block, not to its neighbour. What travels are dims x block partial sums, one
per task, added up by Spark per cell; the driver holds dims x block matrices, whatever the number
of rows. Tasks can be lost at any time: a pass is a pure function of the table and Q.

Rows whose vector is null, or holds a null or non-finite entry, are dropped; so are vectors
whose length is not the most frequent one (the longer of equally frequent ones), empty vectors
and entries of 2**42 or more, whose x is not exact. Repeated rows and ids count each time. A
component without variance is not whitened (null) and explains 0; with no variance at all,
explained is null. An empty table has no rows. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import map_arrow, need

SCALE, SHIFT = 1024, 100_000
LIMIT = 2.0 ** 42
GUARD = 16
DEGREE, ROUNDS = 10, 40
LANCZOS = 8
TOLERANCE, FLOOR = 1e-13, 1e-10
_BLOCK_ROWS = 4096


def _vectors(batch: pa.RecordBatch, dims: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of the usable rows of a batch, the lengths of all vectors (-1 if unusable), and the
    rows of length ``dims`` as integers."""
    col = batch.column("vector")
    starts = col.offsets.to_numpy()
    lengths = np.diff(starts)
    values = col.values
    entries = values.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = ~np.isfinite(entries) | (np.abs(np.where(np.isfinite(entries), entries, 0.0)) >= LIMIT)
    if values.null_count:
        bad |= values.is_null().to_numpy(zero_copy_only=False)
    wrong = np.concatenate([[0], np.cumsum(bad)])
    lengths = np.where(col.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0), lengths, -1)
    lengths = np.where(wrong[starts[1:]] > wrong[starts[:-1]], -1, lengths)
    if dims is None:
        return np.flatnonzero(lengths > 0), lengths, np.zeros((0, 0), dtype=np.int64)
    rows = np.flatnonzero(lengths == dims)
    at = starts[:-1][rows][:, None] + np.arange(dims)
    return rows, lengths, np.floor(SCALE * entries[at]).astype(np.int64) + SHIFT


def _lengths(batches):
    count: dict[int, int] = {}
    for batch in batches:
        _, lengths, _ = _vectors(_own(batch), None)
        for d, k in zip(*np.unique(lengths[lengths > 0], return_counts=True)):
            count[int(d)] = count.get(int(d), 0) + int(k)
    yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.int64()), pa.array(list(count.values()), pa.int64())], ["dims", "rows"])


def _own(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with arrays of its own, whose offsets start at 0."""
    return pa.RecordBatch.from_arrays([pa.concat_arrays([c]) if c.offset else c for c in batch.columns], schema=batch.schema)


def _sums(dims: int):
    def add(batches):
        high, low = np.zeros(dims, dtype=np.int64), np.zeros(dims, dtype=np.int64)
        for batch in batches:
            _, _, x = _vectors(_own(batch), dims)
            high += (x >> 26).sum(axis=0)  # two limbs: no sum of a task overflows
            low += (x & ((1 << 26) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(high), pa.array(low)], ["cell", "high", "low"])

    return add


@dataclass
class Table:
    """A column of vectors in fixed point: n usable ones of ``dims`` entries, ``sums`` of each entry."""

    vectors: DataFrame
    n: int
    dims: int
    sums: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, from the exact integers n x - S where they fit."""
        big = max(map(abs, self.sums), default=0) + (int(np.abs(x).max()) if x.size else 0) * self.n
        if big < 1 << 62:
            return (x * self.n - np.array(self.sums, dtype=np.int64)) / float(self.n)
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])
        return (x - np.array(whole, dtype=np.int64)).astype(np.float64) - rest

    def slim(self) -> "Table":
        return Table(None, self.n, self.dims, self.sums)


def fixed_point(df: DataFrame, vector: str) -> Table | None:
    """The table behind a column of vectors; None if no row is usable."""
    need(df, vector)
    vectors = df.select(F.col(vector).cast("array<double>").alias("vector"))
    found = map_arrow(vectors, _lengths, "dims long, rows long").groupBy("dims").agg(F.sum("rows").alias("rows"))
    best = found.orderBy(F.desc("rows"), F.desc("dims")).first()
    if best is None:
        return None
    dims = int(best["dims"])
    cells = map_arrow(vectors, _sums(dims), "cell long, high long, low long").groupBy("cell").agg(
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    sums = {r["cell"]: (int(r["high"]) << 26) + int(r["low"]) for r in cells.collect()}  # one row a dimension
    return Table(vectors, int(best["rows"]), dims, [sums[i] for i in range(dims)])


def _pass(table: Table, of) -> np.ndarray:
    """Sum over all rows of the matrix that ``of`` makes of a block of centred rows."""
    t = table.slim()

    def add(batches):
        total = None
        for batch in batches:
            batch = _own(batch)
            for lo in range(0, len(batch), _BLOCK_ROWS):
                _, _, x = _vectors(_own(batch.slice(lo, _BLOCK_ROWS)), t.dims)
                part = of(t.centred(x))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "v"])

    cells = map_arrow(table.vectors, add, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(cells))
    for r in cells:  # dims x block of them
        out[r["cell"]] = r["v"]
    return out


def covariance_times(table: Table, q: np.ndarray) -> np.ndarray:
    """V Q by one pass."""
    return _pass(table, lambda c: c.T @ (c @ q)).reshape(q.shape) / table.n


def total_variance(table: Table) -> float:
    return float(_pass(table, lambda c: np.array([(c * c).sum()]))[0]) / table.n


def _directions(dims: int, columns: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(20_240_229).standard_normal((dims, columns)))[0]


def lower_bound(table: Table, steps: int = LANCZOS) -> float:
    """A value that is, as far as a few Lanczos steps can tell, under all eigenvalues."""
    q, basis, diagonal, off = _directions(table.dims, 1), [], [], []
    for _ in range(min(steps, table.dims)):
        basis.append(q)
        w = covariance_times(table, q)
        diagonal.append(float((q.T @ w)[0, 0]))
        b = np.hstack(basis)
        w = w - b @ (b.T @ w)
        w = w - b @ (b.T @ w)
        off.append(float(np.linalg.norm(w)))
        if off[-1] <= 1e-12 * max(diagonal[0], 1e-300):
            break
        q = w / off[-1]
    k = len(diagonal)
    t = np.diag(diagonal) + np.diag(off[: k - 1], 1) + np.diag(off[: k - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - off[-1])


def chebyshev(table: Table, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of V times Q: small where V's eigenvalues lie in [low, high], scaled so
    that it is 1 at ``top``."""
    half, centre = (high - low) / 2, (high + low) / 2
    scale = first = half / (top - centre)
    y = (covariance_times(table, q) - centre * q) * (scale / half)
    for _ in range(degree - 1):
        nxt = 1 / (2 / first - scale)
        q, y = y, (covariance_times(table, y) - centre * y) * (2 * nxt / half) - scale * nxt * q
        scale = nxt
    return y


@dataclass
class Components:
    """Unit eigenvectors (columns) by falling eigenvalue, their residual norms, the total variance
    and the number of filter rounds."""

    vectors: np.ndarray
    values: np.ndarray
    residuals: np.ndarray
    variance: float
    rounds: int


def leading_components(table: Table, k: int = 8, guard: int = GUARD, degree: int = DEGREE, rounds: int = ROUNDS) -> Components:
    """The ``k`` leading components, certified by their residuals."""
    k = min(k, table.dims)
    width = min(table.dims, k + guard)
    variance = total_variance(table)
    q = _directions(table.dims, width)
    if variance == 0:
        return Components(q[:, :k], np.zeros(k), np.zeros(k), 0.0, 0)
    low = lower_bound(table) if width < table.dims else 0.0
    worst = np.inf
    for r in range(rounds + 1):
        vq = covariance_times(table, q)
        h = q.T @ vq
        e, turn = np.linalg.eigh((h + h.T) / 2)
        e, turn = e[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residuals = np.linalg.norm(vq[:, :k] - q[:, :k] * e[:k], axis=0)
        now = float(residuals.max()) / float(e[0])
        if now <= TOLERANCE or (now <= FLOOR and now > worst / 2):
            return Components(q[:, :k], np.maximum(e[:k], 0.0), residuals, variance, r)
        worst = min(worst, now)
        if width < table.dims:
            high = max(float(e[-1]), low + 1e-9 * float(e[0]))
            q = chebyshev(table, q, min(low, float(e[-1]) * 0.999), high, float(e[0]), degree)
        q = np.linalg.qr(q)[0]
    raise RuntimeError(f"no certificate after {rounds} rounds: residuals {residuals.tolist()}, largest eigenvalue {e[0]}")


def _projection(c: Components) -> np.ndarray:
    """Columns that centred rows are multiplied with; NaN for components without variance."""
    e = np.where(c.values > 1e-12 * max(float(c.values[0]) if len(c.values) else 0.0, 1e-300), c.values, np.nan)
    return c.vectors / np.sqrt(e)


def identity_error(table: Table, c: Components) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    p = _projection(c)
    p = p[:, np.isfinite(p).all(axis=0)]
    if not p.shape[1]:
        return None
    got = _pass(table, lambda x: (x @ p).T @ (x @ p)).reshape(p.shape[1], p.shape[1]) / table.n
    return float(np.abs(got - np.eye(p.shape[1])).max())


def _deviation(t: Table, x: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n x - S) ** 2, exact; null where it doesn't fit a long."""
    about = ((x.astype(np.float64) * t.n - np.array(t.sums, dtype=np.float64)) ** 2).sum(axis=1)
    safe = about < 2.0 ** 62
    out: list = [None] * len(x)
    if safe.any():
        # intermediate products may wrap around, their difference and sum of squares does not
        s = np.array([(v + (1 << 63)) % (1 << 64) - (1 << 63) for v in t.sums], dtype=np.int64)
        d = x[safe] * np.int64(t.n) - s
        for i, v in zip(np.flatnonzero(safe).tolist(), (d * d).sum(axis=1).tolist()):
            out[i] = v
    for i in np.flatnonzero(~safe).tolist():
        v = sum((int(a) * t.n - s) ** 2 for a, s in zip(x[i], t.sums))
        out[i] = v if v < 1 << 63 else None
    return pa.array(out, pa.int64())


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8) -> DataFrame:
    """Per usable row and component (from 1): ``key``, component, n, deviation, whitened, explained,
    identity_error."""
    need(df, key, vector)
    kind = dict(df.dtypes)[key]
    table = fixed_point(df, vector)
    if table is None:
        return df.sparkSession.createDataFrame([], f"`{key}` {kind}, {OUT}")
    c = leading_components(table, k)
    error = identity_error(table, c)
    t, p = table.slim(), _projection(c)
    explained = (c.values / c.variance).tolist() if c.variance else [None] * len(c.values)

    def rows_of(batches):
        for batch in batches:
            batch = _own(batch)
            for lo in range(0, len(batch), _BLOCK_ROWS):
                part = _own(batch.slice(lo, _BLOCK_ROWS))
                rows, _, x = _vectors(part, t.dims)
                w = t.centred(x) @ p
                m, comps = len(rows), p.shape[1]
                keys = part.column("key").take(pa.array(np.repeat(rows, comps)))
                white = w.ravel()
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(np.tile(np.arange(1, comps + 1), m), pa.int32()), pa.array(np.full(m * comps, t.n), pa.int64()),
                     _deviation(t, x).take(pa.array(np.repeat(np.arange(m), comps))),
                     pa.array(white, pa.float64(), mask=~np.isfinite(white)), pa.array(explained * m, pa.float64()),
                     pa.array([error] * (m * comps), pa.float64())],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    both = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    return map_arrow(both, rows_of, f"`{key}` {kind}, {OUT}")

