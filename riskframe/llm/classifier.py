"""Quality classifier: random-indexing word vectors, pooled, under a small neural network.

Random indexing: every word has a fixed sparse index vector, two of ``DIM`` places with signs,
drawn from its hash. A word's vector is the sum of the index vectors of its neighbours (two
on either side) over all documents: tasks sum over their rows into a table of ``BUCKETS``
hashed words and Spark adds the tables up, so the vectors see the whole corpus and the table
keeps its size. Words here are runs of letters and digits, and runs of other signs.

A document is the mean and the spread of the vectors of its words, their mean with frequent
words weighted down, and the mean product of neighbours' vectors. A network of one hidden layer is fitted with numpy on at
most ``max_rows`` labelled documents (a hash of doc_id picks them beyond that), then its
logits are divided by a temperature that minimises the log loss on labelled rows kept out of
the fit. Only rows that the caller marks for learning lend their labels.

As Spark work: two Arrow passes over the texts; the first ends in a sum by bucket with at
most BUCKETS rows a task, the second writes one vector a document. What reaches the driver is
the word table (1 MB) and the vectors of the bounded sample.

Null and empty texts are the zero vector and get the network's score for it. Labels that are
null are ignored; of several for one doc_id their mean decides. Without labels of both kinds
every score is the share of label 1 (0.5 without any). Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import map_arrow, need, written
from riskframe.llm.textcols import LETTERS, U, Words, row_groups, text_bytes

BUCKETS, DIM, REACH = 8192, 32, 2
SMOOTH = 1e-3  # share of all words at which a word's weight is halved


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U(64 - 13)).astype(np.int64)


def _index_vectors(hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The places and signs of the index vectors."""
    return [(((hashes >> U(s)) & U(DIM - 1)).astype(np.int64), ((hashes >> U(s + 5)) & U(1)).astype(np.float64) * 2 - 1)
            for s in (0, 6)]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(BUCKETS * DIM)
    count = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for lo, hi in row_groups(offsets):
            w = Words(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], LETTERS)
            h = w.hashes()
            b, index = _buckets(h), _index_vectors(h)
            count += np.bincount(b, minlength=BUCKETS)
            for d in range(1, REACH + 1):
                near = w.row[d:] == w.row[:-d]
                for place, sign in index:
                    table += np.bincount((b[:-d] * DIM + place[d:])[near], weights=sign[d:][near], minlength=len(table))
                    table += np.bincount((b[d:] * DIM + place[:-d])[near], weights=sign[:-d][near], minlength=len(table))
    seen = np.flatnonzero(count)
    rows = table.reshape(BUCKETS, DIM)[seen].astype(np.float32)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(count[seen]), *(pa.array(rows[:, i].copy()) for i in range(DIM))],
        ["bucket", "n", *(f"v{i}" for i in range(DIM))])


def word_table(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Word vectors (BUCKETS x DIM, unit length) and word weights, from all documents."""
    names = [f"v{i}" for i in range(DIM)]
    schema = "bucket int, n long, " + ", ".join(f"{v} float" for v in names)
    sums = map_arrow(docs.select("text"), _count_batches, schema).groupBy("bucket").agg(
        F.sum("n").alias("n"), *(F.sum(v).alias(v) for v in names)).toPandas()
    vectors, n = np.zeros((BUCKETS, DIM)), np.zeros(BUCKETS)
    at = sums["bucket"].to_numpy(dtype=np.int64)
    n[at] = sums["n"].to_numpy()
    vectors[at] = sums[names].to_numpy(dtype=float)
    # what remains after the mean context tells words apart
    if n.sum():
        vectors -= np.outer(n, vectors.sum(axis=0) / n.sum())
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors / np.maximum(length, 1e-9)
    weight = SMOOTH / (SMOOTH + n / max(n.sum(), 1.0))
    return vectors.astype(np.float32), weight.astype(np.float32)


def _pool_batches(vectors: np.ndarray, weight: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.hstack([vectors, vectors ** 2, vectors * weight[:, None], weight[:, None]]).astype(np.float32)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_groups(offsets):
                w = Words(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], LETTERS)
                b = _buckets(w.hashes())
                sums = np.zeros((hi - lo, table.shape[1]))
                step = 1 << 16  # words at a time, so that a long row needs no more memory
                alike = np.zeros(hi - lo)
                for a in range(0, len(b), step):
                    row, own = w.row[a: a + step + 1], table[b[a: a + step + 1]]
                    near = np.einsum("ij,ij->i", own[1:, :DIM], own[:-1, :DIM]) * (row[1:] == row[:-1])
                    alike += np.bincount(row[:-1], weights=near, minlength=hi - lo)
                    row, own = row[:step], own[:step]
                    begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                    sums[row[begin]] += np.add.reduceat(own, begin, axis=0)
                n = np.maximum(w.count, 1)[:, None]
                mean, square = sums[:, :DIM] / n, sums[:, DIM: 2 * DIM] / n
                spread = np.sqrt(np.maximum(square - mean ** 2, 0.0))
                rare = sums[:, 2 * DIM: 3 * DIM] / np.maximum(sums[:, -1:], 1e-6)
                out = np.hstack([mean, spread, rare, (alike / np.maximum(w.count - 1, 1))[:, None]]).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array([r.tobytes() for r in out], pa.binary())],
                    ["doc_id", "vector"])

    return run


class Network:
    """Inputs, ``hidden`` tanh units, one logit; Adam on the log loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, batch: int = 256,
                 rate: float = 0.01, decay: float = 1e-4, seed: int = 7):
        r = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        p = [r.normal(size=(x.shape[1], hidden)) / np.sqrt(x.shape[1]), np.zeros(hidden),
             r.normal(size=hidden) / np.sqrt(hidden), np.zeros(1)]
        m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for epoch in range(epochs):
            order = r.permutation(len(x))
            for lo in range(0, len(x), batch):
                i = order[lo: lo + batch]
                h = np.tanh(x[i] @ p[0] + p[1])
                g = (_sigmoid(h @ p[2] + p[3]) - y[i]) / len(i)
                gh = np.outer(g, p[2]) * (1 - h * h)
                t += 1
                step = rate * (1 - epoch / epochs)
                for k, grad in enumerate((x[i].T @ gh + decay * p[0], gh.sum(axis=0), h.T @ g + decay * p[2], g.sum(keepdims=True))):
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad * grad
                    p[k] -= step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        self.p, self.temperature = p, 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.mean) / self.scale @ self.p[0] + self.p[1])
        return h @ self.p[2] + self.p[3]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        z = self.logits(x)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 121))
        loss = [np.mean(np.logaddexp(0, z / t) - y * z / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


class Constant:
    def __init__(self, share: float):
        self.share = share

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def _vectors(column) -> np.ndarray:
    data, _ = text_bytes(column)
    return np.frombuffer(data.tobytes(), dtype=np.float32).reshape(-1, 3 * DIM + 1).astype(np.float64)


def fit(x: np.ndarray, y: np.ndarray, kept_out: np.ndarray) -> Network | Constant:
    """A network fitted on the rows not kept out, its temperature on those kept out."""
    if len(y) < 10 or y.min() == y.max() or len(set(y[~kept_out])) < 2:
        return Constant(float(y.mean()) if len(y) else 0.5)
    net = Network(x[~kept_out], y[~kept_out])
    if kept_out.any():
        net.calibrate(x[kept_out], y[kept_out])
    return net


def _score_batches(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.scores(_vectors(batch.column("vector"))), pa.float64())],
                ["doc_id", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    need(docs, "doc_id", "text")
    need(labels, "doc_id", label)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pooled = written(map_arrow(rows, _pool_batches(*word_table(rows)), "doc_id long, vector binary"), "pooled")
    learn = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = min(1.0, max_rows / max(1, learn.count()))
    sample = learn.where(place < int(share * 1_000_000)).join(pooled.dropDuplicates(["doc_id"]), "doc_id").select(
        "doc_id", "y", "vector", (F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(5)) == 0).alias("kept_out")).orderBy(
        "doc_id").toArrow()
    y = sample.column("y").to_numpy().astype(np.float64)
    model = fit(_vectors(sample.column("vector")), y, sample.column("kept_out").to_numpy().astype(bool))
    scored = map_arrow(pooled, _score_batches(model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
