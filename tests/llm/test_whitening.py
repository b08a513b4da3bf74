import math

import numpy as np
import pytest

from riskframe.llm.whitening import fixed_point, leading_components, lower_bound, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string, vector int, key int"


def _table(spark, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2, "c", 3, 4) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def _data(n, dims, seed, spread=1.3):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, dims)) * spread ** -np.arange(dims)) @ np.linalg.qr(r.standard_normal((dims, dims)))[0] * 0.4


def _brute(vectors, k):
    x = np.floor(1024 * np.asarray(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return x, n, s, c @ q / np.sqrt(e), e / np.trace(c.T @ c / n)


@pytest.mark.parametrize("dims, spread", [(40, 1.1), (5, 1.3)])
def test_equals_numpy(spark, dims, spread):
    good = _data(700, dims, dims, spread)
    odd = [None, [], [0.5] * (dims - 1) + [None], [0.5] * (dims - 1) + [float("nan")], [float("inf")] + [0.1] * (dims - 1), [1.0, 2.0]]
    rows = whiten(_table(spark, [*odd, *good, good[0], good[0]])).collect()
    x, n, s, white, explained = _brute([*good, good[0], good[0]], min(8, dims))
    k = white.shape[1]
    assert len(rows) == n * k and {r["n"] for r in rows} == {n}
    got = np.full((n, k), np.nan)
    for r in rows:
        i = r["vec_id"] - len(odd)
        got[i, r["component"] - 1] = r["whitened"]
        assert r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
        assert math.isclose(r["explained"], explained[r["component"] - 1], rel_tol=1e-9)
        assert 0 <= r["identity_error"] < 1e-9
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-8


def test_certificate_and_bound(spark):
    table = fixed_point(_table(spark, _data(400, 60, 3, 1.02)), "embedding")
    c = leading_components(table)
    x = np.array(_brute(_data(400, 60, 3, 1.02), 8)[0], dtype=float)
    e = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert c.rounds >= 1 and (c.residuals <= 1e-10 * c.values[0]).all()
    assert np.allclose(c.values, e[:8], rtol=1e-12) and lower_bound(table) <= e[-9]


def test_degenerate_tables(spark):
    assert whiten(_table(spark, [])).collect() == []
    assert whiten(_table(spark, [None, [None]])).collect() == []
    same = whiten(_table(spark, [[0.1] * 12] * 5)).collect()
    assert len(same) == 40 and {(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in same} == {(None, None, 0, None)}
    line = whiten(_table(spark, [[0.1 * i] * 30 for i in range(9)])).collect()  # one component has all variance
    assert {r["component"] for r in line if r["whitened"] is not None} == {1}
    assert all(abs(r["explained"] - (r["component"] == 1)) < 1e-9 for r in line)


def test_entries_of_any_size(spark):
    """Sums and deviations beyond 62 bits stay exact, or are null where they don't fit a long."""
    rows = whiten(_table(spark, [[2.0 ** 40, 1.0], [0.0, -1.0], [3.0, 2.0 ** 41], [1e30, 1.0]])).collect()
    assert {r["vec_id"] for r in rows} == {0, 1, 2} and {r["deviation"] for r in rows} == {None}
    mid = [[2.0 ** 18, 1.0], [0.0, -1.0], [3.0, 2.0 ** 17]]
    x, n, s, _, _ = _brute(mid, 2)
    for r in whiten(_table(spark, mid)).collect():
        assert r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[r["vec_id"]], s))
