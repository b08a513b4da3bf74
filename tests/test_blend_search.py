import numpy as np
import pandas as pd
import pytest

from riskframe.operators import blend_search as B
from riskframe.operators.ensemble import BlendingEnsemble, blend_grid_ap, weight_grid


def _frame(spark, n, models, seed, digits=3):
    r = np.random.default_rng(seed)
    y = (r.random(n) < 0.1).astype(int)
    cols = {f"score_{j}": np.round(np.clip(r.normal(0.3 + 0.1 * (j + 1) * y, 0.2), 0, 1), digits) for j in range(models)}
    return spark.createDataFrame(pd.DataFrame({**cols, "Class": y})), list(cols), cols, y


def _brute(cols, y, grid):
    aps = []
    for ws in grid:
        s = None
        for w, c in zip(ws, cols.values()):
            s = w * c if s is None else s + w * c
        aps.append(B.average_precision(s, y, 1 - y))
    return aps


def test_average_precision_counts_ties_once():
    s, y = np.array([0.9, 0.9, 0.5, 0.1]), np.array([1, 0, 1, 0])
    assert B.average_precision(s, y, 1 - y) == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)
    assert B.average_precision(s, y * 0, 1 - y) is None


@pytest.mark.parametrize("seed", range(30))
def test_bounds_hold(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(2, 400))
    y = (r.random(n) < r.random()).astype(int)
    s = np.round(r.normal(y * r.random(), 1), int(r.integers(0, 4)))
    cell = np.searchsorted(np.sort(r.choice(s, int(r.integers(1, 40)))), s, side="left")
    if y.sum():
        g = pd.DataFrame({"c": cell, "s": s, "y": y, "f": 1 - y}).groupby("c").agg(low=("s", "min"), high=("s", "max"), tp=("y", "sum"), fp=("f", "sum"))
        low, high = B.ap_bounds(*(g[c].to_numpy() for c in ("low", "high", "tp", "fp")))
        ap = B.average_precision(s, y, 1 - y)
        assert low <= ap <= high
        low, high = B.ap_bounds(s, s, y, 1 - y)  # boxes without width
        assert high - low < 1e-9 and low <= ap <= high


@pytest.mark.parametrize("models, cells, bins", [(2, 1 << 18, 4096), (3, 1 << 18, 4096), (3, 27, 512), (2, 4, 64)])
def test_best_point_equals_the_whole_grid(spark, models, cells, bins):
    df, names, cols, y = _frame(spark, 3000, models, models)
    grid = weight_grid(models)
    aps = _brute(cols, y, grid)
    want = max(range(len(grid)), key=lambda i: (round(aps[i], 9), -i))
    for travel in (0, 1 << 20):
        got = B.grid_best(df, names, grid, cells=cells, bins=bins, travel=travel)
        assert got.weights == grid[want] and got.ap == pytest.approx(aps[want], abs=1e-12)


def test_few_points_reach_the_exact_pass(spark):
    """On the events of the small table, and with coarse cells by the second histogram."""
    import riskframe.registry as R

    val = R._event_val(spark, "/root/testdata/sf0.01")
    for cells in (B.CELLS, 512):
        got = B.grid_best(val, R.EVENT_SCORES, weight_grid(3), cells=cells, travel=0)
        assert got.left[0] == 421 and got.left[-1] <= 42, got.left


def test_degenerate_inputs(spark):
    df = spark.createDataFrame([(0.1, 0.2, 0), (0.3, 0.2, 0)], "a double, b double, Class int")
    assert B.grid_best(df, ["a", "b"], weight_grid(2)).ap == -1.0
    assert B.grid_best(df, ["a", "b"], weight_grid(2), travel=0).ap == -1.0
    assert B.grid_best(df.limit(0), ["a", "b"], weight_grid(2), travel=0).weights == [0.0, 1.0]
    one = df.union(spark.createDataFrame([(0.3, 0.2, 1), (None, 0.9, 1), (float("nan"), 0.9, 1), (0.1, 0.2, None)], df.schema))
    best = B.grid_best(one, ["a", "b"], weight_grid(2))
    assert best.ap == pytest.approx(0.5) and best.weights == [0.05, 0.95]
    ens = BlendingEnsemble(["a", "b"]).fit(one)
    assert ens.weights_ == best.weights and ens.val_ap_ == best.ap


def test_grid_tables_agree(spark):
    df, names, cols, y = _frame(spark, 800, 3, 5)
    grid, want = weight_grid(3), None
    for travel in (1 << 20, 0):
        got = {r["weight_id"]: r["pr_auc"] for r in blend_grid_ap(df, names, travel=travel).collect()}
        assert len(got) == 441
        want = want or _brute(cols, y, grid)
        assert all(abs(got[i] - want[i]) <= 1e-6 for i in got)


def test_average_precision_holds_few_copies_of_its_rows():
    import tracemalloc

    r = np.random.default_rng(1)
    n = 200_000
    score, tp, fp = r.random(n), r.integers(0, 2, n), r.integers(0, 3, n) + 1
    B.average_precision(score[:10], tp[:10], fp[:10])
    tracemalloc.start()
    got = B.average_precision(score, tp, fp)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < got < 1 and peak <= 40 * n  # five columns of the length of its rows
