"""E5, the grid maximum by bounds: average precision (AP) only where it can be the largest.

The blending grid has up to 441 weights. Sorting all rows for each of them is what makes it
expensive; most weights can be told to lose from counts alone:

1. **Joint histogram.** One aggregation of the score tuples into cells (quantile bins per model, at
   most ``cells`` of them), each with its positives, negatives and the smallest and largest value
   of every score. For a weight, the blends of a cell lie between the blends of its corners, which
   bounds the rank of its positives, and so the AP, from below and above. A weight whose upper
   bound is under the best lower bound is out.
2. **Histogram per weight.** For the weights left, one pass over the tuples counts their blends in
   ``bins`` bins each (edges from the cells), a matrix product per batch, no row multiplied. The
   bounds are the same, with much narrower boxes. Passes go on with more bins a weight while
   more than FEW are left and MOST_BINS allows.
3. **Exact AP** by the prefix plan for the weights that are still left, usually a few.

The cells are at most ``cells`` rows and travel to the tasks; everything else is sums. Blends are
computed in the same order of operations everywhere, and rounding is monotone, so the bounds hold
to the last bit. AP counts ties as the step sum does: rows of equal blend share the precision after
the last of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.search import count_below
from riskframe.operators.metrics import scored_rows
from riskframe.plans.materialize import cut
from riskframe.plans.prefix import ordered_prefix
from riskframe.plans.workers import ship

CELLS = 1 << 18
BINS = 4096
TRAVEL_TUPLES = 1 << 20  # of at most five numbers each
MOST_BINS = 1 << 22  # of all weights of a pass together
EDGE_VALUES = 1 << 16
FEW = 4  # so many weights go straight to the exact pass
TIE = 2e-9  # APs are compared at 9 digits: what is that close to the best may tie with it


def average_precision(score: np.ndarray, tp: np.ndarray, fp: np.ndarray) -> float | None:
    """Step-sum AP of weighted scores; None without positives."""
    total = float(tp.sum())
    if not total:
        return None
    # a task holds the tuples beside this: one ordered column at a time, 32-bit places where they do
    order = np.argsort(-score, kind="stable").astype(np.int32 if len(score) < 1 << 31 else np.int64)
    s = score[order]
    last = np.append(s[1:] != s[:-1], True)
    del s
    t = np.cumsum(tp[order], dtype=np.float64)[last]
    f = np.cumsum(fp[order], dtype=np.float64)[last]
    del order
    f += t
    step = np.diff(t, prepend=0.0)
    step *= t
    step /= f
    return float(step.sum() / total)


def ap_bounds(low: np.ndarray, high: np.ndarray, tp: np.ndarray, fp: np.ndarray) -> tuple[float, float]:
    """Bounds on the AP of rows of which only the box [low, high] that holds their score is known.

    A positive of box c is preceded at most by what lies in boxes that end at or above c's low end,
    and at least by what lies in boxes that begin at or above c's high end. Of k positives in a
    box, the i-th has i of them at or above itself."""
    total = float(tp.sum())
    if not total:
        return 0.0, 0.0

    def at_or_above(ends: np.ndarray, weight: np.ndarray, value: np.ndarray) -> np.ndarray:
        order = np.argsort(ends, kind="stable")
        rest = np.append(np.cumsum(weight[order][::-1], dtype=np.float64)[::-1], 0.0)
        return rest[np.searchsorted(ends[order], value, side="left")]

    has = tp > 0
    k, lo, hi = tp[has].astype(np.float64), low[has], high[has]
    most_tp, most_fp = at_or_above(high, tp, lo), at_or_above(high, fp, lo)
    least_tp, least_fp = at_or_above(low, tp, hi), at_or_above(low, fp, hi)
    upper = k * most_tp / (most_tp + least_fp)
    point = lo == hi  # all of the box tie: it counts itself
    before = least_tp + most_fp
    spread = np.log((before + k) / np.maximum(before, 1e-300))  # over the sum of 1 / (before + i)
    lower = np.where(point, k * least_tp / np.maximum(before, 1.0), k - np.where(most_fp > 0, most_fp * np.minimum(spread, k), 0.0))
    return max(0.0, float(lower.sum() / total) - 1e-12), float(upper.sum() / total) + 1e-12


def _blend(points: np.ndarray, scores: Sequence[np.ndarray]) -> np.ndarray:
    """Blends (points x rows), terms added from the first model on, as the column expression does."""
    out = None
    for j, s in enumerate(scores):
        term = points[:, j, None] * s[None, :]
        out = term if out is None else out + term
    return out


def _boxes(points: np.ndarray, lows: Sequence[np.ndarray], highs: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the blends of boxes. A weight can be a rounding error under zero."""
    low = high = None
    for j, (a, b) in enumerate(zip(lows, highs)):
        x, y = points[:, j, None] * a[None, :], points[:, j, None] * b[None, :]
        lo, hi = np.minimum(x, y), np.maximum(x, y)
        low, high = (lo, hi) if low is None else (low + lo, high + hi)
    return low, high


def score_tuples(df: DataFrame, score_cols: Sequence[str], label_col: str) -> DataFrame:
    """Distinct base-score tuples with their positives and negatives, written."""
    for c in score_cols:  # a row without one of the scores has no blend
        df = scored_rows(df, label_col, c)
    y = F.col(label_col).cast("long")
    out = df.groupBy(*(F.col(c).cast("double").alias(f"s{j}") for j, c in enumerate(score_cols))).agg(
        F.sum(y).alias("tp"), F.sum(1 - y).alias("fp"))
    return cut(out, "blend-tuples")


def joint_histogram(tuples: DataFrame, models: int, cells: int = CELLS) -> pd.DataFrame:
    """At most ``cells`` rows: tp, fp and the ends l<j>, h<j> of every score."""
    per = max(1, int(cells ** (1 / models)))
    cols = [f"s{j}" for j in range(models)]
    steps = [i / per for i in range(1, per)]
    if steps:
        cuts = tuples.agg(*(F.percentile_approx(c, steps, 10_000).alias(c) for c in cols)).first()
        bins = [count_below(F.lit(list(cuts[c] or [0.0] * len(steps))), F.col(c), len(steps)) for c in cols]
    else:
        bins = [F.lit(0) for _ in cols]
    ends = [e for j, c in enumerate(cols) for e in (F.min(c).alias(f"l{j}"), F.max(c).alias(f"h{j}"))]
    return tuples.groupBy(*(b.alias(f"b{j}") for j, b in enumerate(bins))).agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), *ends).toPandas()


def _table_of_points(spark, points: np.ndarray, width: int) -> DataFrame:
    """A row per weight, dealt over the cores."""
    ship(spark)
    schema = "point int, " + ", ".join(f"w{j} double" for j in range(points.shape[1]))
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, schema).repartition(max(1, min(len(rows), width)))


def _cell_bounds(tuples: DataFrame, points: np.ndarray, hist: pd.DataFrame) -> np.ndarray:
    """Bounds (lower, upper) of every weight from the joint histogram."""
    spark, models = tuples.sparkSession, points.shape[1]
    held = spark.sparkContext.broadcast({c: hist[c].to_numpy() for c in hist.columns})

    def bounds(parts):
        h = held.value
        lows, highs = [h[f"l{j}"] for j in range(models)], [h[f"h{j}"] for j in range(models)]
        for p in parts:
            out = []
            for w in p[[f"w{j}" for j in range(models)]].to_numpy():
                low, high = _boxes(w[None, :], lows, highs)
                out.append(ap_bounds(low[0], high[0], h["tp"], h["fp"]))
            yield pd.DataFrame({"point": p["point"], "lower": [o[0] for o in out], "upper": [o[1] for o in out]})

    got = _table_of_points(spark, points, spark.sparkContext.defaultParallelism).mapInPandas(
        bounds, "point int, lower double, upper double").collect()
    out = np.zeros((len(points), 2))
    for r in got:
        out[r["point"]] = r["lower"], r["upper"]
    return out


def _edges(points: np.ndarray, hist: pd.DataFrame, bins: int) -> np.ndarray:
    """Per weight ``bins`` - 1 cuts that share the rows of the cells about evenly, as if they lay evenly
    within a cell. Cuts only balance the bins, so some of very many cells are enough."""
    models = points.shape[1]
    some = hist.iloc[:: -(-len(hist) // EDGE_VALUES)]
    within = (np.arange(k := max(1, EDGE_VALUES // len(some))) + 0.5) / k
    at = [(some[f"l{j}"].to_numpy()[:, None] * (1 - within) + some[f"h{j}"].to_numpy()[:, None] * within).ravel() for j in range(models)]
    mass = np.repeat((some["tp"] + some["fp"]).to_numpy(dtype=np.float64), k)
    out = np.zeros((len(points), bins - 1))
    for i in range(len(points)):
        b = _blend(points[i: i + 1], at)[0]
        order = np.argsort(b, kind="stable")
        place = np.searchsorted(np.cumsum(mass[order]), mass.sum() * np.arange(1, bins) / bins)
        out[i] = b[order][np.minimum(place, len(b) - 1)]
    return out


def _weight_bounds(tuples: DataFrame, points: np.ndarray, hist: pd.DataFrame, bins: int) -> np.ndarray:
    """Bounds of every weight from a histogram of its own; one pass, rows are not multiplied."""
    spark, (n, models) = tuples.sparkSession, points.shape
    ship(spark)
    held = spark.sparkContext.broadcast(_edges(points, hist, bins))

    def count(parts):
        cuts, total = held.value, np.zeros((2, n * bins))
        low, high = np.full(n * bins, np.inf), np.full(n * bins, -np.inf)
        for p in parts:
            for at in range(0, len(p), 8192):
                q = p.iloc[at: at + 8192]
                blends = _blend(points, [q[f"s{j}"].to_numpy() for j in range(models)])
                tp, fp = q["tp"].to_numpy(), q["fp"].to_numpy()
                for i in range(n):
                    cell, part = np.searchsorted(cuts[i], blends[i], side="right"), slice(i * bins, (i + 1) * bins)
                    total[0, part] += np.bincount(cell, tp, minlength=bins)
                    total[1, part] += np.bincount(cell, fp, minlength=bins)
                    np.minimum.at(low[part], cell, blends[i])
                    np.maximum.at(high[part], cell, blends[i])
        at = np.flatnonzero(high >= low)
        yield pd.DataFrame({"point": (at // bins).astype(np.int32), "bin": (at % bins).astype(np.int32), "tp": total[0, at].astype(np.int64),
                            "fp": total[1, at].astype(np.int64), "low": low[at], "high": high[at]})

    def bounds(p: pd.DataFrame) -> pd.DataFrame:  # at most ``bins`` rows
        lo, up = ap_bounds(p["low"].to_numpy(), p["high"].to_numpy(), p["tp"].to_numpy(), p["fp"].to_numpy())
        return pd.DataFrame({"point": [p["point"].iloc[0]], "lower": [lo], "upper": [up]})

    sums = tuples.mapInPandas(count, "point int, bin int, tp long, fp long, low double, high double").groupBy("point", "bin").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.min("low").alias("low"), F.max("high").alias("high"))
    out = np.zeros((n, 2))
    for r in sums.groupBy("point").applyInPandas(bounds, "point int, lower double, upper double").collect():
        out[r["point"]] = r["lower"], r["upper"]
    return out


def exact_ap(tuples: DataFrame, points: np.ndarray) -> dict[int, float | None]:
    """AP of each of a few weights, by the prefix plan."""
    models = points.shape[1]
    n = tuples.count()
    blend = None
    for j in range(models):
        term = F.element_at(F.lit([float(p[j]) for p in points]), F.col("point") + 1) * F.col(f"s{j}")
        blend = term if blend is None else blend + term
    per = tuples.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(points) - 1))).alias("point")).groupBy(
        "point", blend.alias("score")).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
    curve = ordered_prefix(per, ["point"], "score", ["tp", "fp"], descending=True, size_bound=(n, len(points)))
    got = curve.groupBy("point").agg(
        F.sum(F.col("tp") * F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("num"), F.sum("tp").alias("p")).collect()
    return {r["point"]: (r["num"] / r["p"] if r["p"] else None) for r in got}


def _left(bounds: np.ndarray) -> np.ndarray:
    return np.flatnonzero(bounds[:, 1] >= bounds[:, 0].max() - TIE)


@dataclass
class GridBest:
    """The best weights, their AP (-1 without positives), and how many of the grid's distinct points
    were left after each step; the last is what went through the exact pass."""

    weights: list[float]
    ap: float
    left: tuple[int, ...]


def grid_best(df: DataFrame, score_cols: Sequence[str], grid: Sequence[Sequence[float]], label_col: str = "Class",
              cells: int = CELLS, bins: int = BINS, travel: int = TRAVEL_TUPLES) -> GridBest:
    """The first point of ``grid`` with the largest AP (compared at 9 digits). Up to ``travel`` distinct
    tuples go to the tasks, which then evaluate all points; more of them stay, and bounds decide."""
    points = np.array(list(dict.fromkeys(map(tuple, grid))), dtype=np.float64)  # in the order of the grid
    tuples = score_tuples(df, score_cols, label_col)
    if tuples.count() <= travel:
        found = {r["point"]: r["ap"] for r in grid_ap_of_few_tuples(tuples, points).collect()}
        if any(v is None for v in found.values()):
            return GridBest([float(w) for w in points[0]], -1.0, (len(points),))
        best = max(found, key=lambda i: (round(found[i], 9), -i))
        return GridBest([float(w) for w in points[best]], found[best], (len(points),))
    hist = joint_histogram(tuples, len(score_cols), cells)
    if not len(hist) or not int(hist["tp"].sum()):
        return GridBest([float(w) for w in points[0]], -1.0, (len(points),))
    keep = _left(_cell_bounds(tuples, points, hist))
    left = [len(points), len(keep)]
    while len(keep) > FEW and (len(left) < 3 or left[-1] < 0.7 * left[-2]):
        keep = keep[_left(_weight_bounds(tuples, points[keep], hist, bins))]
        left.append(len(keep))
        finer = min(8 * bins, MOST_BINS // len(keep))
        if finer < 2 * bins:
            break
        bins = finer
    ap = exact_ap(tuples, points[keep])
    best = max(range(len(keep)), key=lambda i: (round(ap[i], 9), -i))
    return GridBest([float(w) for w in points[keep[best]]], float(ap[best]), tuple(left))


def grid_ap_of_few_tuples(tuples: DataFrame, points: np.ndarray) -> DataFrame:
    """(point, ap) of every point, for tuples that a task can hold: they travel, points are dealt."""
    spark, models = tuples.sparkSession, points.shape[1]
    rows = tuples.toPandas()
    held = spark.sparkContext.broadcast({c: rows[c].to_numpy() for c in rows.columns})

    def ap(parts):
        t = held.value
        scores = [t[f"s{j}"] for j in range(models)]
        for p in parts:
            w = p[[f"w{j}" for j in range(models)]].to_numpy()
            yield pd.DataFrame({"point": p["point"], "ap": [average_precision(_blend(w[i: i + 1], scores)[0], t["tp"], t["fp"]) for i in range(len(w))]})

    return _table_of_points(spark, points, 4 * spark.sparkContext.defaultParallelism).mapInPandas(ap, "point int, ap double")
