"""L5, early stopping with round patience on validation average precision.

MLlib stops on a tolerance of the loss between neighbouring rounds; here training goes on until
``patience`` rounds in a row bring no better average precision (AP) on the validation rows, and the
model keeps the trees up to the best round.

* Boosting is fitted in stages of doubling length (a fit with a seed begins with the same trees
  whatever its length), until the last round is ``patience`` beyond the best one or the round limit
  is reached. At most twice the rounds are trained.
* **Staged margins.** The nodes of the trees become arrays; one pass over the validation rows adds
  a tree's vote per round and counts, per round, the margins in bins. The counts give bounds on
  the AP of every round (``blend_search.ap_bounds``).
* Only rounds whose upper bound reaches the best lower bound before them can set a record; those
  get the exact AP by the prefix plan, in one pass for all of them. The records decide which
  round is best and when patience ends, exactly as with the AP of every round.

Validation rows are read, never collected; what travels are the trees (bounded by rounds and depth).
A tie in AP (9 digits) goes to the earlier round.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.blend_search import TIE, ap_bounds
from riskframe.plans.prefix import ordered_prefix
from riskframe.plans.workers import ship
from riskframe.session import scratch_path

MOST_CELLS = 1 << 21  # bins of all rounds that a task counts
MOST_BINS = 4096
_ROWS = 4096


@dataclass
class Trees:
    """The trees of a boosted model as arrays over (round, node); ``left`` is -1 in a leaf."""

    weight: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.weight)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """(rounds x rows): the margin after each round, added up in the order of the rounds."""
        out = np.empty((len(self), len(x)))
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for k in range(len(self)):
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                inner = self.left[k, at] >= 0
                if not inner.any():
                    break
                go = x[rows, self.feature[k, at]] <= self.threshold[k, at]
                at = np.where(inner, np.where(go, self.left[k, at], self.right[k, at]), at)
            total = total + self.weight[k] * self.value[k, at]
            out[k] = total
        return out


def trees_of(model: GBTClassificationModel) -> Trees:
    """Read from the saved form of the model; features must be continuous."""
    from pyspark.sql import SparkSession

    # trials run in threads of their own, which have no active session
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    path = scratch_path(spark, "boosted-trees")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        "nodeData.split.numCategories", F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("cut")).toPandas()
    if (nodes.loc[nodes["leftChild"] >= 0, "numCategories"] >= 0).any():
        raise ValueError("trees with categorical splits cannot be staged")
    shape = (len(model.treeWeights), int(nodes["id"].max()) + 1)
    at = nodes["treeID"].to_numpy(), nodes["id"].to_numpy()

    def table(column: str, kind, empty) -> np.ndarray:
        out = np.full(shape, empty, dtype=kind)
        out[at] = nodes[column].fillna(empty).to_numpy()
        return out

    return Trees(np.array(model.treeWeights), table("featureIndex", np.int64, 0), table("cut", np.float64, 0.0),
                 table("leftChild", np.int64, -1), table("rightChild", np.int64, -1), table("prediction", np.float64, 0.0))


def first_trees(model: GBTClassificationModel, k: int) -> GBTClassificationModel:
    """The model after ``k`` rounds."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    jvm, trees = sc._jvm, model._java_obj.trees()
    some = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, k)
    weights = sc._gateway.new_array(jvm.double, k)
    for i in range(k):
        some[i], weights[i] = trees[i], float(model.treeWeights[i])
    out = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{model.uid}_first{k}", some, weights, model.numFeatures, model.numClasses))
    return out.setFeaturesCol(model.getFeaturesCol())


def _scored(val: DataFrame) -> DataFrame:
    """Validation rows as (x array, y); rows without a label are in no metric."""
    return val.where(F.col("label").isNotNull()).select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"))


def staged_bounds(trees: Trees, val: DataFrame) -> np.ndarray:
    """(rounds x 2) bounds on the validation AP after each round; one pass."""
    spark, rounds = val.sparkSession, len(trees)
    ship(spark)
    bins = max(64, min(MOST_BINS, MOST_CELLS // rounds))
    held = spark.sparkContext.broadcast(trees)

    def count(parts):
        t = held.value
        total = np.zeros((2, rounds, bins))
        low, high = np.full((rounds, bins), np.inf), np.full((rounds, bins), -np.inf)
        for p in parts:
            for at in range(0, len(p), _ROWS):
                q = p.iloc[at: at + _ROWS]
                m, y = t.margins(np.stack(q["x"].to_numpy())), q["y"].to_numpy()
                cells = np.minimum((bins / (1.0 + np.exp(-2.0 * np.clip(m, -300, 300)))).astype(np.int64), bins - 1)
                for k in range(rounds):
                    total[0, k] += np.bincount(cells[k], y, minlength=bins)
                    total[1, k] += np.bincount(cells[k], 1 - y, minlength=bins)
                    np.minimum.at(low[k], cells[k], m[k])
                    np.maximum.at(high[k], cells[k], m[k])
        r, b = np.nonzero(high >= low)
        yield pd.DataFrame({"round": r.astype(np.int32), "bin": b.astype(np.int32), "tp": total[0, r, b].astype(np.int64),
                            "fp": total[1, r, b].astype(np.int64), "low": low[r, b], "high": high[r, b]})

    def bounds(p: pd.DataFrame) -> pd.DataFrame:  # at most ``bins`` rows
        lo, up = ap_bounds(*(p[c].to_numpy() for c in ("low", "high", "tp", "fp")))
        return pd.DataFrame({"round": [p["round"].iloc[0]], "lower": [lo], "upper": [up]})

    sums = _scored(val).mapInPandas(count, "round int, bin int, tp long, fp long, low double, high double").groupBy("round", "bin").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.min("low").alias("low"), F.max("high").alias("high"))
    out = np.zeros((rounds, 2))
    for r in sums.groupBy("round").applyInPandas(bounds, "round int, lower double, upper double").collect():
        out[r["round"]] = r["lower"], r["upper"]
    return out


def staged_ap(trees: Trees, val: DataFrame, rounds: Sequence[int]) -> dict[int, float]:
    """Exact validation AP after some rounds (from 0); one pass for all of them."""
    spark = val.sparkSession
    ship(spark)
    held, wanted = spark.sparkContext.broadcast(trees), np.array(sorted(rounds))

    def emit(parts):
        for p in parts:
            for at in range(0, len(p), _ROWS):
                q = p.iloc[at: at + _ROWS]
                m = held.value.margins(np.stack(q["x"].to_numpy()))[wanted]
                g = pd.DataFrame({"round": np.repeat(wanted, len(q)).astype(np.int32), "score": m.ravel(),
                                  "tp": np.tile(q["y"].to_numpy(), len(wanted)).astype(np.int64)})
                g["fp"] = 1 - g["tp"]
                yield g.groupby(["round", "score"], as_index=False).sum()

    per = _scored(val).mapInPandas(emit, "round int, score double, tp long, fp long").groupBy("round", "score").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
    curve = ordered_prefix(per, ["round"], "score", ["tp", "fp"], descending=True)
    got = curve.groupBy("round").agg(
        F.sum(F.col("tp") * F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("num"), F.sum("tp").alias("p")).collect()
    return {r["round"]: (r["num"] / r["p"] if r["p"] else 0.0) for r in got}


def possible_records(bounds: np.ndarray) -> list[int]:
    """Rounds whose AP may be larger than that of every round before."""
    best, out = -1.0, []
    for k, (lower, upper) in enumerate(bounds):
        if upper + TIE >= best:
            out.append(k)
        best = max(best, lower)
    return out


def best_round(ap: dict[int, float], rounds: int, patience: int) -> tuple[int, bool]:
    """The best round (from 0) when training stops ``patience`` rounds after a record without another,
    and whether it stops within ``rounds``. ``ap`` holds every round that may be a record."""
    best, value = 0, -1.0
    for k in sorted(ap):
        if k - best > patience:
            return best, True
        if round(ap[k], 9) > round(value, 9):
            best, value = k, ap[k]
    return best, rounds - 1 - best >= patience


@dataclass
class PatientFit:
    model: GBTClassificationModel
    best_round: int  # from 1: the number of trees kept
    trained: int  # rounds of the last stage
    stopped: bool  # by patience, not by the round limit
    exact_rounds: int  # rounds of the last stage that needed the exact AP


def fit_with_patience(make: Callable[[int], object], train: DataFrame, val: DataFrame, rounds: int, patience: int) -> PatientFit:
    """``make(n)`` gives an estimator of n rounds; ``train`` and ``val`` have features and label."""
    n = min(rounds, 2 * patience)
    while True:
        model = make(n).fit(train)
        trees = trees_of(model)
        chosen = possible_records(staged_bounds(trees, val))
        best, stopped = best_round(staged_ap(trees, val, chosen), len(trees), patience)
        if stopped or n >= rounds or len(trees) < n:
            return PatientFit(first_trees(model, best + 1), best + 1, len(trees), stopped, len(chosen))
        n = min(rounds, 2 * n)
