"""Base-score matrix, blending by a weight grid, stacking with a logistic meta-learner.

Blending (E5): identical base-score tuples are collapsed first (one row per distinct
tuple with its tp/fp counts). ``BlendingEnsemble`` finds the best of the n or n^2 grid
points (21 / 441 by default) by bounds on their average precision (``blend_search``);
``blend_grid_ap`` gives the table of all of them.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.blend_search import TRAVEL_TUPLES, grid_ap_of_few_tuples, grid_best, score_tuples
from riskframe.operators.metrics import ROUND, ranking_metrics
from riskframe.operators.score import decide
from riskframe.plans.materialize import cut
from riskframe.plans.prefix import ordered_prefix


def base_scores(df: DataFrame, scorers: Sequence[tuple[str, Transformer]]) -> DataFrame:
    """One ``score_<name>`` column per base scorer, row-aligned (no join)."""
    out = df
    for name, scorer in scorers:
        out = scorer.transform(out).withColumnRenamed("score", f"score_{name}")
    return out


def weight_grid(n_models: int, n_steps: int = 21) -> list[list[float]]:
    """Fixed values, the grid of the reference: 2 models ``w0 in linspace(0,1,n)``; 3 models ``w1 in
    linspace(0, 1-w0, n)`` (n^2 points); otherwise one equal-weight point."""
    if n_models == 2:
        return [[float(w0), float(1.0 - w0)] for w0 in np.linspace(0, 1, n_steps)]
    if n_models == 3:
        grid = []
        for w0 in np.linspace(0, 1, n_steps):
            for w1 in np.linspace(0, 1 - w0, n_steps):
                grid.append([float(w0), float(w1), float(1 - w0 - w1)])
        return grid
    return [[1.0 / n_models] * n_models]


def blend_grid_ap(df: DataFrame, score_cols: Sequence[str], label_col: str = "Class",
                  n_steps: int = 21, travel: int = TRAVEL_TUPLES) -> DataFrame:
    """E5 table: ``(weight_id, w0.., pr_auc)`` for every grid point (``grid_best`` finds the best alone).

    Up to ``travel`` distinct score tuples travel to the tasks, which share the points; more of them stay
    where they are, and the table is exploded by grid point."""
    grid = weight_grid(len(score_cols), n_steps)
    points = list(dict.fromkeys(map(tuple, grid)))  # the grid repeats some points (w0 = 1)
    point_of = {p: i for i, p in enumerate(points)}
    tuples = score_tuples(df, score_cols, label_col)
    n_tuples = tuples.count()
    if n_tuples <= travel:
        ap = grid_ap_of_few_tuples(tuples, np.array(points)).select(F.col("point").alias("_point"), F.round("ap", ROUND).alias("pr_auc"))
    else:
        ap = _exploded_grid_ap(tuples, points, n_tuples)
    schema = ", ".join(["weight_id INT", "_point INT"] + [f"w{j} DOUBLE" for j in range(len(score_cols))])
    wdf = df.sparkSession.createDataFrame([(i, point_of[tuple(ws)], *ws) for i, ws in enumerate(grid)], schema)
    return wdf.join(F.broadcast(ap), "_point", "left").drop("_point")  # one row per grid point (<= n_steps^2)


def _exploded_grid_ap(tuples: DataFrame, points: Sequence[Sequence[float]], n_tuples: int) -> DataFrame:
    """``(_point, pr_auc)`` by the prefix plan keyed by grid point; rows per point are at most the tuples."""
    spark = tuples.sparkSession
    # the explode multiplies every tuple by the grid size: AQE would coalesce a small table
    # into one partition and run the whole expansion in one task
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ex = tuples.repartition(width).select("*", F.explode(F.sequence(F.lit(0), F.lit(len(points) - 1))).alias("_point"))
    blended = None
    for j in range(len(points[0])):
        term = F.element_at(F.lit([ws[j] for ws in points]), F.col("_point") + 1) * F.col(f"s{j}")
        blended = term if blended is None else blended + term
    per = ex.groupBy("_point", blended.alias("score")).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
    curve = ordered_prefix(per, ["_point"], "score", ["tp", "fp"], descending=True, with_totals=True,
                           size_bound=(n_tuples, len(points)))
    return ranking_metrics(curve, ["_point"]).select("_point", "pr_auc")


def blend_score(df: DataFrame, score_cols: Sequence[str], weights: Sequence[float], out_col: str = "score") -> DataFrame:
    """``sum w_i p_i`` as one column expression."""
    expr = None
    for w, c in zip(weights, score_cols):
        t = F.lit(float(w)) * F.col(c)
        expr = t if expr is None else expr + t
    return df.withColumn(out_col, expr)


class BlendingEnsemble:
    """E5-E7 with the reference's interface: fit on val, then predict_proba / predict."""

    def __init__(self, score_cols: Sequence[str]):
        self.score_cols = list(score_cols)
        self.weights_: list[float] | None = None
        self.val_ap_: float | None = None

    def fit(self, val_df: DataFrame, label_col: str = "Class", n_steps: int = 21) -> "BlendingEnsemble":
        if len(self.score_cols) in (2, 3):
            best = grid_best(val_df, self.score_cols, weight_grid(len(self.score_cols), n_steps), label_col)
            self.weights_, self.val_ap_ = best.weights, best.ap
        else:
            self.weights_, self.val_ap_ = weight_grid(len(self.score_cols))[0], -1.0
        return self

    def predict_proba(self, df: DataFrame, out_col: str = "score") -> DataFrame:
        if self.weights_ is None:
            raise RuntimeError("blend: not fitted")
        return blend_score(df, self.score_cols, self.weights_, out_col)

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return decide(self.predict_proba(df), threshold)


class StackingEnsemble:
    """Logistic meta-learner over base scores, balanced class weights.

    ``oof=False`` reproduces the reference (base scores are in-sample predictions of
    already-fitted models); ``oof=True`` refits each base estimator per fold (T4)
    and scores the held-out fold, the textbook out-of-fold stack.
    regParam = 1/n matches C = 1 with balanced weights (their sum is n).
    """

    def __init__(self, score_cols: Sequence[str], max_iter: int = 1000):
        self.score_cols = list(score_cols)
        self.max_iter = max_iter
        self.model_ = None

    @staticmethod
    def balanced_weight(df: DataFrame, label_col: str) -> tuple[F.Column, int]:
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label_col).cast("long")).alias("p")).first()
        n, p = int(row["n"]), int(row["p"] or 0)
        if p == 0 or p == n:
            raise ValueError("stacking needs both classes")
        w = F.when(F.col(label_col) == 1, F.lit(n / (2.0 * p))).otherwise(F.lit(n / (2.0 * (n - p))))
        return w, n

    def fit(self, df: DataFrame, label_col: str = "Class") -> "StackingEnsemble":
        w, n = self.balanced_weight(df, label_col)
        data = VectorAssembler(inputCols=self.score_cols, outputCol="_meta_x").transform(
            df.select(*self.score_cols, label_col).withColumn("_w", w)
        ).withColumn("_y", F.col(label_col).cast("double"))
        lr = LogisticRegression(featuresCol="_meta_x", labelCol="_y", weightCol="_w", regParam=1.0 / n,
                                elasticNetParam=0.0, standardization=False, maxIter=self.max_iter, tol=1e-10)
        self.model_ = lr.fit(data)
        return self

    @property
    def base_weights_(self) -> dict[str, float]:
        """Meta coefficient per base score column."""
        if self.model_ is None:
            raise RuntimeError("stack: not fitted")
        return dict(zip(self.score_cols, self.model_.coefficients.toArray().tolist()))

    def predict_proba(self, df: DataFrame, out_col: str = "score") -> DataFrame:
        if self.model_ is None:
            raise RuntimeError("stack: not fitted")
        x = VectorAssembler(inputCols=self.score_cols, outputCol="_meta_x").transform(df)
        out = self.model_.transform(x).withColumn(out_col, vector_to_array(F.col("probability"))[1])
        return out.drop("_meta_x", "rawPrediction", "probability", "prediction")

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return decide(self.predict_proba(df), threshold)


def oof_base_scores(train_df: DataFrame, fit_fns: Sequence[tuple[str, object]], k: int = 5,
                    id_col: str = "txn_id", label_col: str = "Class", seed: int = 42) -> DataFrame:
    """E2 ``oof=True``: per fold f of the train rows (T4 hash folds), fit each base
    learner on the other folds and score fold f. ``fit_fns`` maps a name to a
    function ``(train_frame) -> scorer``. Returns the train rows with ``score_<name>``.

    The rows are scored in one scan: every fold's model is part of the plan, and a row takes the score
    of its own fold's (``route_by_fold``).
    """
    from riskframe.operators.split import kfold_assign

    # every fold is read by the fits on the others, and all of them by the scoring
    folded = cut(kfold_assign(train_df, k=k, id_col=id_col, target_col=label_col, seed=seed), "folds")
    scorers = [(name, [fit(folded.where(F.col("fold") != f)) for f in range(k)]) for name, fit in fit_fns]
    return route_by_fold(folded, scorers).drop("fold")


def route_by_fold(folded: DataFrame, scorers: Sequence[tuple[str, Sequence]]) -> DataFrame:
    """``score_<name>`` of each row from the scorer that its ``fold`` (from 0) names, without splitting
    the rows by fold: a CASE on the fold, whose other branches are not evaluated for the row."""
    out = folded
    for name, by_fold in scorers:
        kept = [*out.columns, *(f"_s{f}" for f in range(len(by_fold)))]
        for f, scorer in enumerate(by_fold):
            out = scorer.transform(out).withColumnRenamed("score", f"_s{f}")
        score = F.lit(None).cast("double")
        for f in range(len(by_fold)):
            score = F.when(F.col("fold") == f, F.col(f"_s{f}")).otherwise(score)
        out = out.select(*(c for c in kept if not c.startswith("_s")), score.alias(f"score_{name}"))
    return out
