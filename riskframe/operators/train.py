"""Class-weighted MLlib learners, budgeted search, train-and-evaluate.

The reference's three boosting libraries are re-aimed at MLlib (different
algorithms: compare behaviour, never published numbers):

* ``gbt``     GBTClassifier, positives weighted ``n_neg / n_pos``            (slot 1)
* ``gbt_sub`` GBTClassifier with per-node feature subsampling, same weights    (slot 2)
* ``rf``      RandomForestClassifier with balanced weights ``n / (2 n_c)``     (slot 3)

Early stopping (L5): boosting stops when ``patience`` rounds bring no better average precision on
the validation rows, and keeps the trees up to the best round (``early_stop``). With ``patience=0``
MLlib's own rule holds, ``validationIndicatorCol`` with an explicit tolerance.

The search (L6) is a seeded random search bounded by a trial count and a wall-clock budget. Trials
are Spark jobs that run side by side over one table of assembled vectors; with several rungs
(successive halving) all trials get few rounds first, and only the best ``1 / eta`` of each rung
get ``eta`` times as many, the last the full number.
"""

from __future__ import annotations

import json
import math
import random
import time
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool
from typing import Sequence

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import metrics as M
from riskframe.operators.early_stop import fit_with_patience
from riskframe.operators.score import ProbabilityScorer

# Search ranges of the reference, as far as MLlib has the parameter
# (learning rate 0.01-0.3 log; depth 3-10; min child weight 1-10 / min child samples
# 5-100 / min data in leaf 1-50; subsample 0.5-1; column sample 0.5-1; gamma 1e-8-5 log;
# min split gain 1e-8-1 log; border count 32-255). The second slot's depth goes to 12.
SEARCH_SPACES = {
    "gbt": {
        "stepSize": ("log", 0.01, 0.3), "maxDepth": ("int", 3, 10), "minInstancesPerNode": ("int", 1, 10),
        "subsamplingRate": ("float", 0.5, 1.0), "featureSubsetStrategy": ("frac", 0.5, 1.0), "minInfoGain": ("log", 1e-8, 5.0),
    },
    "gbt_sub": {
        "stepSize": ("log", 0.01, 0.3), "maxDepth": ("int", 3, 12), "minInstancesPerNode": ("int", 5, 100),
        "subsamplingRate": ("float", 0.5, 1.0), "featureSubsetStrategy": ("frac", 0.5, 1.0),
        "minInfoGain": ("log", 1e-8, 1.0),
    },
    "rf": {
        "maxDepth": ("int", 3, 10), "minInstancesPerNode": ("int", 1, 50), "maxBins": ("int", 32, 255),
    },
}
# Rounds / early stopping / budget of the reference's configuration
ROUNDS = 1000
TRIALS = 50
TIMEOUT_S = 600
PATIENCE = 50
# ours: trials at a time, rungs of the search and the share of a rung that goes on
PARALLEL, RUNGS, ETA = 4, 3, 3
VALIDATION_TOL = 1e-4


@dataclass
class TrainConfig:
    feature_cols: Sequence[str]
    label_col: str = "Class"
    max_iter: int = ROUNDS
    seed: int = 42
    fixed: dict = field(default_factory=dict)
    patience: int = PATIENCE


def build_model(model_type: str, params: dict | None = None, seed: int = 42, max_iter: int = ROUNDS,
                validation_col: str | None = None):
    """Estimator factory; unknown type raises ``ValueError``."""
    params = dict(params or {})
    common = dict(featuresCol="features", labelCol="label", weightCol="weight", seed=seed)
    if model_type in ("gbt", "gbt_sub"):
        kw = dict(common, maxIter=max_iter, maxBins=64 if model_type == "gbt_sub" else 32)
        if validation_col:
            kw.update(validationIndicatorCol=validation_col, validationTol=VALIDATION_TOL)
        if model_type == "gbt_sub":
            kw["featureSubsetStrategy"] = "sqrt"
        kw.update(params)
        return GBTClassifier(**kw)
    if model_type == "rf":
        kw = dict(common, numTrees=max_iter)
        kw.update(params)
        return RandomForestClassifier(**kw)
    raise ValueError(f"Unknown model type: {model_type}")


def weight_column(df: DataFrame, model_type: str, label_col: str = "Class") -> F.Column:
    """L4: ``n_neg/n_pos`` on positives for the boosted slots; balanced for ``rf``."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label_col).cast("long")).alias("p")).first()
    n, p = int(row["n"]), int(row["p"] or 0)
    if p == 0:
        raise ValueError("class weight undefined: no positive rows")
    y = F.col(label_col) == 1
    if model_type == "rf":
        return F.when(y, F.lit(n / (2.0 * p))).otherwise(F.lit(n / (2.0 * (n - p))))
    return F.when(y, F.lit((n - p) / p)).otherwise(F.lit(1.0))


def assemble(df: DataFrame, feature_cols: Sequence[str], label_col: str = "Class") -> DataFrame:
    """Vector column only at the ML boundary; label as double."""
    va = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error")
    return va.transform(df).withColumn("label", F.col(label_col).cast("double"))


def sample_params(space: dict, rng: random.Random) -> dict:
    out = {}
    for k, (kind, lo, hi) in space.items():
        if kind == "log":
            out[k] = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
        elif kind == "int":
            out[k] = int(rng.randint(lo, hi))
        elif kind == "frac":
            out[k] = f"{rng.uniform(lo, hi):.3f}"
        else:
            out[k] = float(rng.uniform(lo, hi))
    return out


def vectors(model_type: str, split_df: DataFrame, cfg: TrainConfig) -> DataFrame:
    """``features, label, weight, is_val`` of the train and val rows, weighted for the slot."""
    w = weight_column(split_df.where(F.col("split") == "train"), model_type, cfg.label_col)
    rows = split_df.where(F.col("split").isin("train", "val")).withColumn("is_val", F.col("split") == "val").withColumn("weight", w)
    return assemble(rows, cfg.feature_cols, cfg.label_col).select("features", "label", "weight", "is_val")


def fit_vectors(model_type: str, params: dict, data: DataFrame, cfg: TrainConfig):
    """The model fitted on the ``vectors`` that are not val rows (boosting: val rows decide when it
    stops). A limit of rounds within the patience leaves nothing to wait for: MLlib's tolerance rule
    applies then."""
    train = data.where(~F.col("is_val"))
    own = {**cfg.fixed, **params}
    if model_type not in ("gbt", "gbt_sub"):
        return build_model(model_type, own, cfg.seed, cfg.max_iter).fit(train)
    if 0 < cfg.patience < cfg.max_iter:
        both = [part.drop("is_val") for part in (train, data.where("is_val"))]
        return fit_with_patience(lambda n: build_model(model_type, own, cfg.seed, n), *both, cfg.max_iter, cfg.patience).model
    return build_model(model_type, own, cfg.seed, cfg.max_iter, "is_val").fit(data)


def fit_score(model_type: str, params: dict, split_df: DataFrame, cfg: TrainConfig) -> ProbabilityScorer:
    """Fit on ``train`` and ``val`` rows (``fit_vectors``) and wrap as a scorer of raw columns."""
    model = fit_vectors(model_type, params, vectors(model_type, split_df, cfg), cfg)
    return ProbabilityScorer(FeaturesThen(model, cfg.feature_cols, cfg.label_col))


class FeaturesThen:
    """Assemble features, then the fitted model (keeps raw columns for the caller)."""

    def __init__(self, model, feature_cols, label_col):
        self.model, self.feature_cols, self.label_col = model, list(feature_cols), label_col

    def transform(self, df: DataFrame) -> DataFrame:
        va = VectorAssembler(inputCols=self.feature_cols, outputCol="features")
        return self.model.transform(va.transform(df)).drop("features")


def validation_ap(model, data: DataFrame) -> float:
    """Average precision of a fitted model on the val rows of ``vectors``; -1 where there is none."""
    scored = ProbabilityScorer(model).transform(data.where("is_val")).select("label", "score").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = scored.count()
        row = M.ranking_metrics(M.score_curve(scored, "label", "score", size_bound=(n, 1))).first()
    finally:
        scored.unpersist()
    return -1.0 if row is None or row["pr_auc"] is None else float(row["pr_auc"])


def ladder(max_iter: int, rungs: int, eta: int) -> list[int]:
    """Rounds of each rung, the full number last."""
    return sorted({max(1, max_iter // eta ** k) for k in range(rungs)})


def tune_model(model_type: str, split_df: DataFrame, cfg: TrainConfig, n_trials: int = TRIALS,
               timeout_s: float = TIMEOUT_S, parallelism: int = PARALLEL, rungs: int = RUNGS,
               eta: int = ETA) -> tuple[dict, DataFrame]:
    """Seeded random search maximising validation AP, ``parallelism`` trials at a time.

    All parameters are drawn before the first trial, and who goes on to the next rung is decided when
    a rung is over, so the result depends on the seed and not on which trial ends first. The best
    trial is the one with the highest AP of those on the highest rung; the first one wins ties. Once
    ``timeout_s`` is over no further trial begins (the very first always does). ``rungs=1`` gives
    every trial the full number of rounds. Returns ``(best_params, trials)``, one row per
    finished trial: ``rounds`` is what it got last and ``val_pr_auc`` what it reached with them.
    """
    if model_type not in SEARCH_SPACES:
        raise ValueError(f"Unknown model type: {model_type}")
    spark = split_df.sparkSession
    rng = random.Random(cfg.seed)
    start = time.monotonic()
    drawn = [sample_params(SEARCH_SPACES[model_type], rng) for _ in range(n_trials)]
    data = vectors(model_type, split_df, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    reached: dict[int, tuple[int, float]] = {}  # trial: rounds, AP

    def attempt(t: int, rounds: int) -> tuple[int, float] | None:
        if time.monotonic() - start > timeout_s and (t or reached):
            return None
        model = fit_vectors(model_type, drawn[t], data, replace(cfg, max_iter=rounds))
        return rounds, validation_ap(model, data)

    alive = list(range(n_trials))
    try:
        with ThreadPool(max(1, parallelism)) as pool:
            for rounds in ladder(cfg.max_iter, rungs, eta):
                # one wrapped function a trial: each carries its own copy of the local properties
                jobs = [pool.apply_async(inheritable_thread_target(spark)(attempt), (t, rounds)) for t in alive]
                results = [j.get() for j in jobs]
                finished = {t: r for t, r in zip(alive, results) if r is not None}
                reached.update(finished)
                alive = sorted(finished, key=lambda t: (-finished[t][1], t))[: math.ceil(len(finished) / eta)]
                alive.sort()
    finally:
        data.unpersist()
    best = min(reached, key=lambda t: (-reached[t][0], -reached[t][1], t), default=None)
    rows = [(t, model_type, json.dumps(drawn[t], sort_keys=True), *reached[t]) for t in sorted(reached)]
    trials = spark.createDataFrame(rows, "trial INT, model_type STRING, params STRING, rounds INT, val_pr_auc DOUBLE")
    return {**cfg.fixed, **(drawn[best] if best is not None else {})}, trials


def train_and_evaluate(model_type: str, params: dict, split_df: DataFrame, cfg: TrainConfig,
                       threshold_source: str = "val") -> tuple[ProbabilityScorer, DataFrame]:
    """Fit, tune the F1 threshold on ``threshold_source``, metrics on val and test
    at the tuned threshold and at 0.5. One row per (split, threshold kind)."""
    scorer = fit_score(model_type, params, split_df, cfg)
    scored = scorer.transform(split_df.where(F.col("split").isin("val", "test")))
    t_row = M.best_threshold_by_bounds(scored.where(F.col("split") == threshold_source), cfg.label_col, "score").first()
    tuned = float(t_row["best_threshold"]) if t_row and t_row["best_threshold"] is not None else 0.5
    parts = []
    for kind, t in (("tuned", tuned), ("default", 0.5)):
        ev = M.evaluate(scored, cfg.label_col, "score", t, keys=["split"])
        parts.append(ev.withColumn("threshold_kind", F.lit(kind)))
    out = parts[0].unionByName(parts[1]).withColumn("model_name", F.lit(model_type))
    return scorer, out
