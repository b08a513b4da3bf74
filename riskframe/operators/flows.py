"""The reference's end-to-end runs, composed from the operators.

Each is a driver function that issues DataFrame/MLlib jobs; nothing passes through
the driver except per-model metrics rows and fitted parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import drift as D
from riskframe.operators import metrics as M
from riskframe.operators.ensemble import BlendingEnsemble, StackingEnsemble
from riskframe.operators.features import fit_and_transform
from riskframe.operators.split import assign_split
from riskframe.operators.train import ROUNDS, TrainConfig, train_and_evaluate, tune_model
from riskframe.plans.materialize import cut, keep
from riskframe.sources.io import save_ensemble, save_pipeline, save_results, save_scorer

KEEP = ("txn_id", "Class", "split")


@dataclass
class TrainingRun:
    feature_model: object
    features: DataFrame
    feature_cols: list
    scorers: dict = field(default_factory=dict)
    params: dict = field(default_factory=dict)
    metrics: DataFrame | None = None

    def leaderboard(self, split: str = "test", threshold_kind: str = "tuned") -> DataFrame:
        m = self.metrics.where((F.col("split") == split) & (F.col("threshold_kind") == threshold_kind))
        return M.leaderboard(m.select("model_name", "pr_auc", "roc_auc", "f1", "precision", "recall"))


def run_full_training(df: DataFrame, model_types: Sequence[str] = ("gbt", "gbt_sub", "rf"), n_trials: int = 50,
                      timeout_s: float = 600, max_iter: int = ROUNDS, seed: int = 42, pipeline=None,
                      run_log=None, results_path: str | None = None, model_path: str | None = None) -> TrainingRun:
    """Split -> features fitted on train -> per model: search, fit, tuned threshold,
    metrics on val and test -> leaderboards. ``model_path`` keeps the fitted feature
    pipeline and every scorer, ``results_path`` the metrics (S6); ``run_log`` (S8) gets the
    parameters, validation metrics at the tuned threshold and at 0.5, and test metrics."""
    split = keep(assign_split(df, seed=seed))
    fmodel, feats = fit_and_transform(split, pipeline)
    # dozens of fits and scorings read this table: write it once to the shared
    # checkpoint folder so lost executors and long lineages never replay the split
    feats = cut(feats, "training-features")
    cols = [c for c in feats.columns if c not in KEEP]
    cfg = TrainConfig(feature_cols=cols, max_iter=max_iter, seed=seed)
    run = TrainingRun(fmodel, feats, cols)
    parts = []
    for mt in model_types:
        best, _trials = tune_model(mt, feats, cfg, n_trials, timeout_s)
        scorer, metrics = train_and_evaluate(mt, best, feats, cfg)
        run.scorers[mt], run.params[mt] = scorer, best
        parts.append(metrics)
        if run_log is not None:
            run_log.log(mt, best, _logged(metrics))
        if model_path is not None:
            save_scorer(scorer, f"{model_path}/{mt}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    run.metrics = out
    if model_path is not None:
        save_pipeline(fmodel, f"{model_path}/features")
    if results_path:
        save_results(out, results_path)
    return run


MEASURES = ("pr_auc", "roc_auc", "f1", "precision", "recall")


def _logged(metrics: DataFrame) -> dict:
    """The run-log metrics of one model: a row per split and kind of threshold becomes keys."""
    out = {}
    for r in metrics.collect():  # at most four rows
        tail = "" if r["threshold_kind"] == "tuned" else "_at_default"
        out.update({f"{r['split']}_{k}{tail}": r[k] for k in (*MEASURES, "threshold")})
    return out


def tuned_metrics(scored: DataFrame, score_cols: Sequence[str], label_col: str = "Class") -> DataFrame:
    """Per score column: its F1-optimal threshold on the val rows, and its metrics on the test
    rows at that threshold (``optimal_threshold``); one row per model, NULL threshold: 0.5."""
    pairs = ", ".join(f"'{c[6:]}', {c}" for c in score_cols)
    long = scored.select("split", label_col, F.expr(f"stack({len(score_cols)}, {pairs}) AS (model_name, score)"))
    best = M.best_threshold_by_bounds(long.where("split = 'val'"), label_col, "score", ["model_name"])
    found = {r["model_name"]: r["best_threshold"] for r in best.collect()}  # one row per model
    test, parts = long.where("split = 'test'"), []
    for c in score_cols:
        t = found.get(c[6:])
        t = 0.5 if t is None else float(t)
        ev = M.evaluate(test.where(F.col("model_name") == c[6:]), label_col, "score", t, keys=["model_name"])
        parts.append(ev.select("model_name", *MEASURES, F.lit(t).alias("optimal_threshold")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return M.leaderboard(out)


def run_ensemble(run: TrainingRun, label_col: str = "Class", run_log=None, model_path: str | None = None) -> DataFrame:
    """The base models, a stack (fitted on train) and a blend (fitted on val), all
    evaluated on test at their own thresholds tuned on val; leaderboard by PR-AUC."""
    names = list(run.scorers)
    scored = run.features
    for n in names:
        scored = run.scorers[n].transform(scored).withColumnRenamed("score", f"score_{n}")
    scored = keep(scored)
    cols = [f"score_{n}" for n in names]
    stack = StackingEnsemble(cols).fit(scored.where(F.col("split") == "train"), label_col)
    blend = BlendingEnsemble(cols).fit(scored.where(F.col("split") == "val"), label_col)
    both = blend.predict_proba(stack.predict_proba(scored.where("split IN ('val', 'test')"), "score_stacking"), "score_blending")
    board = tuned_metrics(both, cols + ["score_stacking", "score_blending"], label_col)
    if model_path is not None:
        save_ensemble(stack, f"{model_path}/stack")
        save_ensemble(blend, f"{model_path}/blend")
    if run_log is not None:
        for r in board.where(F.col("model_name").isin("stacking", "blending")).collect():
            run_log.log(r["model_name"], {"score_cols": ",".join(cols)}, {f"test_{k}": r[k] for k in (*MEASURES, "optimal_threshold")})
    return board


def monitoring_flow(features: DataFrame, shift_features: Sequence[str] = ("V14", "V17"), magnitude: float = 2.0,
                    target_col: str = "Class", seed: int = 42) -> DataFrame:
    """Train vs test on engineered features, then test with ``shift_features``
    moved by ``magnitude`` standard deviations; one summary row per stage."""
    cols = [c for c in features.columns if c not in KEEP]
    train = features.where(F.col("split") == "train")
    test = features.where(F.col("split") == "test")
    s1, _ = D.detect_data_drift(train, test, target_col=target_col, numerical_features=cols)
    shifted = D.simulate_drift(test, "mean_shift", magnitude, list(shift_features), seed)
    s2, _ = D.detect_data_drift(train, shifted, target_col=target_col, numerical_features=cols)
    return s1.withColumn("stage", F.lit("baseline")).unionByName(s2.withColumn("stage", F.lit("shifted")))
