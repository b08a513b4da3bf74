"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through the adapter views and runs over the
whole tables. Deterministic queries have a DuckDB twin in ``riskframe.oracle``
with the same column names; doubles are rounded (6 places, features 9) on both
sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import cyclical_hour
from riskframe.operators import drift as D
from riskframe.operators import metrics as M
from riskframe.operators import profile as A
from riskframe.operators.ensemble import BlendingEnsemble, blend_grid_ap
from riskframe.operators.features import AmountScaler, Interactions, TimeCyclical, build_feature_pipeline
from riskframe.operators.score import HeuristicScorer, score_batch
from riskframe.operators.split import assign_split, kfold_assign, split_summary
from riskframe.operators.validate import quarantine_report, validate
from riskframe.plans.materialize import keep
from riskframe.sources import tables as T

# Fixed parameters of the registered queries
SEED = 42
METRIC_THRESHOLD = 0.5
HEURISTIC_THRESHOLD = 0.1
SCORE_THRESHOLD = 0.2
FEATURE_DIGITS = 9
LINE_NUMERIC = ["Time", "Quantity", "Amount", "Discount", "Tax"]
LINE_CATEGORICAL = ["ReturnFlag", "LineStatus"]
HIST_BINS = 100
HIST_LOG_BINS = 50
HIST_CLASS_BINS = {"Time": 100, "log_amount": 80, "Quantity": 80, "Discount": 80, "Tax": 80}
EVENT_SCORES = ["s_amount", "s_hour", "s_minute"]


def _round(df: DataFrame, cols, digits: int = FEATURE_DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def _lines_split(spark, d):
    return keep(assign_split(T.txn_lines(spark, d)))


def _events_split(spark, d):
    return keep(assign_split(T.txn_events(spark, d)))


def _txn_split(spark, d):
    return keep(assign_split(T.txn(spark, d)))


def event_scores(df: DataFrame) -> DataFrame:
    """Three deterministic stand-in base scores on ``txn_events`` (for the ensembles)."""
    s, _c = cyclical_hour("Time")
    return df.withColumns({
        "s_amount": F.col("score"),
        "s_hour": F.round((F.lit(1.0) + s) / F.lit(2.0), 3),
        "s_minute": F.round(F.pmod(F.col("Time"), F.lit(3600.0)) / F.lit(3600.0), 3),
    })


# ---------------------------------------------------------------- P: projections / validation

def p_validate_quarantine(spark, d):
    """P7 on line items whose Amount was blanked (D7) and Discount shifted down by 1 sd."""
    df = T.txn_lines(spark, d)
    df = D.simulate_drift(df, "missing", 0.05, ["Amount"], SEED)
    df = D.simulate_drift(df, "mean_shift", -1.0, ["Discount"], SEED)
    valid, quarantine = validate(df, required=LINE_NUMERIC, non_negative=["Amount", "Discount"])
    rep = quarantine_report(quarantine)
    ok = valid.agg(F.lit("valid").alias("reason"), F.count(F.lit(1)).alias("rows"))
    return rep.unionByName(ok).withColumn("rows", F.col("rows").cast("long"))


def p_head(spark, d):
    """First rows in id order (Spark has no file order); the limit is the feature."""
    return _lines(spark, d).orderBy("txn_id").limit(5)


def p_class_filter(spark, d):
    """The positive class, projected (filter and projection reach the scan)."""
    return _lines(spark, d).where(F.col("Class") == 1).select("txn_id", "Amount", "Quantity")


def p_numeric_select(spark, d):
    df = T.txn_lines(spark, d)
    cols = A.numeric_columns(df, exclude=("Class",))
    return df.select("txn_id", *cols)


# ---------------------------------------------------------------- T: splits

def t_split_assign(spark, d):
    return assign_split(T.txn_lines(spark, d)).select("txn_id", "Class", "split")


def t_split_summary(spark, d):
    return split_summary(assign_split(T.txn_lines(spark, d)))


def t_split_unstratified(spark, d):
    return assign_split(T.txn_events(spark, d), stratify=False).select("txn_id", "Class", "split")


def t_kfold_assign(spark, d):
    return kfold_assign(T.txn_events(spark, d), k=5).select("txn_id", "Class", "fold")


# ---------------------------------------------------------------- F: features

def f_time_cyclical(spark, d):
    out = TimeCyclical().transform(T.txn_events(spark, d))
    return _round(out.select("txn_id", "hour_sin", "hour_cos"), ["hour_sin", "hour_cos"])


def f_amount_log(spark, d):
    m = AmountScaler(standardize=False).fit(T.txn_events(spark, d))
    out = m.transform(T.txn_events(spark, d))
    return _round(out.select("txn_id", "Amount"), ["Amount"])


def f_amount_standardized(spark, d):
    df = _events_split(spark, d)
    m = AmountScaler().fit(df.where(F.col("split") == "train"))
    return _round(m.transform(df).select("txn_id", "split", "Amount"), ["Amount"])


def f_interactions(spark, d):
    out = Interactions().transform(T.txn(spark, d))
    cols = [f"{a}_x_{b}" for a, b in [["V14", "V17"], ["V12", "V14"], ["V10", "V17"], ["V4", "V11"]]]
    return _round(out.select("txn_id", *cols), cols)


def full_features(spark, d) -> DataFrame:
    df = _txn_split(spark, d)
    model = build_feature_pipeline().fit(df.where(F.col("split") == "train"))
    return model.transform(df)


def f_full_features(spark, d):
    out = full_features(spark, d)
    feats = [c for c in out.columns if c not in ("txn_id", "Class", "split")]
    return _round(out, feats)


# ---------------------------------------------------------------- A: profile

def _lines(spark, d):
    return T.txn_lines(spark, d)


def a_shape(spark, d):
    return A.shape(_lines(spark, d))


def a_describe(spark, d):
    return A.describe(_lines(spark, d), LINE_NUMERIC)


def a_missing(spark, d):
    return A.missing(_lines(spark, d))


def _dup_cols(df):
    return [c for c in df.columns if c != "txn_id"]


def a_duplicates(spark, d):
    df = _lines(spark, d).drop("Time")
    return A.duplicates(df, _dup_cols(df))


def a_duplicates_by_class(spark, d):
    df = _lines(spark, d).drop("Time")
    return A.duplicates_by_class(df, _dup_cols(df))


def a_class_balance(spark, d):
    return A.class_balance(_lines(spark, d))


def a_imbalance_ratio(spark, d):
    return A.imbalance_ratio(_lines(spark, d))


def a_time_range(spark, d):
    return A.time_range(_lines(spark, d))


def a_amount_by_class(spark, d):
    return A.amount_by_class(_lines(spark, d))


def a_hist(spark, d):
    return A.histogram(A.long_form(_lines(spark, d), ["Time"]), HIST_BINS)


def a_hist_log_amount(spark, d):
    df = _lines(spark, d).withColumn("log_amount", F.log1p("Amount"))
    return A.histogram(A.long_form(df, ["log_amount"]), HIST_LOG_BINS)


def a_hist_by_class(spark, d):
    df = _lines(spark, d).withColumn("log_amount", F.log1p("Amount"))
    lf = A.long_form(df, list(HIST_CLASS_BINS), ["Class"])
    return A.histogram(lf, HIST_CLASS_BINS, keys=["feature", "Class"])


def a_corr_target(spark, d):
    return A.corr_with_target(_lines(spark, d), LINE_NUMERIC)


def a_corr_top15(spark, d):
    return A.corr_top(_lines(spark, d), LINE_NUMERIC, k=15)


def a_corr_matrix(spark, d):
    return A.corr_matrix(_lines(spark, d), LINE_NUMERIC + ["Class"])


def a_iqr_outliers(spark, d):
    return A.iqr_outliers(T.txn(spark, d), T.TXN_FEATURES, k=10.0)


def a_class_comparison(spark, d):
    return A.class_comparison(_lines(spark, d), LINE_NUMERIC)


# ---------------------------------------------------------------- M: metrics (txn_events, per split)

def m_confusion(spark, d):
    return M.confusion(assign_split(T.txn_events(spark, d)), threshold=METRIC_THRESHOLD, keys=["split"])


def m_threshold_metrics(spark, d):
    return M.threshold_metrics(assign_split(T.txn_events(spark, d)), threshold=METRIC_THRESHOLD, keys=["split"])


def _event_curve(spark, d):
    return M.score_curve(assign_split(T.txn_events(spark, d)), keys=["split"])


def m_average_precision(spark, d):
    return M.ranking_metrics(_event_curve(spark, d), ["split"]).select("split", "pr_auc")


def m_roc_auc(spark, d):
    return M.ranking_metrics(_event_curve(spark, d), ["split"]).select("split", "roc_auc")


def m_pr_curve(spark, d):
    return M.pr_curve(_event_curve(spark, d), ["split"])


def m_best_threshold(spark, d):
    return M.best_threshold_by_bounds(assign_split(T.txn_events(spark, d)), keys=["split"])


def m_class_weight(spark, d):
    return M.class_weight(_lines(spark, d))


def heuristic_long(df: DataFrame) -> DataFrame:
    """(model_name, txn_id, Class, score) for the three heuristic scorers, stacked."""
    parts = []
    for name in ["r3", "r3_b", "r3_c"]:
        s = HeuristicScorer(variant=name).transform(df)
        parts.append(s.select(F.lit(name).alias("model_name"), "txn_id", "Class", "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def m_leaderboard(spark, d):
    test = _txn_split(spark, d).where(F.col("split") == "test")
    ev = M.evaluate(heuristic_long(test), threshold=HEURISTIC_THRESHOLD, keys=["model_name"])
    return M.leaderboard(ev.select("model_name", "pr_auc", "roc_auc", "f1", "precision", "recall"))


# ---------------------------------------------------------------- R: scoring

def r_score_batch(spark, d):
    scored, _q = score_batch(T.txn(spark, d), HeuristicScorer(), threshold=SCORE_THRESHOLD,
                             model_name="heuristic", model_version="0.1.0")
    return scored


# ---------------------------------------------------------------- D: drift (txn_lines train vs test)

def _ref_cur(spark, d):
    df = _lines_split(spark, d)
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "test")


def d_ks(spark, d):
    r, c = _ref_cur(spark, d)
    return D.ks_test(r, c, LINE_NUMERIC).select("feature", "ks_d", "p_value", "drift")


def d_wasserstein(spark, d):
    r, c = _ref_cur(spark, d)
    return D.numeric_drift(r, c, LINE_NUMERIC).select("feature", "w1", "w1_norm")


def d_psi(spark, d):
    r, c = _ref_cur(spark, d)
    return D.psi(r, c, LINE_NUMERIC)


def d_chi_square(spark, d):
    r, c = _ref_cur(spark, d)
    return D.chi_square(r, c, LINE_CATEGORICAL)


def d_chi_square_p(spark, d):
    """Upper tail of the chi-square statistic."""
    r, c = _ref_cur(spark, d)
    return D.chi_square_test(r, c, LINE_CATEGORICAL).select("feature", "dof", F.round("p", 9).alias("p_value"))


def d_js(spark, d):
    """Jensen-Shannon distance of every feature."""
    r, c = _ref_cur(spark, d)
    return D.js_distance(r, c, LINE_NUMERIC).unionByName(D.js_of_categories(r, c, LINE_CATEGORICAL))


def _summary_flat(summary: DataFrame) -> DataFrame:
    return summary.withColumn("drifted_features", F.array_join("drifted_features", ","))


def d_summary(spark, d):
    r, c = _ref_cur(spark, d)
    summary, _detail = D.detect_data_drift(r, c, target_col="Class", numerical_features=LINE_NUMERIC,
                                           categorical_features=LINE_CATEGORICAL)
    return _summary_flat(summary)


# Perturbed amounts reach 1e5 and the noise goes through log/cos (an ulp apart between
# the JVM and C libraries) times 0.2 sd (~1e4): 4 decimals keep the output within the
# digits both engines agree on.
PERTURB_DIGITS = 4


def _perturbed(spark, d, kind, magnitude):
    df = _lines(spark, d)
    out = D.simulate_drift(df, kind, magnitude, ["Quantity", "Amount"], SEED)
    return out.select("txn_id", F.round("Quantity", PERTURB_DIGITS).alias("Quantity"),
                      F.round("Amount", PERTURB_DIGITS).alias("Amount"))


def d_mean_shift(spark, d):
    return _perturbed(spark, d, "mean_shift", 1.0)


def d_scale_change(spark, d):
    return _perturbed(spark, d, "scale_change", 0.5)


def d_corruption(spark, d):
    return _perturbed(spark, d, "corruption", 0.2)


def d_missing(spark, d):
    return _perturbed(spark, d, "missing", 0.3)


def d_monitor_flow(spark, d):
    """Train vs test on engineered features, then with V14 and V17 shifted by 2 sd."""
    from riskframe.operators.flows import monitoring_flow

    return _summary_flat(monitoring_flow(full_features(spark, d), ("V14", "V17"), 2.0, seed=SEED))


# ---------------------------------------------------------------- E: blending (txn_events)

def _event_val(spark, d):
    return event_scores(_events_split(spark, d)).where(F.col("split") == "val")


def e_blend_grid2(spark, d):
    g = blend_grid_ap(_event_val(spark, d), EVENT_SCORES[:2])
    return g.withColumns({c: F.round(c, 6) for c in ["w0", "w1"]})


def e_blend_grid3(spark, d):
    g = blend_grid_ap(_event_val(spark, d), EVENT_SCORES)
    return g.withColumns({c: F.round(c, 6) for c in ["w0", "w1", "w2"]})


def e_blend_score(spark, d):
    df = event_scores(_events_split(spark, d))
    ens = BlendingEnsemble(EVENT_SCORES).fit(df.where(F.col("split") == "val"))
    test = ens.predict_proba(df.where(F.col("split") == "test"))
    return test.select("txn_id", F.round("score", FEATURE_DIGITS).alias("score"))


# ---------------------------------------------------------------- sources, projections and checks that are plain rows

def p_separate_target(spark, d):
    """Features and target of each split as separate frames, counted."""
    from riskframe.operators.split import split_frames

    out = None
    for s, (x, y) in split_frames(assign_split(T.txn_lines(spark, d))).items():
        row = x.agg(F.lit(s).alias("split"), F.lit(len(x.columns)).alias("n_columns"), F.count(F.lit(1)).alias("rows")).join(
            y.agg(F.lit(s).alias("split"), F.sum("Class").cast("long").alias("positives")), "split")
        out = row if out is None else out.unionByName(row)
    return out


def p_drop_target(spark, d):
    """A drift test with default features leaves the target and the id out."""
    r, c = _ref_cur(spark, d)
    _summary, detail = D.detect_data_drift(r, c, target_col="Class")
    return detail.select("feature", "kind", "drift")


def s_csv_roundtrip(spark, d):
    """The 31-column table written as CSV and loaded with the declared schema."""
    from riskframe.session import scratch_path
    from riskframe.sources import io

    path = scratch_path(spark, "csv")
    T.txn(spark, d).select(*T.TXN_FEATURES, "Class").write.option("header", True).csv(path)
    return _round(io.load_transactions(spark, path).select("Time", "V1", "V28", "Amount", "Class"), ["V1", "V28"], 6)


def s_requests(spark, d):
    """S3 + R1: requests as NDJSON, read in training order, scored and counted by decision."""
    from riskframe.session import scratch_path
    from riskframe.sources import io

    path = scratch_path(spark, "requests")
    T.txn(spark, d).select(*T.TXN_FEATURES).write.json(path)
    req = io.read_requests(spark, path).withColumn("txn_id", F.lit(0))
    scored, _q = score_batch(req, HeuristicScorer(), threshold=SCORE_THRESHOLD, model_name="heuristic", model_version="0.1.0")
    return scored.groupBy("is_fraud", "fraud_probability").agg(F.count(F.lit(1)).alias("rows"))


def r_single_equals_batch(spark, d):
    """R2: every row scored in a batch of its own partition equals the batch score."""
    batch = HeuristicScorer().transform(T.txn(spark, d)).select("txn_id", "score")
    alone = HeuristicScorer().transform(T.txn(spark, d).repartition("txn_id")).select("txn_id", F.col("score").alias("alone"))
    same = batch.join(alone, "txn_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("score") == F.col("alone")).alias("equal"))
    return same


def e_predict(spark, d):
    """Decisions of the fitted blend on test."""
    df = event_scores(_events_split(spark, d))
    ens = BlendingEnsemble(EVENT_SCORES).fit(df.where(F.col("split") == "val"))
    return ens.predict(df.where(F.col("split") == "test"), 0.5).select("txn_id", "is_fraud")


def e_blend_saved(spark, d):
    """A blend saved and loaded scores test like the one that was fitted."""
    from riskframe.session import scratch_path
    from riskframe.sources import io

    df = event_scores(_events_split(spark, d))
    ens = BlendingEnsemble(EVENT_SCORES).fit(df.where(F.col("split") == "val"))
    again = io.load_ensemble(spark, io.save_ensemble(ens, scratch_path(spark, "blend")))
    test = again.predict_proba(df.where(F.col("split") == "test"))
    return test.select("txn_id", F.round("score", FEATURE_DIGITS).alias("score"))


def m_odd_scores(spark, d):
    """M1-M6 with scores that are NULL or NaN: such rows are in no metric."""
    df = T.txn_events(spark, d).withColumn("score", F.when(F.col("txn_id") % 7 == 0, F.lit(float("nan")))
                                           .when(F.col("txn_id") % 11 != 0, F.col("score")))
    return M.evaluate(df.withColumn("part", F.when(F.col("txn_id") % 2 == 0, "even")), threshold=METRIC_THRESHOLD, keys=["part"])


def a_iqr_outliers_chars(spark, d):
    """A16 where there are outliers: document lengths, 3 x IQR."""
    return A.iqr_outliers(spark.read.parquet(f"{d}/documents.parquet").select("n_chars"), ["n_chars"], k=3.0)


def a_corr_top15_wide(spark, d):
    """A14/O2 with more features than the limit: 30 columns, the top 15."""
    return A.corr_top(T.txn(spark, d), T.TXN_FEATURES, k=15)


def d_stream_ks_days(spark, d):
    """KS distance of two features per day of the stream, from merged sketches."""
    from riskframe.session import scratch_path
    from riskframe.streaming import windows as W
    from riskframe.streaming.scoring import file_stream, run_to_completion

    features = ["value", "user_id"]
    reference = W.reference_points(T.table(spark, d, "events"), features, points=64)
    out, ck = scratch_path(spark, "stream-windows"), scratch_path(spark, "stream-windows-ckpt")
    run_to_completion(W.start_windows(file_stream(spark, d, "events.parquet", _events_schema(spark, d)), "ts", features, out, ck))
    drift = W.drift_of_windows(W.windows(spark, out), reference)
    return drift.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "feature", "ks", "rows", "n", "closed")


def d_stream_psi_days(spark, d):
    """Every day of the stream: closed windows from the stream's output, those that the
    watermark has not passed from the same counts over the source."""
    from riskframe.session import scratch_path
    from riskframe.streaming import drift as SD
    from riskframe.streaming.scoring import file_stream, run_to_completion

    events = T.table(spark, d, "events")
    ref = T.txn_events(spark, d)
    lo, hi = SD.reference_edges(ref, "Amount")
    shares = SD.reference_shares(ref, "Amount", lo, hi)
    stream = file_stream(spark, d, "events.parquet", _events_schema(spark, d))
    out, ck = scratch_path(spark, "stream-psi"), scratch_path(spark, "stream-psi-ckpt")
    run_to_completion(SD.start_window_counts(stream, "ts", "value", lo, hi, out, ck))
    closed = spark.read.parquet(out)
    open_ = SD.window_counts(events, "ts", "value", lo, hi).join(closed.select("window_start").distinct(), "window_start", "left_anti")
    both = closed.withColumn("closed", F.lit(True)).unionByName(open_.withColumn("closed", F.lit(False)))
    psi = SD.psi_of_counts(both, shares)
    state = both.groupBy("window_start").agg(F.first("closed").alias("closed"))
    return psi.join(state, "window_start").select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), F.round("psi", 5).alias("psi"), "rows", "closed")


def s_run_log(spark, d):
    """Log params and metrics of a run to the append-only tables; return its metrics."""
    from riskframe.session import scratch_path
    from riskframe.sources.io import RunLog

    ev = M.evaluate(heuristic_long(_txn_split(spark, d).where(F.col("split") == "val")),
                    threshold=HEURISTIC_THRESHOLD, keys=["model_name"]).where(F.col("model_name") == "r3")
    log = RunLog(spark, scratch_path(spark, "runlog"))
    run_id = log.log("r3", {"threshold": HEURISTIC_THRESHOLD, "variant": "r3"}, ev.select("pr_auc", "roc_auc", "f1", "precision", "recall"))
    return log.table("run_metrics").where(F.col("run_id") == run_id).select("k", "v")


DETERMINISTIC = {
    "p_separate_target": p_separate_target,
    "p_drop_target": p_drop_target,
    "s_csv_roundtrip": s_csv_roundtrip,
    "s_requests": s_requests,
    "s_run_log": s_run_log,
    "r_single_equals_batch": r_single_equals_batch,
    "e_predict": e_predict,
    "e_blend_saved": e_blend_saved,
    "m_odd_scores": m_odd_scores,
    "a_iqr_outliers_chars": a_iqr_outliers_chars,
    "a_corr_top15_wide": a_corr_top15_wide,
    "d_stream_psi_days": d_stream_psi_days,
    "d_stream_ks_days": d_stream_ks_days,
    "p_validate_quarantine": p_validate_quarantine,
    "p_numeric_select": p_numeric_select,
    "p_head": p_head,
    "p_class_filter": p_class_filter,
    "t_split_assign": t_split_assign,
    "t_split_summary": t_split_summary,
    "t_split_unstratified": t_split_unstratified,
    "t_kfold_assign": t_kfold_assign,
    "f_time_cyclical": f_time_cyclical,
    "f_amount_log": f_amount_log,
    "f_amount_standardized": f_amount_standardized,
    "f_interactions": f_interactions,
    "f_full_features": f_full_features,
    "a_shape": a_shape,
    "a_describe": a_describe,
    "a_missing": a_missing,
    "a_duplicates": a_duplicates,
    "a_duplicates_by_class": a_duplicates_by_class,
    "a_class_balance": a_class_balance,
    "a_imbalance_ratio": a_imbalance_ratio,
    "a_time_range": a_time_range,
    "a_amount_by_class": a_amount_by_class,
    "a_hist": a_hist,
    "a_hist_log_amount": a_hist_log_amount,
    "a_hist_by_class": a_hist_by_class,
    "a_corr_target": a_corr_target,
    "a_corr_top15": a_corr_top15,
    "a_corr_matrix": a_corr_matrix,
    "a_iqr_outliers": a_iqr_outliers,
    "a_class_comparison": a_class_comparison,
    "m_confusion": m_confusion,
    "m_threshold_metrics": m_threshold_metrics,
    "m_average_precision": m_average_precision,
    "m_roc_auc": m_roc_auc,
    "m_pr_curve": m_pr_curve,
    "m_best_threshold": m_best_threshold,
    "m_class_weight": m_class_weight,
    "m_leaderboard": m_leaderboard,
    "r_score_batch": r_score_batch,
    "d_ks": d_ks,
    "d_wasserstein": d_wasserstein,
    "d_psi": d_psi,
    "d_chi_square": d_chi_square,
    "d_chi_square_p": d_chi_square_p,
    "d_js": d_js,
    "d_summary": d_summary,
    "d_mean_shift": d_mean_shift,
    "d_scale_change": d_scale_change,
    "d_corruption": d_corruption,
    "d_missing": d_missing,
    "d_monitor_flow": d_monitor_flow,
    "e_blend_grid2": e_blend_grid2,
    "e_blend_grid3": e_blend_grid3,
    "e_blend_score": e_blend_score,
}


# ---------------------------------------------------------------- rows-only: training, stacking, I/O, streams
# Tree fits depend on partitioning and thread order, so these are checked by rows.

TRAIN_ITER = 10


def _ff(spark, d):
    ff = keep(full_features(spark, d))
    feats = [c for c in ff.columns if c not in ("txn_id", "Class", "split")]
    return ff, feats


def _train_cfg(feats):
    from riskframe.operators.train import TrainConfig

    return TrainConfig(feature_cols=feats, max_iter=TRAIN_ITER, fixed={"maxDepth": 3})


def _train_score(spark, d, model_type):
    from riskframe.operators.train import fit_score

    ff, feats = _ff(spark, d)
    scorer = fit_score(model_type, {}, ff, _train_cfg(feats))
    test = scorer.transform(ff.where(F.col("split") == "test"))
    return test.select("txn_id", "Class", F.round("score", 6).alias("score"))


def l_gbt_train_score(spark, d):
    return _train_score(spark, d, "gbt")


def l_gbt_sub_train_score(spark, d):
    return _train_score(spark, d, "gbt_sub")


def l_rf_train_score(spark, d):
    return _train_score(spark, d, "rf")


def l_tune(spark, d):
    from riskframe.operators.train import tune_model

    ff, feats = _ff(spark, d)
    _best, trials = tune_model("rf", ff, _train_cfg(feats), timeout_s=300)
    return trials


def l_train_evaluate(spark, d):
    from riskframe.operators.train import train_and_evaluate

    ff, feats = _ff(spark, d)
    _scorer, metrics = train_and_evaluate("rf", {}, ff, _train_cfg(feats))
    return metrics


def _heuristic_bases(df):
    from riskframe.operators.ensemble import base_scores

    return base_scores(df, [(n, HeuristicScorer(variant=n)) for n in ["r3", "r3_b", "r3_c"]])


BASE_COLS = ["score_r3", "score_r3_b", "score_r3_c"]


def e_stack_in_sample(spark, d):
    from riskframe.operators.ensemble import StackingEnsemble

    df = _heuristic_bases(_txn_split(spark, d))
    st = StackingEnsemble(BASE_COLS).fit(df.where(F.col("split") == "train"))
    out = st.predict_proba(df.where(F.col("split") == "test"))
    return out.select("txn_id", F.round("score", 6).alias("score"))


def e_stack_oof(spark, d):
    from riskframe.operators.ensemble import StackingEnsemble, oof_base_scores
    from riskframe.operators.train import fit_score

    ff, feats = _ff(spark, d)
    cfg = _train_cfg(feats)

    def fit_rf(frame):
        return fit_score("rf", {}, frame.withColumn("split", F.lit("train")), cfg)

    train = ff.where(F.col("split") == "train")
    meta_x = oof_base_scores(train, [("rf", fit_rf)], k=5)
    st = StackingEnsemble(["score_rf"]).fit(meta_x)
    test = fit_rf(train).transform(ff.where(F.col("split") == "test")).withColumnRenamed("score", "score_rf")
    return st.predict_proba(test).select("txn_id", F.round("score", 6).alias("score"))


def e_compare(spark, d):
    """Three bases, stacking and blending on the test split; leaderboard."""
    from riskframe.operators.ensemble import BlendingEnsemble, StackingEnsemble
    from riskframe.operators.flows import tuned_metrics

    df = _heuristic_bases(_txn_split(spark, d))
    st = StackingEnsemble(BASE_COLS).fit(df.where(F.col("split") == "train"))
    bl = BlendingEnsemble(BASE_COLS).fit(df.where(F.col("split") == "val"))
    stacked = st.predict_proba(df.where("split IN ('val', 'test')"), "score_stacking")
    both = bl.predict_proba(stacked, "score_blending")
    return tuned_metrics(both, BASE_COLS + ["score_stacking", "score_blending"])


def s_roundtrip(spark, d):
    """Save the fitted pipeline and a model, load both, score again; both scores returned."""
    from pyspark.ml.classification import RandomForestClassificationModel

    from riskframe.operators.train import assemble, build_model, weight_column
    from riskframe.session import scratch_path
    from riskframe.sources import io

    df = _txn_split(spark, d)
    pipe = build_feature_pipeline().fit(df.where(F.col("split") == "train"))
    ppath = io.save_pipeline(pipe, scratch_path(spark, "pipeline"))
    pipe2 = io.load_pipeline(spark, ppath)
    ff = pipe.transform(df)
    feats = [c for c in ff.columns if c not in ("txn_id", "Class", "split")]
    train = ff.where(F.col("split") == "train")
    model = build_model("rf", {"maxDepth": 3, "numTrees": 10}).fit(
        assemble(train.withColumn("weight", weight_column(train, "rf")), feats))
    mpath = io.save_model(model, scratch_path(spark, "model"))
    model2 = io.load_model(spark, RandomForestClassificationModel, mpath)
    test = df.where(F.col("split") == "test")
    from pyspark.ml.functions import vector_to_array

    def score(p, m, name):
        x = assemble(p.transform(test), feats)
        return m.transform(x).select("txn_id", F.round(vector_to_array("probability")[1], 9).alias(name))

    return score(pipe, model, "score_before").join(score(pipe2, model2, "score_after"), "txn_id")


def _events_schema(spark, d):
    return T.table(spark, d, "events").schema


def r_stream_score(spark, d):
    """Events stream -> txn_events -> time/amount features -> logistic scorer -> sink."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from riskframe.operators.score import ProbabilityScorer
    from riskframe.session import scratch_path
    from riskframe.streaming.scoring import file_stream, read_scored, run_to_completion, stream_score

    train = _events_split(spark, d).where(F.col("split") == "train")
    feats = Pipeline(stages=[TimeCyclical(), AmountScaler()]).fit(train)
    va = VectorAssembler(inputCols=["hour_sin", "hour_cos", "Amount"], outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=50)
    model = Pipeline(stages=[va, lr]).fit(feats.transform(train).withColumn("label", F.col("Class").cast("double")))
    stream = T.txn_events_from(file_stream(spark, d, "events.parquet", _events_schema(spark, d)))
    out, ck = scratch_path(spark, "stream-score"), scratch_path(spark, "stream-score-ckpt")
    q = stream_score(stream, ProbabilityScorer(model), out, ck, features=feats, required=["Time", "Amount"],
                     threshold=0.25, model_name="logistic")
    run_to_completion(q)
    return read_scored(spark, out).drop("batch_id")


def d_stream_psi(spark, d):
    """Daily PSI of Amount on the events stream against the train split."""
    from riskframe.session import scratch_path
    from riskframe.streaming import drift as SD
    from riskframe.streaming.scoring import file_stream, run_to_completion

    ref = _events_split(spark, d).where(F.col("split") == "train")
    lo, hi = SD.reference_edges(ref, "Amount")
    shares = SD.reference_shares(ref, "Amount", lo, hi)
    stream = file_stream(spark, d, "events.parquet", _events_schema(spark, d))
    out, ck = scratch_path(spark, "stream-psi"), scratch_path(spark, "stream-psi-ckpt")
    q = SD.start_window_counts(stream, "ts", "value", lo, hi, out, ck)
    run_to_completion(q)
    return SD.window_psi(spark, out, shares)


def s_results_sink(spark, d):
    """Write the leaderboard as JSON results under the checkpoint folder and read it back."""
    from riskframe.session import scratch_path
    from riskframe.sources import io

    path = io.save_results(m_leaderboard(spark, d), scratch_path(spark, "results"))
    return spark.read.json(path)


def s_drift_report(spark, d):
    """Save the drift summary, load it with the declared schema."""
    from riskframe.session import scratch_path
    from riskframe.sources import io

    r, c = _ref_cur(spark, d)
    summary, _ = D.detect_data_drift(r, c, target_col="Class", numerical_features=LINE_NUMERIC)
    path = io.save_drift_report(summary, scratch_path(spark, "drift-report"))
    return io.load_drift_report(spark, path).withColumn("drifted_features", F.array_join("drifted_features", ","))


def l_full_training(spark, d):
    """L9 + E8: the full training run (one trial per model, short fits), then the
    five-way ensemble comparison on test."""
    from riskframe.operators.flows import run_ensemble, run_full_training

    run = run_full_training(T.txn(spark, d), n_trials=1, timeout_s=300, max_iter=TRAIN_ITER)
    return run_ensemble(run)


ROWS_ONLY = {
    "l_full_training": l_full_training,
    "s_results_sink": s_results_sink,
    "s_drift_report": s_drift_report,
    "l_gbt_train_score": l_gbt_train_score,
    "l_gbt_sub_train_score": l_gbt_sub_train_score,
    "l_rf_train_score": l_rf_train_score,
    "l_tune": l_tune,
    "l_train_evaluate": l_train_evaluate,
    "e_stack_in_sample": e_stack_in_sample,
    "e_stack_oof": e_stack_oof,
    "e_compare": e_compare,
    "s_roundtrip": s_roundtrip,
    "r_stream_score": r_stream_score,
    "d_stream_psi": d_stream_psi,
}
