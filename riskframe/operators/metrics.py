"""M1-M8: threshold and ranking metrics as distributed aggregations.

Ranking metrics use the bucketed prefix plan (``plans.prefix``): ties are
collapsed per distinct score, cumulative (tp, fp) counts are computed in
descending score order per key without a single-partition sort, and each metric
is one aggregation over that curve:

* average precision  AP  = sum_g tp_g * prec_g / P          (step sum, not trapezoid)
* ROC-AUC                = sum_g fp_g * (2 cum_tp_g - tp_g) / (2 P N)   (ties count half)
* F1 at threshold g      = 2 cum_tp / (cum_tp + cum_fp + P) (exact rational form)

``BinaryClassificationEvaluator(areaUnderPR)`` is trapezoidal and is not used.
No positives -> AP, AUC and the best threshold are NULL (documented divergence).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import nan_to_null, zero_div
from riskframe.plans.maxima import candidates
from riskframe.plans.prefix import ordered_prefix

ROUND = 6


def _label(label_col: str):
    return F.col(label_col).cast("long")


def scored_rows(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """Rows that every metric counts: those with a label and a score (NaN is no score)."""
    return df.where(F.col(label_col).isNotNull() & nan_to_null(F.col(score_col).cast("double")).isNotNull())


def confusion(df: DataFrame, label_col: str = "Class", score_col: str = "score", threshold: float = 0.5,
              keys: Sequence[str] = ()) -> DataFrame:
    """M1: all four cells (zeros included) per key: ``actual, predicted, count``."""
    y = _label(label_col)
    p = (F.col(score_col) >= F.lit(float(threshold))).cast("long")
    cells = scored_rows(df, label_col, score_col).groupBy(*keys).agg(
        F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).alias("c00"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).alias("c01"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).alias("c10"),
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).alias("c11"),
    )
    return cells.select(
        *keys,
        F.expr("stack(4, 0, 0, c00, 0, 1, c01, 1, 0, c10, 1, 1, c11) AS (actual, predicted, count)"),
    ).withColumn("count", F.col("count").cast("long"))


def threshold_metrics(df: DataFrame, label_col: str = "Class", score_col: str = "score",
                      threshold: float = 0.5, keys: Sequence[str] = ()) -> DataFrame:
    """M2: precision, recall and F1 at ``score >= threshold``; 0 on empty denominators."""
    y = _label(label_col)
    p = (F.col(score_col) >= F.lit(float(threshold))).cast("long")
    c = scored_rows(df, label_col, score_col).groupBy(*keys).agg(
        F.sum(y * p).alias("tp"), F.sum((1 - y) * p).alias("fp"), F.sum(y * (1 - p)).alias("fn")
    )
    return c.select(
        *keys,
        F.round(zero_div(F.col("tp"), F.col("tp") + F.col("fp")), ROUND).alias("precision"),
        F.round(zero_div(F.col("tp"), F.col("tp") + F.col("fn")), ROUND).alias("recall"),
        F.round(zero_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), ROUND).alias("f1"),
        F.lit(float(threshold)).alias("threshold"),
    )


def score_curve(df: DataFrame, label_col: str = "Class", score_col: str = "score",
                keys: Sequence[str] = (), **prefix_kw) -> DataFrame:
    """Per key and distinct score (descending): ``tp, fp, cum_tp, cum_fp, tot_tp, tot_fp``.

    The heart of M3-M6. Rows with a NULL or NaN score or a NULL label are not ranked. Ties are
    collapsed by a partial (map-side) aggregation, so a score value shared by a
    third of the rows is one row before the shuffle.
    """
    y = _label(label_col)
    agg = (
        scored_rows(df, label_col, score_col)
        .groupBy(*keys, F.col(score_col).cast("double").alias("score"))
        .agg(F.sum(y).alias("tp"), F.sum(1 - y).alias("fp"))
    )
    return ordered_prefix(agg, list(keys), "score", ["tp", "fp"], descending=True, with_totals=True,
                          **prefix_kw)


def ranking_metrics(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """M3 + M4 from a score curve: ``pr_auc`` (average precision) and ``roc_auc``."""
    tp, fp, ctp, cfp = F.col("tp"), F.col("fp"), F.col("cum_tp"), F.col("cum_fp")
    agg = curve.groupBy(*keys).agg(
        F.sum(tp * ctp / (ctp + cfp)).alias("_ap_num"),
        F.sum(fp * (2 * ctp - tp)).alias("_auc_num"),
        F.sum(tp).alias("_p"), F.sum(fp).alias("_n"),
    )
    return agg.select(
        *keys,
        F.round(F.try_divide(F.col("_ap_num"), F.col("_p").cast("double")), ROUND).alias("pr_auc"),
        F.round(F.try_divide(F.col("_auc_num").cast("double"), 2.0 * F.col("_p") * F.col("_n")), ROUND).alias("roc_auc"),
    )


def pr_curve(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """M5: ``(threshold, precision, recall)`` at every distinct score.

    Recall is 1 everywhere when a key has no positives (as the reference library does).
    """
    recall = F.coalesce(F.try_divide(F.col("cum_tp").cast("double"), F.col("tot_tp").cast("double")), F.lit(1.0))
    return curve.select(
        *keys,
        F.col("score").alias("threshold"),
        F.round(F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp")), ROUND).alias("precision"),
        F.round(recall, ROUND).alias("recall"),
    )


def best_threshold(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """M6: F1-optimal threshold; the lowest score wins ties (first max in ascending order).

    F1 is computed in the exact rational form ``2 tp / (tp + fp + P)``, so equal F1
    values compare equal. A distributed ``max_by`` per key, no ordering of the data.
    """
    f1 = F.try_divide(2.0 * F.col("cum_tp"), (F.col("cum_tp") + F.col("cum_fp") + F.col("tot_tp")).cast("double"))
    c = curve.withColumn("_f1", F.coalesce(f1, F.lit(0.0)))
    best = c.groupBy(*keys).agg(
        F.max_by(F.struct("score", "_f1"), F.struct(F.col("_f1"), -F.col("score"))).alias("_b"),
        F.max("tot_tp").alias("_pp"),
    )
    return best.select(
        *keys,
        F.when(F.col("_pp") > 0, F.col("_b.score")).alias("best_threshold"),
        F.when(F.col("_pp") > 0, F.round(F.col("_b._f1"), ROUND)).alias("best_f1"),
    )


def f1_bounds():
    """F1 within a bucket of falling scores is at most what all its positives and none of its
    negatives would give; at its end it is reached. NULL without positives."""
    def f1(tp, fp, positives):
        return F.when(positives > 0, 2.0 * tp / (tp + fp + positives).cast("double"))

    return (lambda before, end, total: f1(end["tp"], before["fp"], total["tp"]),
            lambda before, end, total: f1(end["tp"], end["fp"], total["tp"]))


def best_threshold_by_bounds(df: DataFrame, label_col: str = "Class", score_col: str = "score",
                             keys: Sequence[str] = (), **bounds_kw) -> DataFrame:
    """M6 from scored rows: ``best_threshold`` of the curve, of which only the buckets that can
    hold the largest F1 are ranked. The result is the same."""
    y = _label(label_col)
    rows = scored_rows(df, label_col, score_col).select(
        *keys, F.col(score_col).cast("double").alias("score"), y.alias("tp"), (1 - y).alias("fp"))
    upper, lower = f1_bounds()
    return best_threshold(candidates(rows, keys, "score", ["tp", "fp"], upper, lower, descending=True, **bounds_kw), keys)


def class_weight(df: DataFrame, label_col: str = "Class") -> DataFrame:
    """M7: ``n_neg / n_pos`` (NULL when there are no positives)."""
    y = _label(label_col)
    return df.agg(
        F.sum(1 - y).alias("n_neg"), F.sum(y).alias("n_pos"),
    ).select(
        F.col("n_neg").cast("long").alias("n_neg"), F.col("n_pos").cast("long").alias("n_pos"),
        F.round(F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos").cast("double")), ROUND).alias("class_weight"),
    )


def class_weight_value(df: DataFrame, label_col: str = "Class") -> float:
    """M7 for training: raises when there is no positive row (as a weight cannot exist)."""
    row = class_weight(df, label_col).first()
    if row["class_weight"] is None:
        raise ValueError("class weight undefined: no positive rows")
    return float(row["n_neg"]) / float(row["n_pos"])


def evaluate(df: DataFrame, label_col: str = "Class", score_col: str = "score", threshold: float = 0.5,
             keys: Sequence[str] = ()) -> DataFrame:
    """compute_metrics per key: pr_auc, roc_auc, f1, precision, recall, threshold."""
    k = list(keys)
    if not k:
        df, k = df.withColumn("_all", F.lit(0)), ["_all"]
    curve = score_curve(df, label_col, score_col, k)
    at = threshold_metrics(df, label_col, score_col, threshold, k).withColumnsRenamed({c: f"_k_{c}" for c in k})
    cond = F.lit(True)
    for c in k:  # a model whose key is NULL has a row too
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return ranking_metrics(curve, k).join(at, cond).drop("_all", *(f"_k_{c}" for c in k))


def leaderboard(results: DataFrame) -> DataFrame:
    """M8: rank models by PR-AUC (desc), name as tie-break; ``rank`` 1 is the best.

    ``results`` has one row per model, so the ordering window is over #models rows.
    """
    from pyspark.sql import Window

    w = Window.orderBy(F.col("pr_auc").desc_nulls_last(), F.col("model_name"))
    return results.withColumn("rank", F.row_number().over(w).cast("long"))
