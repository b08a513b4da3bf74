"""Drift tests between a reference and a current frame, and drift simulators.

Numeric features: one unpivoted frame ``(feature, value, side)`` grouped by
(feature, value) gives per-value counts of both sides; the bucketed prefix plan
(ascending) turns them into the two empirical CDFs F and G per feature, so

* KS      D  = max |F - G|, p-value by the asymptotic Kolmogorov series with
             Stephens' small-sample correction (drift iff p < threshold);
* W1         = sum |F - G| * (next value - value); normalised by the reference's
             population std;
* PSI        = sum (c - r) ln(c / r) over 10 equal-width bins of the reference range
             (shares floored at 1e-4).

* JS         Jensen-Shannon distance over 20 bins of equal pooled share (``effect_min``).

Categorical features: chi-square statistic of the (category x side) table, its p-value from the
regularised incomplete gamma function.
Simulators are pure functions of (id, column, seed), so results never depend on
partitioning or task re-execution.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskframe.functions.exprs import clip, nan_to_null
from riskframe.functions.hashing import hash_normal, hash_uniform
from riskframe.functions.special import chi_square_sf
from riskframe.plans.broadcast import bounded_broadcast
from riskframe.plans.materialize import keep
from riskframe.plans.maxima import LEAST_BUCKETS
from riskframe.plans.prefix import ordered_prefix
from riskframe.plans.quantiles import select_ranks
from riskframe.plans.workers import ship

ROUND = 6
PSI_BINS = 10
PSI_EPS = 1e-4
JS_BINS = 20
KS_TERMS = 100
KS_BATCH_VALUES, KS_TASK_VALUES = 256, 1024  # for cuts only
KS_MOST_BUCKETS, KS_MOST_CELLS = 1 << 14, 1 << 19  # of a feature; of all features
DRIFT_TYPES = ("mean_shift", "scale_change", "corruption", "missing")


def _long(df: DataFrame, features: Sequence[str], side: int) -> DataFrame:
    cast = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in features])
    return cast.unpivot([], list(features), "feature", "value").withColumn("side", F.lit(side))


def side_by_side(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, value, side)`` for both frames, NULL and NaN values dropped."""
    return _long(reference, features, 0).unionByName(_long(current, features, 1)).where(F.col("value").isNotNull())


def ks_pvalue(d: F.Column, n: F.Column, m: F.Column) -> F.Column:
    """Asymptotic two-sample KS p-value ``Q_KS((sqrt(e) + 0.12 + 0.11/sqrt(e)) D)``, e = nm/(n+m).

    ``Q_KS(l) = 2 sum (-1)^(j-1) exp(-2 j^2 l^2)`` for l >= 1, and the equivalent
    ``1 - sqrt(2 pi)/l sum exp(-(2j-1)^2 pi^2 / (8 l^2))`` below 1 (fast there).
    """
    en = F.sqrt(F.try_divide(n.cast("double") * m.cast("double"), (n + m).cast("double")))
    lam = (en + F.lit(0.12) + F.try_divide(F.lit(0.11), en)) * d  # NULL when a side is empty
    js = F.sequence(F.lit(1), F.lit(KS_TERMS))
    big = F.lit(2.0) * F.aggregate(
        js, F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.lit(-2.0) * j * j * lam * lam),
    )
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * F.aggregate(
        js, F.lit(0.0),
        lambda acc, j: acc + F.exp(-((2 * j - 1) * (2 * j - 1)) * F.lit(math.pi ** 2) / (F.lit(8.0) * lam * lam)),
    )
    q = F.when(lam <= 0, F.lit(1.0)).when(lam < 1.0, small).otherwise(big)
    return clip(q, 0.0, 1.0)  # NULL-preserving (greatest/least skip NULLs)


def gap_bounds():
    """|F - G| within a bucket is at most the larger of one function's end less the other's start."""
    share = lambda part, total, side: F.try_divide(part[side].cast("double"), total[side].cast("double"))

    def upper(before, end, total):
        a = share(end, total, "r") - share(before, total, "c")
        b = share(end, total, "c") - share(before, total, "r")
        return F.when(a >= b, a).otherwise(b)

    return upper, lambda before, end, total: F.abs(share(end, total, "r") - share(end, total, "c"))


def _wide(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features of both frames as doubles, NaN as NULL, and the side."""
    side = lambda df, k: df.select(*(nan_to_null(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(features)), F.lit(k).alias("side"))
    return side(reference, 0).unionByName(side(current, 1))


def _values(part: pd.DataFrame, c: int) -> tuple[np.ndarray, np.ndarray]:
    v = part[f"v{c}"].to_numpy(dtype=np.float64)
    ok = ~np.isnan(v)
    return v[ok], part["side"].to_numpy()[ok]


def _evenly(v: np.ndarray, k: int) -> np.ndarray:
    return v if len(v) <= k else v[(np.arange(k) * (len(v) - 1)) // (k - 1)]


def ks_cuts(both: DataFrame, n_features: int, least_buckets: int) -> list[np.ndarray]:
    """Per feature ascending cuts of buckets that hold about equal shares, more of them the more rows
    there are: the largest gap by chance falls with the root of the rows, and a bucket bounds it only as
    far as its share. They only balance the work, so evenly spaced values of each task are enough."""
    def some(parts):
        n, held = np.zeros(n_features, dtype=np.int64), [np.zeros(0) for _ in range(n_features)]
        for p in parts:
            for c in range(n_features):
                v, _ = _values(p, c)
                n[c] += len(v)
                held[c] = np.append(held[c], _evenly(np.sort(v), KS_BATCH_VALUES))
                if len(held[c]) > 64 * KS_TASK_VALUES:
                    held[c] = _evenly(np.sort(held[c]), 32 * KS_TASK_VALUES)
        for c in np.flatnonzero(n):
            v = _evenly(np.sort(held[c]), KS_TASK_VALUES)
            yield pd.DataFrame({"c": np.full(len(v), c, dtype=np.int32), "v": v, "n": np.append(n[c], np.zeros(len(v) - 1, dtype=np.int64))})

    found = keep(both.mapInPandas(some, "c int, v double, n long"))
    most = found.groupBy("c").agg(F.sum("n").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    n_buckets = max(least_buckets, min(KS_MOST_BUCKETS, 4 * math.isqrt(most), KS_MOST_CELLS // n_features))
    cuts = [np.zeros(0) for _ in range(n_features)]
    if n_buckets > 1:
        steps = [i / n_buckets for i in range(1, n_buckets)]
        for r in found.groupBy("c").agg(F.percentile_approx("v", steps, 8 * n_buckets).alias("v")).collect():
            cuts[r["c"]] = np.unique(r["v"])
    return cuts


def ks_buckets(both: DataFrame, cuts: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per feature the rows of both sides in each bucket (2 x buckets), and which buckets can hold the
    largest gap: |F - G| within one is at most the larger of one function's end less the other's start,
    and at its end it is reached. One scan; what is shuffled are counts."""
    def count(parts):
        total = [np.zeros((2, len(q) + 1), dtype=np.int64) for q in cuts]
        for p in parts:
            for c, q in enumerate(cuts):
                v, of = _values(p, c)
                total[c] += np.bincount(of * (len(q) + 1) + np.searchsorted(q, v), minlength=2 * len(q) + 2).reshape(2, -1)
        for c, t in enumerate(total):
            b = np.flatnonzero(t.any(axis=0))
            yield pd.DataFrame({"c": np.full(len(b), c, dtype=np.int32), "b": b.astype(np.int32), "r": t[0, b], "n": t[1, b]})

    got = both.mapInPandas(count, "c int, b int, r long, n long").groupBy("c", "b").agg(
        F.sum("r").alias("r"), F.sum("n").alias("n")).toPandas()  # at most KS_MOST_CELLS, or least_buckets a feature
    out = []
    for c, q in enumerate(cuts):
        own, t = got[got["c"] == c], np.zeros((2, len(q) + 1), dtype=np.int64)
        t[0, own["b"]], t[1, own["b"]] = own["r"], own["n"]
        alive = np.zeros(len(q) + 1, dtype=bool)
        if t.sum(axis=1).all():
            end = np.cumsum(t, axis=1)
            (f, g), (f0, g0) = (x / t.sum(axis=1, keepdims=True) for x in (end, end - t))
            alive = t.any(axis=0) & (np.maximum(f - g0, g - f0) >= np.abs(f - g).max())
        out.append((t, alive))
    return out


def ks_test(reference: DataFrame, current: DataFrame, features: Sequence[str], threshold: float = 0.05,
            least_buckets: int = LEAST_BUCKETS) -> DataFrame:
    """D1 (KS only): ``feature, ks_d, p_value, drift, n_ref, n_cur`` as ``numeric_drift`` gives them.

    Only values in buckets that can hold the largest gap are collapsed and sorted."""
    spark, names = reference.sparkSession, list(features)
    ship(spark)
    both = _wide(reference, current, names)
    cuts = ks_cuts(both, len(names), least_buckets)
    buckets = ks_buckets(both, cuts)
    alive = [a for _, a in buckets]

    def open_values(parts):
        for p in parts:
            for c in range(len(cuts)):
                v, of = _values(p, c)
                b = np.searchsorted(cuts[c], v)
                at = alive[c][b]
                value, first, where = np.unique(v[at], return_index=True, return_inverse=True)
                r = np.bincount(where, weights=of[at] == 0, minlength=len(value)).astype(np.int64)
                n = np.bincount(where, minlength=len(value)) - r
                yield pd.DataFrame({"c": np.full(len(value), c, dtype=np.int32), "b": b[at][first].astype(np.int32), "value": value, "r": r, "n": n})

    one = both.mapInPandas(open_values, "c int, b int, value double, r long, n long").groupBy("c", "b", "value").agg(
        F.sum("r").alias("r"), F.sum("n").alias("n"))
    before = [pd.DataFrame({"c": c, "b": np.flatnonzero(a), "r0": (np.cumsum(t[0]) - t[0])[a], "n0": (np.cumsum(t[1]) - t[1])[a]}) for c, (t, a) in enumerate(buckets)]
    before = spark.createDataFrame(pd.concat(before).astype("int64"), "c long, b long, r0 long, n0 long").select(
        F.col("c").cast("int").alias("c"), F.col("b").cast("int").alias("b"), "r0", "n0")
    sizes = [(c, f, *(int(x) for x in t.sum(axis=1))) for c, (f, (t, _)) in enumerate(zip(names, buckets)) if t.any()]
    sizes = spark.createDataFrame(sizes, "c int, feature string, n_ref long, n_cur long")
    run = Window.partitionBy("c", "b").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = one.join(bounded_broadcast(before, sum(int(a.sum()) for a in alive)), ["c", "b"]).join(bounded_broadcast(sizes, len(names)), "c")
    share = lambda x, total: F.try_divide((F.sum(x).over(run) + F.col(f"{x}0")).cast("double"), F.col(total).cast("double"))
    gap = rows.select("c", F.abs(share("r", "n_ref") - share("n", "n_cur")).alias("gap")).groupBy("c").agg(F.max("gap").alias("ks_d"))
    per = sizes.join(gap, "c", "left")
    per = per.withColumn("_p", ks_pvalue(F.col("ks_d"), F.col("n_ref"), F.col("n_cur")))
    return per.select(
        "feature", F.round("ks_d", ROUND).alias("ks_d"), F.round("_p", ROUND).alias("p_value"),
        (F.col("_p") < F.lit(float(threshold))).alias("drift"), "n_ref", "n_cur")


def numeric_drift(reference: DataFrame, current: DataFrame, features: Sequence[str],
                  threshold: float = 0.05) -> DataFrame:
    """D1 (numeric): per feature ``ks_d, p_value, drift, w1, w1_norm, n_ref, n_cur``."""
    lf = side_by_side(reference, current, features)
    counts = lf.groupBy("feature", "value").agg(
        F.sum((F.col("side") == 0).cast("long")).alias("r"),
        F.sum((F.col("side") == 1).cast("long")).alias("c"),
    )
    cur = ordered_prefix(counts, ["feature"], "value", ["r", "c"], descending=False, with_next=True,
                         with_totals=True)
    Fr = F.try_divide(F.col("cum_r").cast("double"), F.col("tot_r").cast("double"))
    Gc = F.try_divide(F.col("cum_c").cast("double"), F.col("tot_c").cast("double"))
    gap = F.abs(Fr - Gc)
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    per = cur.groupBy("feature").agg(
        F.max(gap).alias("ks_d"), F.sum(gap * step).alias("w1"),
        F.max("tot_r").alias("n_ref"), F.max("tot_c").alias("n_cur"),
    )
    ref_std = _long(reference, features, 0).groupBy("feature").agg(F.stddev_pop("value").alias("_sd"))
    per = per.join(bounded_broadcast(ref_std, len(features)), "feature", "left")
    # p from the unrounded statistic, in its own projection
    per = per.withColumn("_p", ks_pvalue(F.col("ks_d"), F.col("n_ref"), F.col("n_cur")))
    return per.select(
        "feature",
        F.round("ks_d", ROUND).alias("ks_d"),
        F.round("_p", ROUND).alias("p_value"),
        (F.col("_p") < F.lit(float(threshold))).alias("drift"),
        F.round("w1", ROUND).alias("w1"),
        F.round(F.try_divide(F.col("w1"), F.col("_sd")), ROUND).alias("w1_norm"),
        F.col("n_ref").cast("long").alias("n_ref"), F.col("n_cur").cast("long").alias("n_cur"),
    )


def psi(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = PSI_BINS,
        eps: float = PSI_EPS) -> DataFrame:
    """D1 (PSI): bins are equal-width over the reference's [min, max]; out-of-range values clamp."""
    lf = side_by_side(reference, current, features)
    rng = lf.where(F.col("side") == 0).groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    j = lf.join(bounded_broadcast(rng, len(features)), "feature")
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width <= 0, F.lit(0)).otherwise(
        F.least(F.greatest(F.floor((F.col("value") - F.col("_lo")) / width * bins), F.lit(0)), F.lit(bins - 1))
    ).cast("int")
    cnt = j.groupBy("feature", b.alias("bin")).agg(
        F.sum((F.col("side") == 0).cast("long")).alias("r"), F.sum((F.col("side") == 1).cast("long")).alias("c")
    )
    tot = cnt.groupBy("feature").agg(F.sum("r").alias("_nr"), F.sum("c").alias("_nc"))
    grid = tot.select("feature", "_nr", "_nc", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(cnt, ["feature", "bin"], "left").fillna(0, ["r", "c"])
    pr = clip(F.try_divide(F.col("r").cast("double"), F.col("_nr").cast("double")), lo=eps)
    pc = clip(F.try_divide(F.col("c").cast("double"), F.col("_nc").cast("double")), lo=eps)
    return full.groupBy("feature").agg(F.sum((pc - pr) * F.log(pc / pr)).alias("psi")).select(
        "feature", F.round("psi", ROUND).alias("psi")
    )


def chi_square(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """D1 (categorical): chi-square statistic and degrees of freedom of (category x side)."""
    return chi_square_test(reference, current, features).select("feature", F.round("statistic", ROUND).alias("statistic"), "dof")


def chi_square_test(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, statistic, dof, p``, unrounded; NULL when a side is empty."""
    def lf(df, side):
        return df.select(*[F.col(c).cast("string").alias(c) for c in features]).unpivot(
            [], list(features), "feature", "value").withColumn("side", F.lit(side))
    both = lf(reference, 0).unionByName(lf(current, 1)).where(F.col("value").isNotNull())
    cnt = both.groupBy("feature", "value").agg(
        F.sum((F.col("side") == 0).cast("long")).alias("r"), F.sum((F.col("side") == 1).cast("long")).alias("c")
    )
    tot = cnt.groupBy("feature").agg(F.sum("r").alias("_nr"), F.sum("c").alias("_nc"), F.count(F.lit(1)).alias("_k"))
    j = cnt.join(bounded_broadcast(tot, len(features)), "feature")
    n = (F.col("_nr") + F.col("_nc")).cast("double")
    row = (F.col("r") + F.col("c")).cast("double")
    er, ec = row * F.col("_nr") / n, row * F.col("_nc") / n
    term = (F.try_divide((F.col("r") - er) * (F.col("r") - er), er)
            + F.try_divide((F.col("c") - ec) * (F.col("c") - ec), ec))  # NULL when a side is empty
    return j.groupBy("feature").agg(
        F.sum(term).alias("statistic"), F.max("_k").alias("_k")
    ).select("feature", "statistic", (F.col("_k") - 1).cast("long").alias("dof")).withColumn(
        "p", chi_square_sf(F.col("statistic"), F.col("dof")))


def _js(r: np.ndarray, c: np.ndarray) -> float | None:
    """Jensen-Shannon distance (base 2, 0 to 1) of two rows of counts; None if a side is empty."""
    if not r.sum() or not c.sum():
        return None
    p, q = r / r.sum(), c / c.sum()
    m = (p + q) / 2
    part = lambda x: float((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum())
    return math.sqrt(max(0.0, (part(p) + part(q)) / 2))


def js_distance(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = JS_BINS) -> DataFrame:
    """D1 (JS): Jensen-Shannon distance over bins that hold equal shares of both sides together.

    The cuts are exact ranks of the pooled values (``plans.quantiles``); a value equal to a cut lies
    below it. One more scan counts both sides per bin; nothing is sorted or multiplied."""
    side = lambda df, k: df.select(*(nan_to_null(F.col(c).cast("double")).alias(c) for c in features), F.lit(k).alias("\x01side"))
    both = side(reference, 0).unionByName(side(current, 1))
    cuts = {c: np.unique([at[math.floor(j / bins * (n - 1))] for j in range(1, bins)])
            for _, c, n, at in select_ranks(both, list(features), [j / bins for j in range(1, bins)])}
    ship(reference.sparkSession)
    names = list(features)

    def count(parts):
        total = np.zeros((len(names), 2, bins + 1), dtype=np.int64)
        for p in parts:
            of = p["\x01side"].to_numpy()
            for c, q in cuts.items():
                v = p[names[c]].to_numpy(dtype=np.float64)
                ok = ~np.isnan(v)
                cell = of[ok] * (bins + 1) + np.searchsorted(q, v[ok], side="left")
                total[c] += np.bincount(cell, minlength=2 * (bins + 1)).reshape(2, bins + 1)
        c, s, b = np.nonzero(total)
        yield pd.DataFrame({"c": c.astype(np.int32), "side": s.astype(np.int32), "bin": b.astype(np.int32), "n": total[c, s, b]})

    table = np.zeros((len(names), 2, bins + 1))
    for r in both.mapInPandas(count, "c int, side int, bin int, n long").groupBy("c", "side", "bin").agg(F.sum("n").alias("n")).collect():
        table[r["c"], r["side"], r["bin"]] = r["n"]  # features x bins of them
    rows = [(f, _js(table[i, 0], table[i, 1])) for i, f in enumerate(names)]
    return reference.sparkSession.createDataFrame(rows, "feature string, js double").withColumn("js", F.round("js", ROUND))


def js_of_categories(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance of categories, from their counts on both sides."""
    def lf(df, k):
        return df.select(*[F.col(c).cast("string").alias(c) for c in features]).unpivot([], list(features), "feature", "value").withColumn("side", F.lit(k))
    cnt = lf(reference, 0).unionByName(lf(current, 1)).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("c"))
    tot = cnt.groupBy("feature").agg(F.sum("r").alias("_nr"), F.sum("c").alias("_nc"))
    j = cnt.join(bounded_broadcast(tot, len(features)), "feature")
    p, q = F.try_divide("r", "_nr"), F.try_divide("c", "_nc")
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.when(m.isNotNull(), 0.0))
    return j.groupBy("feature").agg(F.sum(part(p) + part(q)).alias("s")).select(
        "feature", F.round(F.sqrt(F.greatest(F.col("s") / 2, F.lit(0.0))), ROUND).alias("js"))


def default_features(df: DataFrame, target_col: str | None = "Class", id_col: str | None = "txn_id") -> list[str]:
    """Numeric columns minus the target and the id."""
    skip = {target_col, id_col}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]


def detect_data_drift(reference: DataFrame, current: DataFrame, target_col: str | None = None,
                      numerical_features: Sequence[str] | None = None,
                      categorical_features: Sequence[str] | None = None,
                      threshold: float = 0.05, share_threshold: float = 0.5, rule: str = "any",
                      id_col: str | None = "txn_id", effect_min: float | None = None) -> tuple[DataFrame, DataFrame]:
    """``(summary, detail)``.

    At scale the smallest shift is significant: with ``effect_min`` a feature drifts only if its
    Jensen-Shannon distance (column ``js`` of the detail then) reaches that as well.

    ``detail``: one row per feature (``feature, kind, statistic, p_value, drift``).
    ``summary``: the 8-field record; ``rule='any'`` flags the dataset when any feature
    drifts, ``rule='share'`` when the drifted share exceeds ``share_threshold``.
    The target is excluded everywhere.
    """
    num = list(numerical_features) if numerical_features is not None else default_features(reference, target_col, id_col)
    num = [c for c in num if c != target_col]
    cat = [c for c in (categorical_features or []) if c != target_col]
    if not num and not cat:
        raise ValueError("no features to test for drift")
    parts = []
    if num:
        nd = ks_test(reference, current, num, threshold)
        parts.append(nd.select("feature", F.lit("numeric").alias("kind"), F.col("ks_d").alias("statistic"),
                               "p_value", "drift"))
    if cat:
        cs = chi_square_test(reference, current, cat)
        parts.append(cs.select("feature", F.lit("categorical").alias("kind"), F.round("statistic", ROUND).alias("statistic"),
                               F.round("p", ROUND).alias("p_value"), (F.col("p") < threshold).alias("drift")))
    detail = parts[0]
    for p_ in parts[1:]:
        detail = detail.unionByName(p_)
    if effect_min is not None:
        js = [f(reference, current, fs) for f, fs in ((js_distance, num), (js_of_categories, cat)) if fs]
        js = js[0].unionByName(js[1]) if len(js) > 1 else js[0]
        strong = F.coalesce(F.col("js") >= F.lit(float(effect_min)), F.lit(False))
        detail = detail.join(bounded_broadcast(js, len(num) + len(cat)), "feature", "left").withColumn("drift", F.col("drift") & strong)
    total = len(num) + len(cat)
    one = lambda r, c: (F.lit(r).cast("long").alias("r"), F.lit(c).cast("long").alias("c"))
    rows = reference.select(*one(1, 0)).union(current.select(*one(0, 1))).agg(F.sum("r").alias("r"), F.sum("c").alias("c")).first()
    agg = detail.agg(
        F.count_if("drift").alias("num_drifted_features"),
        F.sort_array(F.collect_list(F.when(F.col("drift"), F.col("feature")))).alias("drifted_features"),
    )
    share = F.col("num_drifted_features") / F.lit(float(total))
    detected = (F.col("num_drifted_features") > 0) if rule == "any" else (share > F.lit(float(share_threshold)))
    summary = agg.select(
        detected.alias("dataset_drift_detected"), "drifted_features",
        F.col("num_drifted_features").cast("int").alias("num_drifted_features"),
        F.lit(total).cast("int").alias("total_features"),
        F.lit(float(threshold)).alias("drift_threshold"),
        F.round(share, ROUND).alias("drift_share"),
        F.lit(int(rows["r"] or 0)).cast("long").alias("reference_rows"), F.lit(int(rows["c"] or 0)).cast("long").alias("current_rows"),
    )
    return summary, detail


# ---------------------------------------------------------------- simulators

def _check(drift_type: str):
    if drift_type not in DRIFT_TYPES:
        raise ValueError(f"{drift_type!r} is none of {', '.join(DRIFT_TYPES)}")


def simulate_drift(df: DataFrame, drift_type: str = "mean_shift", magnitude: float = 0.5,
                   features_to_perturb: Sequence[str] | None = None, random_seed: int = 42,
                   id_col: str = "txn_id", target_col: str = "Class") -> DataFrame:
    """Perturb chosen numeric columns; unknown names are skipped silently.

    * ``mean_shift``   x + magnitude * std_samp(x)
    * ``scale_change`` x * (1 + magnitude)
    * ``corruption``   x + N(0, magnitude * std_samp(x)), N from md5(id|column|seed)
    * ``missing``      NULL where U(id|column|seed) < magnitude
    """
    _check(drift_type)
    feats = list(features_to_perturb) if features_to_perturb is not None else default_features(df, target_col, id_col)
    feats = [c for c in feats if c in df.columns]
    if not feats:
        return df
    std = {}
    if drift_type in ("mean_shift", "corruption"):
        row = df.agg(*[F.stddev_samp(c).alias(c) for c in feats]).first()  # one value per feature
        std = {c: (row[c] if row[c] is not None else 0.0) for c in feats}
    cols = {}
    for c in feats:
        x = F.col(c).cast("double")
        if drift_type == "mean_shift":
            cols[c] = x + F.lit(magnitude * std[c])
        elif drift_type == "scale_change":
            cols[c] = x * F.lit(1.0 + magnitude)
        elif drift_type == "corruption":
            cols[c] = x + hash_normal(id_col, random_seed, c) * F.lit(magnitude * std[c])
        else:
            cols[c] = F.when(hash_uniform(id_col, random_seed, c) < F.lit(float(magnitude)),
                             F.lit(None).cast("double")).otherwise(x)
    return df.withColumns(cols)
