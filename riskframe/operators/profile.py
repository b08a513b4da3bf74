"""Profiling aggregations of a transaction table.

All features share a scan, never a Python loop of jobs: quantiles are selected exactly
(``plans.quantiles``), correlations, class means and deviations come from sums of products
over all pairs (``plans.moments``), histograms from one unpivoted ``(feature, value[, Class])``
frame whose small per-feature ranges are broadcast. The correlation with a constant column is
NULL.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskframe.plans.broadcast import bounded_broadcast
from riskframe.plans.materialize import cut
from riskframe.plans.moments import cross_moments
from riskframe.plans.quantiles import ALL, exact_quantiles

ROUND = 6


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ("Class",)) -> list[str]:
    """P5: numeric columns of the schema, minus ``exclude`` (driver-side, schema only)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def long_form(df: DataFrame, features: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Unpivot features to ``(extra..., feature, value DOUBLE)``."""
    cast = df.select(*extra, *[F.col(c).cast("double").alias(c) for c in features])
    return cast.unpivot(list(extra), list(features), "feature", "value")


def shape(df: DataFrame) -> DataFrame:
    """A1: per column: type, non-NULL count, total rows (one aggregation)."""
    cols = df.columns
    row_aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(c)).alias(f"_nn{i}") for i, c in enumerate(cols)]
    agg = df.agg(*row_aggs)
    types = dict(df.dtypes)
    stack = ", ".join(f"'{c}', '{types[c]}', _nn{i}" for i, c in enumerate(cols))
    return agg.select(
        F.expr(f"stack({len(cols)}, {stack}) AS (column, dtype, non_null)"), F.col("_rows").alias("rows")
    ).withColumn("columns", F.lit(len(cols)))


def missing(df: DataFrame) -> DataFrame:
    """A3: NULL (or NaN) count per column, plus a ``__total__`` row."""
    cols = df.columns
    types = dict(df.dtypes)
    aggs = []
    for i, c in enumerate(cols):
        isnull = F.col(c).isNull()
        if types[c] in ("double", "float"):
            isnull = isnull | F.isnan(F.col(c))
        aggs.append(F.sum(isnull.cast("long")).alias(f"_m{i}"))
    agg = df.agg(*aggs)
    stack = ", ".join(f"'{c}', _m{i}" for i, c in enumerate(cols))
    per = agg.select(F.expr(f"stack({len(cols)}, {stack}) AS (column, missing)"))
    total = per.agg(F.lit("__total__").alias("column"), F.sum("missing").alias("missing"))
    return per.unionByName(total).withColumn("missing", F.col("missing").cast("long"))


def describe(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """A2: count, mean, sample std, min, 25/50/75 % (exact), max per feature."""
    one = df.agg(*(f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (
        ("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))))
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), *(F.col(f"{n}{i}").alias(n) for n in ("count", "mean", "std", "min", "max")))
                     for i, c in enumerate(features)))
    base = one.select(F.explode(rows).alias("r")).select("r.*")
    qw = _wide_quantiles(df, features, {0.25: "p25", 0.5: "p50", 0.75: "p75"})
    out = base.join(bounded_broadcast(qw, len(features)), "feature", "left")
    return out.select(
        "feature", F.col("count").cast("long").alias("count"),
        *[F.round(c, ROUND).alias(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]],
    )


def _wide_quantiles(df: DataFrame, features: Sequence[str], names: dict[float, str]) -> DataFrame:
    """Exact quantiles of all rows, a column each: ``feature`` and ``names``."""
    q = exact_quantiles(df, list(features), list(names))
    return q.groupBy("feature").agg(*(F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in names.items()))


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4: rows beyond the first copy of each distinct row, count and percent.

    ``groupBy(all columns)`` is partially aggregated map-side, so one hot row
    repeated a billion times is one row per task before the shuffle.
    """
    g = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(
        F.sum(F.col("_c") - 1).cast("long").alias("duplicate_rows"),
        F.sum("_c").cast("long").alias("rows"),
    ).select(
        "duplicate_rows", "rows",
        F.round(F.col("duplicate_rows") / F.col("rows") * 100.0, ROUND).alias("duplicate_pct"),
    )


def duplicates_by_class(df: DataFrame, columns: Sequence[str], target: str = "Class") -> DataFrame:
    """A5: rows inside any duplicate group (keep=False) vs not, per class."""
    cols = list(columns) if target in columns else [*columns, target]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.groupBy((F.col("_c") > 1).alias("in_duplicate_group"), F.col(target)).agg(
        F.sum("_c").cast("long").alias("rows")
    )


def class_balance(df: DataFrame, target: str = "Class") -> DataFrame:
    """Rows and percent per class (the percent window runs over #classes rows)."""
    per = df.groupBy(target).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return per.select(target, F.col("rows").cast("long").alias("rows"),
                      F.round(F.col("rows") / total * 100.0, ROUND).alias("pct"))


def imbalance_ratio(df: DataFrame, target: str = "Class") -> DataFrame:
    """``floor(n_neg / n_pos)`` (integer division, NULL without positives)."""
    y = F.col(target).cast("long")
    a = df.agg(F.sum(1 - y).cast("long").alias("n_neg"), F.sum(y).cast("long").alias("n_pos"))
    return a.select("n_neg", "n_pos", F.floor(F.try_divide(F.col("n_neg"), F.col("n_pos"))).cast("long").alias("ratio"))


def time_range(df: DataFrame, time_col: str = "Time") -> DataFrame:
    """min/max of the seconds column, also in hours and days."""
    a = df.agg(F.min(time_col).alias("min_s"), F.max(time_col).alias("max_s"))
    return a.select(
        F.round("min_s", ROUND).alias("min_s"), F.round("max_s", ROUND).alias("max_s"),
        F.round(F.col("max_s") / 3600.0, ROUND).alias("max_hours"),
        F.round(F.col("max_s") / 86400.0, ROUND).alias("max_days"),
        F.round((F.col("max_s") - F.col("min_s")) / 3600.0, ROUND).alias("span_hours"),
    )


def amount_by_class(df: DataFrame, amount: str = "Amount", target: str = "Class") -> DataFrame:
    """mean/median/max of Amount per class and overall (``Class`` NULL = overall)."""
    base = df.rollup(target).agg(
        F.avg(amount).alias("mean"), F.max(amount).alias("max"), F.count(amount).alias("n"),
        F.grouping(target).alias("_g"),
    )
    med = exact_quantiles(df, [amount], [0.5], by=target).select(F.col("grp").alias("_k"), F.col("q").alias("median"))
    of = F.col(target).cast("string")
    key = F.when(F.col("_g") == 1, F.lit(ALL)).when(of.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), of))
    out = base.withColumn("_k", key).join(med, "_k", "left")  # one row per class: AQE broadcasts it
    return out.select(
        F.when(F.col("_g") == 0, F.col(target)).alias(target),
        F.round("mean", ROUND).alias("mean"), F.round("median", ROUND).alias("median"),
        F.round("max", ROUND).alias("max"),
    )


def histogram(lf: DataFrame, bins: int | dict, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Equal-width bins over each key's own [min, max]; last bin right-closed.

    ``lf`` is long form with ``value``. ``bins`` is a count or ``{feature: count}``.
    Emits every bin (zeros included) with ``lo``, ``hi``, ``count`` and ``density``
    (``count / (N * width)``). A constant key spreads [v-0.5, v+0.5] like NumPy.
    """
    keys = list(keys)
    if isinstance(bins, dict):
        nb = F.coalesce(F.element_at(F.create_map(*[x for k, v in bins.items() for x in (F.lit(k), F.lit(v))]),
                                     F.col("feature")), F.lit(10))
    else:
        nb = F.lit(int(bins))
    stats = lf.where(F.col("value").isNotNull()).groupBy(*keys).agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count(F.lit(1)).alias("_N")
    ).withColumn("_nb", nb)
    stats = stats.withColumns({
        "_lo": F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")),
        "_hi": F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")),
    })
    # one row per key (features x classes): written once, counted, and broadcast by its count,
    # so the long form is never shuffled by its few hot keys
    stats = cut(stats, "histogram-ranges")
    j = lf.where(F.col("value").isNotNull()).join(bounded_broadcast(stats, stats.count()), keys)
    width = (F.col("_hi") - F.col("_lo")) / F.col("_nb")
    b = F.least(F.floor((F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.col("_nb")),
                F.col("_nb") - 1).cast("int")
    counts = j.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = stats.select(*keys, "_lo", "_hi", "_nb", "_N", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("bin"))
    out = grid.join(counts, [*keys, "bin"], "left").fillna(0, ["count"])
    return out.select(
        *keys, "bin",
        F.round(F.col("_lo") + F.col("bin") * width, ROUND).alias("lo"),
        F.round(F.col("_lo") + (F.col("bin") + 1) * width, ROUND).alias("hi"),
        F.col("count").cast("long").alias("count"),
        F.round(F.col("count") / (F.col("_N") * width), ROUND).alias("density"),
    )


def _number(v: float) -> float | None:
    return None if np.isnan(v) else float(v)


def corr_with_target(df: DataFrame, features: Sequence[str], target: str = "Class") -> DataFrame:
    """``(feature, corr, rank)``; ``rank`` orders by corr ascending (a #features-row window).
    NULL when a side is constant; a pair counts the rows that have both."""
    r = cross_moments(df, features, [target]).correlation()[:, 0]
    c = df.sparkSession.createDataFrame([(f, _number(v)) for f, v in zip(features, r)], "feature string, corr double")
    c = c.select("feature", F.round("corr", ROUND).alias("corr"))
    return c.withColumn("rank", F.row_number().over(Window.orderBy(F.col("corr").asc_nulls_last(), "feature")).cast("long"))


def corr_top(df: DataFrame, features: Sequence[str], target: str = "Class", k: int = 15) -> DataFrame:
    """The ``k`` features with the largest |corr| (top-k is the feature here)."""
    c = corr_with_target(df, features, target).drop("rank")
    return c.orderBy(F.abs("corr").desc_nulls_last(), "feature").limit(k)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strict lower triangle ``(row_feature, col_feature, corr)`` from one scan."""
    cols = list(columns)
    r = cross_moments(df, cols, cols).correlation()
    rows = [(cols[i], cols[j], _number(r[i, j])) for i in range(len(cols)) for j in range(i)]
    return df.sparkSession.createDataFrame(rows, "row_feature string, col_feature string, corr double").withColumn(
        "corr", F.round("corr", ROUND))


def iqr_outliers(df: DataFrame, features: Sequence[str], k: float = 10.0) -> DataFrame:
    """Count of ``x > Q3 + k * IQR`` (upper side) per feature; features with > 0 only."""
    q = _wide_quantiles(df, features, {0.25: "q1", 0.75: "q3"}).select(
        "feature", (F.col("q3") + F.lit(float(k)) * (F.col("q3") - F.col("q1"))).alias("upper"))
    upper = {r["feature"]: r["upper"] for r in q.collect()}  # one row a feature
    over = [c for c in features if c in upper]
    if not over:
        return df.sparkSession.createDataFrame([], "feature string, outliers long, upper double")
    counts = df.agg(*(F.sum((F.col(c).cast("double") > F.lit(upper[c])).cast("long")).alias(f"n{i}") for i, c in enumerate(over)))
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("outliers"), F.round(F.lit(upper[c]), ROUND).alias("upper"))
                     for i, c in enumerate(over)))
    return counts.select(F.explode(rows).alias("r")).select("r.*").where(F.col("outliers") > 0)


def class_comparison(df: DataFrame, features: Sequence[str], target: str = "Class") -> DataFrame:
    """Per feature mean/sample std for class 0 and 1, and ``mean_diff`` = mean_1 - mean_0."""
    inside = {f"\x01class{k}": F.when(F.col(target) == k, F.lit(1.0)) for k in (0, 1)}  # present in its class only
    m = cross_moments(df.withColumns(inside), list(features), list(inside))
    std = m.sample_std_a()
    rows = [(f, *map(_number, (m.mean_a[i, 0], m.mean_a[i, 1], std[i, 0], std[i, 1]))) for i, f in enumerate(features)]
    c = df.sparkSession.createDataFrame(rows, "feature string, mean_0 double, mean_1 double, std_0 double, std_1 double")
    out = c.select(
        "feature", *[F.round(x, ROUND).alias(x) for x in ["mean_0", "mean_1", "std_0", "std_1"]],
        F.round(F.col("mean_1") - F.col("mean_0"), ROUND).alias("mean_diff"),
    )
    return rank_by_abs(out, "mean_diff")  # O3: by |mean_diff| descending


def rank_by_abs(df: DataFrame, col: str, name: str = "rank") -> DataFrame:
    """O1/O3: rank a per-feature table by |col| desc (a #features-row window)."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(F.abs(col).desc_nulls_last(), "feature")).cast("long"))
