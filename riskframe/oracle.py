"""DuckDB SQL twins of the deterministic registered queries (same names, same columns).

Written as plain single-node SQL (global windows, exact ``quantile_cont``) on the
driver's pre-registered tables: an independent statement of each result.
"""

from __future__ import annotations

import math

from riskframe.functions.hashing import sql_hash_normal, sql_hash_uniform
from riskframe.operators.ensemble import weight_grid
from riskframe.operators.score import heuristic_sql
from riskframe.registry import (
    FEATURE_DIGITS, HEURISTIC_THRESHOLD, HIST_BINS, HIST_CLASS_BINS, HIST_LOG_BINS, LINE_CATEGORICAL,
    LINE_NUMERIC, METRIC_THRESHOLD, PERTURB_DIGITS, SCORE_THRESHOLD, SEED,
)
from riskframe.sources.tables import SQL_VIEWS, TXN_FEATURES

D9 = FEATURE_DIGITS
TWO_PI = "(2 * pi())"


def _views(*names: str) -> str:
    return ", ".join(f"{v} AS ({SQL_VIEWS[v]})" for v in names)


def _split(view: str, out: str, stratify: bool = True, seed: int = SEED) -> str:
    part = "PARTITION BY Class" if stratify else ""
    return (
        f"{out}_r AS (SELECT *, row_number() OVER ({part} ORDER BY md5(CAST(txn_id AS VARCHAR) || '|{seed}'), txn_id) AS _rank, "
        f"count(*) OVER ({part}) AS _n FROM {view}), "
        f"{out}_t AS (SELECT *, round(CAST(0.2 AS DOUBLE) * _n) AS _nt FROM {out}_r), "
        f"{out} AS (SELECT * EXCLUDE (_rank, _n, _nt), CASE WHEN _rank <= _nt THEN 'test' "
        f"WHEN _rank <= _nt + round(CAST(0.2 AS DOUBLE) * (_n - _nt)) THEN 'val' ELSE 'train' END AS split FROM {out}_t)"
    )


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def _pmod(x: str, n: float) -> str:
    return f"((({x}) % {n!r}) + {n!r}) % {n!r}"


def _angle(time_col: str = "\"Time\"") -> str:
    return f"({TWO_PI} * ({_pmod(time_col, 86400.0)} / 3600.0) / 24.0)"


def _d(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


Q: dict[str, str] = {}

# ---------------------------------------------------------------- P

Q["p_validate_quarantine"] = (
    _with(_views("txn_lines"),
          "sd AS (SELECT stddev_samp(Discount) AS s FROM txn_lines)",
          f"x AS (SELECT \"Time\", Quantity, CASE WHEN {sql_hash_uniform('txn_id', SEED, 'Amount')} < 0.05 THEN NULL ELSE Amount END AS Amount, "
          "Discount + (-1.0) * s AS Discount, Tax FROM txn_lines, sd)",
          "r AS (SELECT list_filter([CASE WHEN \"Time\" IS NULL THEN 'missing:Time' END, CASE WHEN Quantity IS NULL THEN 'missing:Quantity' END, "
          "CASE WHEN Amount IS NULL THEN 'missing:Amount' END, CASE WHEN Discount IS NULL THEN 'missing:Discount' END, "
          "CASE WHEN Tax IS NULL THEN 'missing:Tax' END, CASE WHEN Amount < 0 THEN 'negative:Amount' END, "
          "CASE WHEN Discount < 0 THEN 'negative:Discount' END], lambda e: e IS NOT NULL) AS reasons FROM x)")
    + "SELECT reason, CAST(count(*) AS BIGINT) AS rows FROM (SELECT unnest(reasons) AS reason FROM r) GROUP BY reason "
    "UNION ALL SELECT 'valid' AS reason, CAST(count(*) AS BIGINT) AS rows FROM r WHERE len(reasons) = 0"
)

Q["p_head"] = _with(_views("txn_lines")) + "SELECT * FROM txn_lines ORDER BY txn_id LIMIT 5"
Q["p_class_filter"] = _with(_views("txn_lines")) + (
    "SELECT txn_id, Amount, Quantity FROM txn_lines WHERE Class = 1"
)
Q["p_numeric_select"] = _with(_views("txn_lines")) + "SELECT txn_id, \"Time\", Quantity, Amount, Discount, Tax FROM txn_lines"

# ---------------------------------------------------------------- T

Q["t_split_assign"] = _with(_views("txn_lines"), _split("txn_lines", "s")) + "SELECT txn_id, Class, split FROM s"
Q["t_split_summary"] = _with(_views("txn_lines"), _split("txn_lines", "s")) + (
    "SELECT split, CAST(count(*) AS BIGINT) AS rows, CAST(sum(Class) AS BIGINT) AS positives, "
    "round(CAST(sum(Class) AS DOUBLE) / count(*) * 100.0, 6) AS positive_pct FROM s GROUP BY split"
)
Q["t_split_unstratified"] = _with(_views("txn_events"), _split("txn_events", "s", stratify=False)) + \
    "SELECT txn_id, Class, split FROM s"
Q["t_kfold_assign"] = _with(_views("txn_events"), (
    f"r AS (SELECT txn_id, Class, row_number() OVER (PARTITION BY Class ORDER BY md5(CAST(txn_id AS VARCHAR) || '|{SEED}'), txn_id) AS k, "
    "count(*) OVER (PARTITION BY Class) AS n FROM txn_events)")) + (
    "SELECT txn_id, Class, CAST((k > n // 5)::INT + (k > n * 2 // 5)::INT + (k > n * 3 // 5)::INT + (k > n * 4 // 5)::INT AS INTEGER) AS fold FROM r"
)

# ---------------------------------------------------------------- F

Q["f_time_cyclical"] = _with(_views("txn_events")) + (
    f"SELECT txn_id, round(sin({_angle()}), {D9}) AS hour_sin, round(cos({_angle()}), {D9}) AS hour_cos FROM txn_events"
)
Q["f_amount_log"] = _with(_views("txn_events")) + f"SELECT txn_id, round(ln(1 + Amount), {D9}) AS Amount FROM txn_events"
Q["f_amount_standardized"] = _with(
    _views("txn_events"), _split("txn_events", "s"),
    "st AS (SELECT avg(ln(1 + Amount)) AS m, CASE WHEN stddev_pop(ln(1 + Amount)) > 0 THEN stddev_pop(ln(1 + Amount)) ELSE 1.0 END AS sd "
    "FROM s WHERE split = 'train')",
) + f"SELECT txn_id, split, round((ln(1 + Amount) - m) / sd, {D9}) AS Amount FROM s, st"

_PAIRS = [("V14", "V17"), ("V12", "V14"), ("V10", "V17"), ("V4", "V11")]
Q["f_interactions"] = _with(_views("txn")) + "SELECT txn_id, " + ", ".join(
    f"round({a} * {b}, {D9}) AS {a}_x_{b}" for a, b in _PAIRS) + " FROM txn"


def _full_features_cte(name: str = "ff") -> str:
    vs = ", ".join(f"V{i}" for i in range(1, 29))
    inter = ", ".join(f"{a} * {b} AS {a}_x_{b}" for a, b in _PAIRS)
    return (
        _split("txn", "s") + ", "
        "st AS (SELECT avg(ln(1 + Amount)) AS m, CASE WHEN stddev_pop(ln(1 + Amount)) > 0 THEN stddev_pop(ln(1 + Amount)) ELSE 1.0 END AS sd "
        "FROM s WHERE split = 'train'), "
        f"{name} AS (SELECT txn_id, Class, split, {vs}, (ln(1 + Amount) - m) / sd AS Amount, "
        f"sin({_angle()}) AS hour_sin, cos({_angle()}) AS hour_cos, {inter} FROM s, st)"
    )


FULL_FEATURES = [f"V{i}" for i in range(1, 29)] + ["Amount", "hour_sin", "hour_cos"] + [f"{a}_x_{b}" for a, b in _PAIRS]
Q["f_full_features"] = _with(_views("txn"), _full_features_cte()) + "SELECT txn_id, Class, split, " + ", ".join(
    f"round({c}, {D9}) AS {c}" for c in FULL_FEATURES) + " FROM ff"

# ---------------------------------------------------------------- A

_LINE_COLS = [("txn_id", "string"), ("Time", "double"), ("Quantity", "double"), ("Amount", "double"),
              ("Discount", "double"), ("Tax", "double"), ("ReturnFlag", "string"), ("LineStatus", "string"),
              ("Class", "int")]
Q["a_shape"] = _with(_views("txn_lines")) + " UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS dtype, CAST(count(\"{c}\") AS BIGINT) AS non_null, CAST(count(*) AS BIGINT) AS rows, "
    f"{len(_LINE_COLS)} AS columns FROM txn_lines" for c, t in _LINE_COLS)


def _describe_one(c: str) -> str:
    return (
        f"SELECT '{c}' AS feature, CAST(count(\"{c}\") AS BIGINT) AS count, round(avg(\"{c}\"), 6) AS mean, "
        f"round(stddev_samp(\"{c}\"), 6) AS std, round(min(\"{c}\"), 6) AS min, "
        f"round(quantile_cont(\"{c}\", 0.25), 6) AS p25, round(quantile_cont(\"{c}\", 0.5), 6) AS p50, "
        f"round(quantile_cont(\"{c}\", 0.75), 6) AS p75, round(max(\"{c}\"), 6) AS max FROM txn_lines"
    )


Q["a_describe"] = _with(_views("txn_lines")) + " UNION ALL ".join(_describe_one(c) for c in LINE_NUMERIC)


def _missing_one(c: str, t: str) -> str:
    cond = f"\"{c}\" IS NULL" + (f" OR isnan(\"{c}\")" if t == "double" else "")
    return f"SELECT '{c}' AS column, CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM txn_lines"


Q["a_missing"] = _with(_views("txn_lines"), "m AS (" + " UNION ALL ".join(_missing_one(c, t) for c, t in _LINE_COLS) + ")") + (
    "SELECT \"column\", missing FROM m UNION ALL SELECT '__total__' AS \"column\", CAST(sum(missing) AS BIGINT) AS missing FROM m"
)
_DUP = "Quantity, Amount, Discount, Tax, ReturnFlag, LineStatus, Class"
Q["a_duplicates"] = _with(_views("txn_lines"), f"g AS (SELECT count(*) AS c FROM txn_lines GROUP BY {_DUP})") + (
    "SELECT CAST(sum(c - 1) AS BIGINT) AS duplicate_rows, CAST(sum(c) AS BIGINT) AS rows, "
    "round(CAST(sum(c - 1) AS DOUBLE) / sum(c) * 100.0, 6) AS duplicate_pct FROM g"
)
Q["a_duplicates_by_class"] = _with(_views("txn_lines"), f"g AS (SELECT Class, count(*) AS c FROM txn_lines GROUP BY {_DUP})") + (
    "SELECT c > 1 AS in_duplicate_group, Class, CAST(sum(c) AS BIGINT) AS rows FROM g GROUP BY c > 1, Class"
)
Q["a_class_balance"] = _with(_views("txn_lines")) + (
    "SELECT Class, CAST(count(*) AS BIGINT) AS rows, round(count(*) / sum(count(*)) OVER () * 100.0, 6) AS pct "
    "FROM txn_lines GROUP BY Class"
)
Q["a_imbalance_ratio"] = _with(_views("txn_lines")) + (
    "SELECT CAST(sum(1 - Class) AS BIGINT) AS n_neg, CAST(sum(Class) AS BIGINT) AS n_pos, "
    "CAST(floor(sum(1 - Class) / nullif(sum(Class), 0)) AS BIGINT) AS ratio FROM txn_lines"
)
Q["a_time_range"] = _with(_views("txn_lines")) + (
    "SELECT round(min(\"Time\"), 6) AS min_s, round(max(\"Time\"), 6) AS max_s, round(max(\"Time\") / 3600.0, 6) AS max_hours, "
    "round(max(\"Time\") / 86400.0, 6) AS max_days, round((max(\"Time\") - min(\"Time\")) / 3600.0, 6) AS span_hours FROM txn_lines"
)
Q["a_amount_by_class"] = _with(_views("txn_lines")) + (
    "SELECT Class, round(avg(Amount), 6) AS mean, round(quantile_cont(Amount, 0.5), 6) AS median, round(max(Amount), 6) AS max "
    "FROM txn_lines GROUP BY Class UNION ALL SELECT NULL AS Class, round(avg(Amount), 6), round(quantile_cont(Amount, 0.5), 6), "
    "round(max(Amount), 6) FROM txn_lines"
)


def _hist_sql(long_cte: str, bins_expr: str, keys: list[str]) -> str:
    """Histogram over long form ``lf(keys..., value)`` with ``nb`` bins per key."""
    k = ", ".join(keys)
    on = " AND ".join(f"g.{x} IS NOT DISTINCT FROM c.{x}" for x in keys)
    return (
        f"lf AS ({long_cte}), "
        f"st0 AS (SELECT {k}, min(value) AS lo0, max(value) AS hi0, count(*) AS n, {bins_expr} AS nb FROM lf WHERE value IS NOT NULL GROUP BY {k}), "
        f"st AS (SELECT {k}, n, nb, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM st0), "
        f"c AS (SELECT {', '.join('lf.' + x for x in keys)}, CAST(least(floor((value - lo) / (hi - lo) * nb), nb - 1) AS INTEGER) AS bin, count(*) AS cnt "
        f"FROM lf JOIN st USING ({k}) WHERE value IS NOT NULL GROUP BY ALL), "
        f"g AS (SELECT {k}, lo, hi, nb, n, CAST(unnest(range(0, nb)) AS INTEGER) AS bin FROM st) "
        f"SELECT {', '.join('g.' + x + ' AS ' + x for x in keys)}, g.bin AS bin, round(g.lo + g.bin * ((g.hi - g.lo) / g.nb), 6) AS lo, "
        f"round(g.lo + (g.bin + 1) * ((g.hi - g.lo) / g.nb), 6) AS hi, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count, "
        f"round(coalesce(c.cnt, 0) / (g.n * ((g.hi - g.lo) / g.nb)), 6) AS density "
        f"FROM g LEFT JOIN c ON {on} AND g.bin = c.bin"
    )


Q["a_hist"] = _with(_views("txn_lines"), _hist_sql("SELECT 'Time' AS feature, \"Time\" AS value FROM txn_lines", str(HIST_BINS), ["feature"]))
Q["a_hist_log_amount"] = _with(_views("txn_lines"), _hist_sql(
    "SELECT 'log_amount' AS feature, ln(1 + Amount) AS value FROM txn_lines", str(HIST_LOG_BINS), ["feature"]))
_class_long = " UNION ALL ".join(
    f"SELECT Class, '{f}' AS feature, CAST({'ln(1 + Amount)' if f == 'log_amount' else chr(34) + f + chr(34)} AS DOUBLE) AS value FROM txn_lines"
    for f in HIST_CLASS_BINS)
_class_bins = "CASE feature " + " ".join(f"WHEN '{f}' THEN {n}" for f, n in HIST_CLASS_BINS.items()) + " ELSE 10 END"
Q["a_hist_by_class"] = _with(_views("txn_lines"), _hist_sql(_class_long, _class_bins, ["feature", "Class"]))


def _corr(a: str, b: str) -> str:
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"


_corr_rows = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round({_corr(chr(34) + c + chr(34), 'CAST(Class AS DOUBLE)')}, 6) AS corr FROM txn_lines" for c in LINE_NUMERIC)
Q["a_corr_target"] = _with(_views("txn_lines"), f"c AS ({_corr_rows})") + \
    "SELECT feature, corr, row_number() OVER (ORDER BY corr ASC NULLS LAST, feature) AS rank FROM c"
Q["a_corr_top15"] = _with(_views("txn_lines"), f"c AS ({_corr_rows})") + \
    "SELECT feature, corr FROM c ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 15"
_mcols = LINE_NUMERIC + ["Class"]
Q["a_corr_matrix"] = _with(_views("txn_lines")) + " UNION ALL ".join(
    f"SELECT '{_mcols[i]}' AS row_feature, '{_mcols[j]}' AS col_feature, "
    f"round({_corr('CAST(' + chr(34) + _mcols[i] + chr(34) + ' AS DOUBLE)', 'CAST(' + chr(34) + _mcols[j] + chr(34) + ' AS DOUBLE)')}, 6) AS corr FROM txn_lines"
    for i in range(len(_mcols)) for j in range(i))
Q["a_iqr_outliers"] = _with(_views("txn"), "x AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS value FROM txn" for c in TXN_FEATURES) + ")",
    "q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM x GROUP BY feature)") + (
    "SELECT feature, CAST(sum(CASE WHEN value > q3 + 10.0 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS outliers, "
    "round(max(q3 + 10.0 * (q3 - q1)), 6) AS upper FROM x JOIN q USING (feature) GROUP BY feature "
    "HAVING sum(CASE WHEN value > q3 + 10.0 * (q3 - q1) THEN 1 ELSE 0 END) > 0"
)
Q["a_class_comparison"] = _with(_views("txn_lines")) + "SELECT *, row_number() OVER (ORDER BY abs(mean_diff) DESC NULLS LAST, feature) AS rank FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(CASE WHEN Class = 0 THEN \"{c}\" END), 6) AS mean_0, "
    f"round(avg(CASE WHEN Class = 1 THEN \"{c}\" END), 6) AS mean_1, round(stddev_samp(CASE WHEN Class = 0 THEN \"{c}\" END), 6) AS std_0, "
    f"round(stddev_samp(CASE WHEN Class = 1 THEN \"{c}\" END), 6) AS std_1, "
    f"round(avg(CASE WHEN Class = 1 THEN \"{c}\" END) - avg(CASE WHEN Class = 0 THEN \"{c}\" END), 6) AS mean_diff FROM txn_lines"
    for c in LINE_NUMERIC) + ")"

# ---------------------------------------------------------------- M (txn_events, per split)

_CURVE = (
    "c0 AS (SELECT split, score, CAST(sum(Class) AS BIGINT) AS tp, CAST(sum(1 - Class) AS BIGINT) AS fp FROM s GROUP BY split, score), "
    "c AS (SELECT *, sum(tp) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ctp, "
    "sum(fp) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cfp, "
    "sum(tp) OVER (PARTITION BY split) AS P FROM c0)"
)
_EV = _with(_views("txn_events"), _split("txn_events", "s"))
_EVC = _with(_views("txn_events"), _split("txn_events", "s"), _CURVE)
_t = METRIC_THRESHOLD
Q["m_confusion"] = _EV + (
    f"SELECT split, actual, predicted, CAST(sum(n) AS BIGINT) AS count FROM ("
    f"SELECT split, a.actual, a.predicted, CASE WHEN Class = a.actual AND CAST(score >= {_t} AS INTEGER) = a.predicted THEN 1 ELSE 0 END AS n "
    f"FROM s, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) a(actual, predicted)) GROUP BY split, actual, predicted"
)


def _thr_metrics(src: str, keys: str, t: float) -> str:
    return (
        f"SELECT {keys}, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 6) AS precision, "
        f"round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), 6) AS recall, "
        f"round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0), 6) AS f1, CAST({t!r} AS DOUBLE) AS threshold FROM ("
        f"SELECT {keys}, sum(CASE WHEN Class = 1 AND score >= {t!r} THEN 1 ELSE 0 END) AS tp, "
        f"sum(CASE WHEN Class = 0 AND score >= {t!r} THEN 1 ELSE 0 END) AS fp, "
        f"sum(CASE WHEN Class = 1 AND score < {t!r} THEN 1 ELSE 0 END) AS fn FROM {src} GROUP BY {keys})"
    )


Q["m_threshold_metrics"] = _EV + _thr_metrics("s", "split", _t)
_AP = "round(sum(tp * CAST(ctp AS DOUBLE) / (ctp + cfp)) / nullif(sum(tp), 0), 6)"
_AUC = "round(CAST(sum(fp * (2 * ctp - tp)) AS DOUBLE) / nullif(2.0 * sum(tp) * sum(fp), 0), 6)"
Q["m_average_precision"] = _EVC + f"SELECT split, {_AP} AS pr_auc FROM c GROUP BY split"
Q["m_roc_auc"] = _EVC + f"SELECT split, {_AUC} AS roc_auc FROM c GROUP BY split"
Q["m_pr_curve"] = _EVC + (
    "SELECT split, score AS threshold, round(CAST(ctp AS DOUBLE) / (ctp + cfp), 6) AS precision, "
    "round(coalesce(CAST(ctp AS DOUBLE) / nullif(P, 0), 1.0), 6) AS recall FROM c"
)
Q["m_best_threshold"] = _EVC + (
    "SELECT split, CASE WHEN P > 0 THEN score END AS best_threshold, CASE WHEN P > 0 THEN round(f1, 6) END AS best_f1 FROM ("
    "SELECT *, row_number() OVER (PARTITION BY split ORDER BY f1 DESC, score ASC) AS rn FROM ("
    "SELECT split, score, P, coalesce(CAST(2 * ctp AS DOUBLE) / nullif(CAST(ctp + cfp + P AS DOUBLE), 0), 0.0) AS f1 FROM c)) WHERE rn = 1"
)
Q["m_class_weight"] = _with(_views("txn_lines")) + (
    "SELECT CAST(sum(1 - Class) AS BIGINT) AS n_neg, CAST(sum(Class) AS BIGINT) AS n_pos, "
    "round(CAST(sum(1 - Class) AS DOUBLE) / nullif(sum(Class), 0), 6) AS class_weight FROM txn_lines"
)
_HEUR_LONG = " UNION ALL ".join(
    f"SELECT '{n}' AS model_name, txn_id, Class, {heuristic_sql(n)} AS score FROM s WHERE split = 'test'"
    for n in ["r3", "r3_b", "r3_c"])
_HT = HEURISTIC_THRESHOLD
Q["m_leaderboard"] = _with(
    _views("txn"), _split("txn", "s"), f"h AS ({_HEUR_LONG})",
    "c0 AS (SELECT model_name, score, CAST(sum(Class) AS BIGINT) AS tp, CAST(sum(1 - Class) AS BIGINT) AS fp FROM h GROUP BY model_name, score)",
    "c AS (SELECT *, sum(tp) OVER (PARTITION BY model_name ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ctp, "
    "sum(fp) OVER (PARTITION BY model_name ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cfp FROM c0)",
    f"r AS (SELECT model_name, {_AP} AS pr_auc, {_AUC} AS roc_auc FROM c GROUP BY model_name)",
    f"t AS ({_thr_metrics('h', 'model_name', _HT)})",
) + (
    "SELECT r.model_name, pr_auc, roc_auc, f1, precision, recall, "
    "row_number() OVER (ORDER BY pr_auc DESC NULLS LAST, r.model_name) AS rank FROM r JOIN t USING (model_name)"
)

# ---------------------------------------------------------------- R

Q["r_score_batch"] = _with(_views("txn")) + (
    f"SELECT txn_id, {heuristic_sql('r3')} >= {SCORE_THRESHOLD!r} AS is_fraud, round({heuristic_sql('r3')}, 6) AS fraud_probability, "
    f"CAST({SCORE_THRESHOLD!r} AS DOUBLE) AS threshold, 'heuristic' AS model_name, '0.1.0' AS model_version FROM txn "
    "WHERE " + " AND ".join(f"\"{c}\" IS NOT NULL AND NOT isnan(\"{c}\")" for c in TXN_FEATURES) + " AND Amount >= 0"
)

# ---------------------------------------------------------------- D (txn_lines train vs test)


def _ks_p(d: str, n: str, m: str) -> str:
    """KS asymptotic p-value as a correlated scalar over range(1, 101)."""
    en = f"sqrt(CAST({n} AS DOUBLE) * {m} / ({n} + {m}))"
    lam = f"(({en} + 0.12 + 0.11 / {en}) * {d})"
    big = f"(2.0 * (SELECT sum(CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * j * j * {lam} * {lam})) FROM range(1, 101) t(j)))"
    small = (f"(1.0 - {math.sqrt(2 * math.pi)!r} / {lam} * (SELECT sum(exp(-((2 * j - 1) * (2 * j - 1)) * {math.pi ** 2!r} / (8.0 * {lam} * {lam}))) "
             f"FROM range(1, 101) t(j)))")
    return f"least(greatest(CASE WHEN {lam} <= 0 THEN 1.0 WHEN {lam} < 1.0 THEN {small} ELSE {big} END, 0.0), 1.0)"


def _numeric_drift_sql(ref: str, cur: str, features: list[str]) -> str:
    """CTE chain ending in ``nd(feature, ks_d, p, w1, sd, n_ref, n_cur)``."""
    lf = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS value, {side} AS side FROM {src}"
        for c in features for src, side in ((ref, 0), (cur, 1)))
    return (
        f"lf AS (SELECT * FROM ({lf}) WHERE value IS NOT NULL), "
        "cnt AS (SELECT feature, value, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS r, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS cc FROM lf GROUP BY feature, value), "
        "cum AS (SELECT feature, value, lead(value) OVER (PARTITION BY feature ORDER BY value) AS nv, "
        "sum(r) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) / sum(r) OVER (PARTITION BY feature) AS F, "
        "sum(cc) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) / sum(cc) OVER (PARTITION BY feature) AS G, "
        "sum(r) OVER (PARTITION BY feature) AS nr, sum(cc) OVER (PARTITION BY feature) AS nc FROM cnt), "
        "sds AS (SELECT feature, stddev_pop(value) AS sd FROM lf WHERE side = 0 GROUP BY feature), "
        "nd0 AS (SELECT feature, max(abs(F - G)) AS ks_d, sum(abs(F - G) * coalesce(nv - value, 0.0)) AS w1, "
        "CAST(max(nr) AS BIGINT) AS n_ref, CAST(max(nc) AS BIGINT) AS n_cur FROM cum GROUP BY feature), "
        f"nd AS (SELECT nd0.*, sd, {_ks_p('ks_d', 'n_ref', 'n_cur')} AS p FROM nd0 LEFT JOIN sds USING (feature))"
    )


_ND = _numeric_drift_sql("ref", "cur", LINE_NUMERIC)


def _chain(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


_RC_PARTS = [_views("txn_lines"), _split("txn_lines", "s"), "ref AS (SELECT * FROM s WHERE split = 'train')",
             "cur AS (SELECT * FROM s WHERE split = 'test')"]
Q["d_ks"] = _chain(*_RC_PARTS, _ND) + "SELECT feature, round(ks_d, 6) AS ks_d, round(p, 6) AS p_value, p < 0.05 AS drift FROM nd"
Q["d_wasserstein"] = _chain(*_RC_PARTS, _ND) + "SELECT feature, round(w1, 6) AS w1, round(w1 / nullif(sd, 0), 6) AS w1_norm FROM nd"
_psi_lf = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS value, {side} AS side FROM {src}"
    for c in LINE_NUMERIC for src, side in (("ref", 0), ("cur", 1)))
Q["d_psi"] = _chain(
    *_RC_PARTS, f"lf AS (SELECT * FROM ({_psi_lf}) WHERE value IS NOT NULL)",
    "rg AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM lf WHERE side = 0 GROUP BY feature)",
    "b AS (SELECT feature, side, CASE WHEN hi - lo <= 0 THEN 0 ELSE CAST(least(greatest(floor((value - lo) / (hi - lo) * 10), 0), 9) AS INTEGER) END AS bin FROM lf JOIN rg USING (feature))",
    "cnt AS (SELECT feature, bin, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS r, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c FROM b GROUP BY feature, bin)",
    "tot AS (SELECT feature, sum(r) AS nr, sum(c) AS nc FROM cnt GROUP BY feature)",
    "g AS (SELECT feature, nr, nc, unnest(range(0, 10)) AS bin FROM tot)",
    "f AS (SELECT g.feature, greatest(coalesce(cnt.r, 0) / g.nr, 0.0001) AS pr, greatest(coalesce(cnt.c, 0) / g.nc, 0.0001) AS pc "
    "FROM g LEFT JOIN cnt ON g.feature = cnt.feature AND g.bin = cnt.bin)",
) + "SELECT feature, round(sum((pc - pr) * ln(pc / pr)), 6) AS psi FROM f GROUP BY feature"


def _chi_sql(ref: str, cur: str, features: list[str]) -> str:
    lf = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(\"{c}\" AS VARCHAR) AS value, {side} AS side FROM {src}"
        for c in features for src, side in ((ref, 0), (cur, 1)))
    return (
        f"clf AS (SELECT * FROM ({lf}) WHERE value IS NOT NULL), "
        "ccnt AS (SELECT feature, value, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS r, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c FROM clf GROUP BY feature, value), "
        "ctot AS (SELECT feature, sum(r) AS nr, sum(c) AS nc, count(*) AS k FROM ccnt GROUP BY feature), "
        "cs AS (SELECT feature, sum(power(r - (r + c) * nr / (nr + nc), 2) / ((r + c) * nr / (nr + nc)) + "
        "power(c - (r + c) * nc / (nr + nc), 2) / ((r + c) * nc / (nr + nc))) AS statistic, CAST(max(k) - 1 AS BIGINT) AS dof "
        "FROM ccnt JOIN ctot USING (feature) GROUP BY feature)"
    )


Q["d_chi_square"] = _chain(*_RC_PARTS, _chi_sql("ref", "cur", LINE_CATEGORICAL)) + \
    "SELECT feature, round(statistic, 6) AS statistic, dof FROM cs"


_CHI_SF = ("(CASE WHEN dof <= 0 OR statistic <= 0 THEN 1.0 ELSE 1.0 - list_sum(list_transform(range(0, 4000), lambda i: "
           "exp((dof / 2 + i) * ln(statistic / 2) - statistic / 2 - lgamma(dof / 2 + i + 1)))) END)")


def _summary_sql(num_detail: str, cat_detail: str | None, total: int, ref: str, cur: str, stage: str | None = None) -> str:
    det = num_detail + (f" UNION ALL {cat_detail}" if cat_detail else "")
    stage_col = f", '{stage}' AS stage" if stage else ""
    return (
        f"SELECT (count(*) FILTER (WHERE drift) / {float(total)!r}) > 0 AS dataset_drift_detected, "
        "coalesce(string_agg(CASE WHEN drift THEN feature END, ',' ORDER BY CASE WHEN drift THEN feature END), '') AS drifted_features, "
        f"CAST(count(*) FILTER (WHERE drift) AS INTEGER) AS num_drifted_features, CAST({total} AS INTEGER) AS total_features, "
        f"CAST(0.05 AS DOUBLE) AS drift_threshold, round(count(*) FILTER (WHERE drift) / {float(total)!r}, 6) AS drift_share, "
        f"(SELECT CAST(count(*) AS BIGINT) FROM {ref}) AS reference_rows, (SELECT CAST(count(*) AS BIGINT) FROM {cur}) AS current_rows{stage_col} "
        f"FROM ({det})"
    )


Q["d_summary"] = _chain(*_RC_PARTS, _ND, _chi_sql("ref", "cur", LINE_CATEGORICAL)) + _summary_sql(
    "SELECT feature, p < 0.05 AS drift FROM nd",
    f"SELECT feature, {_CHI_SF} < 0.05 AS drift FROM cs",
    len(LINE_NUMERIC) + len(LINE_CATEGORICAL), "ref", "cur",
)


Q["d_chi_square_p"] = _chain(*_RC_PARTS, _chi_sql("ref", "cur", LINE_CATEGORICAL)) + f"SELECT feature, dof, round({_CHI_SF}, 9) AS p_value FROM cs"

_JS_TERM = "CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END"
Q["d_js"] = _chain(
    *_RC_PARTS, _chi_sql("ref", "cur", LINE_CATEGORICAL),
    "nlf AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS v, {side} AS side FROM {src}" for c in LINE_NUMERIC for src, side in (("ref", 0), ("cur", 1))) + ")",
    "nl AS (SELECT feature, list(v ORDER BY v) AS l, count(v) AS n FROM nlf WHERE v IS NOT NULL GROUP BY feature)",
    "nq AS (SELECT DISTINCT feature, l[CAST(floor(CAST(j AS DOUBLE) / 20 * (n - 1)) AS BIGINT) + 1] AS cut FROM nl CROSS JOIN (SELECT unnest(range(1, 20)) AS j))",
    "nv AS (SELECT feature, v, side, count(*) AS m FROM nlf WHERE v IS NOT NULL GROUP BY feature, v, side)",
    "nb AS (SELECT nv.feature, nv.v, side, any_value(m) AS m, count(cut) AS bin FROM nv LEFT JOIN nq ON nq.feature = nv.feature AND cut < v GROUP BY nv.feature, nv.v, side)",
    "nc AS (SELECT feature, bin, sum(CASE WHEN side = 0 THEN m ELSE 0 END) AS r, sum(CASE WHEN side = 1 THEN m ELSE 0 END) AS c FROM nb GROUP BY feature, bin)",
    "ac AS (SELECT feature, r, c FROM nc UNION ALL SELECT feature, r, c FROM ccnt)",
    "tots AS (SELECT feature, CAST(sum(r) AS DOUBLE) AS nr, CAST(sum(c) AS DOUBLE) AS nc FROM ac GROUP BY feature)",
    "pq AS (SELECT feature, r / nr AS p, c / nc AS q FROM ac JOIN tots USING (feature))",
) + f"SELECT feature, round(sqrt(greatest(sum({_JS_TERM}) / 2, 0)), 6) AS js FROM pq GROUP BY feature"


def _perturb_sql(kind: str, magnitude: float) -> str:
    cols = []
    for c in ["Quantity", "Amount"]:
        if kind == "mean_shift":
            e = f"{c} + {magnitude!r} * (SELECT stddev_samp({c}) FROM txn_lines)"
        elif kind == "scale_change":
            e = f"{c} * {1.0 + magnitude!r}"
        elif kind == "corruption":
            e = f"{c} + {sql_hash_normal('txn_id', SEED, c)} * ({magnitude!r} * (SELECT stddev_samp({c}) FROM txn_lines))"
        else:
            e = f"CASE WHEN {sql_hash_uniform('txn_id', SEED, c)} < {magnitude!r} THEN NULL ELSE {c} END"
        cols.append(f"round({e}, {PERTURB_DIGITS}) AS {c}")
    return _with(_views("txn_lines")) + f"SELECT txn_id, {', '.join(cols)} FROM txn_lines"


Q["d_mean_shift"] = _perturb_sql("mean_shift", 1.0)
Q["d_scale_change"] = _perturb_sql("scale_change", 0.5)
Q["d_corruption"] = _perturb_sql("corruption", 0.2)
Q["d_missing"] = _perturb_sql("missing", 0.3)


def _monitor_sql() -> str:
    feats = FULL_FEATURES
    base = [_views("txn"), _full_features_cte(), "ref AS (SELECT * FROM ff WHERE split = 'train')",
            "cur AS (SELECT * FROM ff WHERE split = 'test')"]
    shifted_cols = ", ".join(
        (f"{c} + 2.0 * (SELECT stddev_samp({c}) FROM cur) AS {c}" if c in ("V14", "V17") else c) for c in feats)
    s1 = "(" + _chain(*base, _numeric_drift_sql("ref", "cur", feats)) + _summary_sql(
        "SELECT feature, p < 0.05 AS drift FROM nd", None, len(feats), "ref", "cur", "baseline") + ")"
    s2 = "(" + _chain(*base, f"cur2 AS (SELECT txn_id, Class, split, {shifted_cols} FROM cur)",
                      _numeric_drift_sql("ref", "cur2", feats)) + _summary_sql(
        "SELECT feature, p < 0.05 AS drift FROM nd", None, len(feats), "ref", "cur2", "shifted") + ")"
    return f"SELECT * FROM {s1} UNION ALL SELECT * FROM {s2}"


Q["d_monitor_flow"] = _monitor_sql()

# ---------------------------------------------------------------- E (txn_events val/test)

_ESC = (
    "e AS (SELECT *, score AS s_amount, round((1.0 + sin(" + _angle() + ")) / 2.0, 3) AS s_hour, "
    "round(" + _pmod("\"Time\"", 3600.0) + " / 3600.0, 3) AS s_minute FROM s)"
)


def _grid_values(n_models: int) -> str:
    rows = [f"({i}, " + ", ".join(_d(w) for w in ws) + ")" for i, ws in enumerate(weight_grid(n_models, 21))]
    names = ", ".join(f"w{j}" for j in range(n_models))
    return f"wg AS (SELECT * FROM (VALUES {', '.join(rows)}) t(weight_id, {names}))"


def _blend_ap_sql(score_cols: list[str]) -> str:
    blend = " + ".join(f"w{j} * {c}" for j, c in enumerate(score_cols))
    return (
        f"bl AS (SELECT weight_id, {blend} AS b, Class FROM v, wg), "
        "bc0 AS (SELECT weight_id, b, CAST(sum(Class) AS BIGINT) AS tp, CAST(sum(1 - Class) AS BIGINT) AS fp FROM bl GROUP BY weight_id, b), "
        "bc AS (SELECT *, sum(tp) OVER (PARTITION BY weight_id ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS ctp, "
        "sum(fp) OVER (PARTITION BY weight_id ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS cfp FROM bc0), "
        "ap AS (SELECT weight_id, sum(tp * CAST(ctp AS DOUBLE) / (ctp + cfp)) / nullif(sum(tp), 0) AS ap FROM bc GROUP BY weight_id)"
    )


_EB = [_views("txn_events"), _split("txn_events", "s"), _ESC, "v AS (SELECT * FROM e WHERE split = 'val')"]
Q["e_blend_grid2"] = _chain(*_EB, _grid_values(2), _blend_ap_sql(["s_amount", "s_hour"])) + \
    "SELECT weight_id, round(w0, 6) AS w0, round(w1, 6) AS w1, round(ap, 6) AS pr_auc FROM wg LEFT JOIN ap USING (weight_id)"
Q["e_blend_grid3"] = _chain(*_EB, _grid_values(3), _blend_ap_sql(["s_amount", "s_hour", "s_minute"])) + \
    "SELECT weight_id, round(w0, 6) AS w0, round(w1, 6) AS w1, round(w2, 6) AS w2, round(ap, 6) AS pr_auc FROM wg LEFT JOIN ap USING (weight_id)"
Q["e_blend_score"] = _chain(
    *_EB, _grid_values(3), _blend_ap_sql(["s_amount", "s_hour", "s_minute"]),
    "best AS (SELECT w0, w1, w2 FROM wg JOIN ap USING (weight_id) ORDER BY round(ap, 9) DESC, weight_id ASC LIMIT 1)",
) + f"SELECT txn_id, round(w0 * s_amount + w1 * s_hour + w2 * s_minute, {D9}) AS score FROM e, best WHERE split = 'test'"


Q["flagship"] = _chain(
    _views("txn"), _full_features_cte(),
    f"s2 AS (SELECT split, Class, {heuristic_sql('r3')} AS score FROM ff)",
    "c0 AS (SELECT split, score, CAST(sum(Class) AS BIGINT) AS tp, CAST(sum(1 - Class) AS BIGINT) AS fp FROM s2 GROUP BY split, score)",
    "c AS (SELECT *, sum(tp) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ctp, "
    "sum(fp) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cfp, sum(tp) OVER (PARTITION BY split) AS P FROM c0)",
    f"r AS (SELECT split, {_AP} AS pr_auc, {_AUC} AS roc_auc FROM c GROUP BY split)",
    "b AS (SELECT split, CASE WHEN P > 0 THEN round(score, 6) END AS best_threshold, CASE WHEN P > 0 THEN round(f1, 6) END AS best_f1 FROM ("
    "SELECT *, row_number() OVER (PARTITION BY split ORDER BY f1 DESC, score ASC) AS rn FROM ("
    "SELECT split, score, P, coalesce(CAST(2 * ctp AS DOUBLE) / nullif(CAST(ctp + cfp + P AS DOUBLE), 0), 0.0) AS f1 FROM c)) WHERE rn = 1)",
) + "SELECT * FROM r JOIN b USING (split)"


_lc = len(_LINE_COLS) - 1
Q["p_separate_target"] = _with(_views("txn_lines"), _split("txn_lines", "s")) + (
    f"SELECT split, {_lc} AS n_columns, CAST(count(*) AS BIGINT) AS rows, CAST(sum(Class) AS BIGINT) AS positives FROM s GROUP BY split")
Q["p_drop_target"] = _chain(*_RC_PARTS, _ND) + "SELECT feature, 'numeric' AS kind, p < 0.05 AS drift FROM nd"
Q["s_csv_roundtrip"] = _with(_views("txn")) + 'SELECT "Time", round(V1, 6) AS V1, round(V28, 6) AS V28, Amount, Class FROM txn'
Q["s_requests"] = f"SELECT is_fraud, fraud_probability, count(*) AS rows FROM ({Q['r_score_batch']}) GROUP BY is_fraud, fraud_probability"
Q["r_single_equals_batch"] = _with(_views("txn")) + "SELECT count(*) AS rows, count(*) AS equal FROM txn"
_raw = Q["e_blend_score"].replace(f"round(w0 * s_amount + w1 * s_hour + w2 * s_minute, {D9}) AS score", "w0 * s_amount + w1 * s_hour + w2 * s_minute AS score")
Q["e_predict"] = f"SELECT txn_id, score >= 0.5 AS is_fraud FROM ({_raw})"
Q["e_blend_saved"] = Q["e_blend_score"]
Q["m_odd_scores"] = _with(
    _views("txn_events"),
    "h AS (SELECT CASE WHEN txn_id % 2 = 0 THEN 'even' ELSE 'odd' END AS part, Class, score FROM txn_events WHERE txn_id % 7 <> 0 AND txn_id % 11 <> 0)",
    "c0 AS (SELECT part, score, CAST(sum(Class) AS BIGINT) AS tp, CAST(sum(1 - Class) AS BIGINT) AS fp FROM h GROUP BY part, score)",
    "c AS (SELECT *, sum(tp) OVER (PARTITION BY part ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ctp, "
    "sum(fp) OVER (PARTITION BY part ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cfp FROM c0)",
    f"r AS (SELECT part, {_AP} AS pr_auc, {_AUC} AS roc_auc FROM c GROUP BY part)",
    f"t AS ({_thr_metrics('h', 'part', METRIC_THRESHOLD)})",
) + "SELECT nullif(part, 'odd') AS part, pr_auc, roc_auc, precision, recall, f1, threshold FROM r JOIN t USING (part)"
Q["a_iqr_outliers_chars"] = (
    "WITH q AS (SELECT quantile_cont(n_chars, 0.75) + 3.0 * (quantile_cont(n_chars, 0.75) - quantile_cont(n_chars, 0.25)) AS u FROM documents) "
    "SELECT 'n_chars' AS feature, CAST(count(*) FILTER (WHERE n_chars > u) AS BIGINT) AS outliers, round(max(u), 6) AS upper FROM documents, q "
    "HAVING count(*) FILTER (WHERE n_chars > u) > 0")
_wide = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round({_corr(chr(34) + c + chr(34), 'CAST(Class AS DOUBLE)')}, 6) AS corr FROM txn" for c in TXN_FEATURES)
Q["a_corr_top15_wide"] = _with(_views("txn"), f"c AS ({_wide})") + \
    "SELECT feature, corr FROM c ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 15"
Q["s_run_log"] = Q["m_leaderboard"].replace("split = 'test'", "split = 'val'")
Q["s_run_log"] = f"SELECT k, v FROM (UNPIVOT (SELECT pr_auc, roc_auc, f1, precision, recall FROM ({Q['s_run_log']}) WHERE model_name = 'r3') ON pr_auc, roc_auc, f1, precision, recall INTO NAME k VALUE v)"
Q["d_stream_psi_days"] = (
    "WITH g AS (SELECT min(value) AS lo, max(value) AS hi FROM events), "
    "e AS (SELECT date_trunc('day', ts) AS d, least(greatest(floor((value - lo) / (hi - lo) * 10), 0), 9)::INT AS bin FROM events, g WHERE value IS NOT NULL), "
    "r AS (SELECT b.bin, greatest(count(e.bin) / (SELECT CAST(count(*) AS DOUBLE) FROM e), 0.0001) AS pr FROM (SELECT unnest(range(10))::INT AS bin) b LEFT JOIN e USING (bin) GROUP BY b.bin), "
    "t AS (SELECT d, count(*) AS n FROM e GROUP BY d), "
    "c AS (SELECT t.d, r.bin, r.pr, t.n, greatest(count(e.bin) / CAST(t.n AS DOUBLE), 0.0001) AS pc FROM t CROSS JOIN r LEFT JOIN e ON e.d = t.d AND e.bin = r.bin GROUP BY t.d, r.bin, r.pr, t.n) "
    "SELECT strftime(d, '%Y-%m-%d') AS day, round(sum((pc - pr) * ln(pc / pr)), 5) AS psi, CAST(max(n) AS BIGINT) AS rows, "
    "d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) AS closed FROM c GROUP BY d")

Q["d_stream_ks_days"] = (
    "WITH e AS (SELECT date_trunc('day', ts) AS d, 'value' AS feature, CAST(value AS DOUBLE) AS v FROM events "
    "UNION ALL SELECT date_trunc('day', ts), 'user_id', CAST(user_id AS DOUBLE) FROM events), "
    "s AS (SELECT feature, list(v ORDER BY v) AS l, count(v) AS n FROM e WHERE v IS NOT NULL GROUP BY feature), "
    "g AS (SELECT DISTINCT feature, l[CAST(floor(j / 64.0 * (n - 1)) AS BIGINT) + 1] AS q FROM s CROSS JOIN (SELECT unnest(range(65)) AS j)), "
    "r AS (SELECT feature, q, count_if(v <= q) / CAST(count(v) AS DOUBLE) AS fi, count_if(v < q) / CAST(count(v) AS DOUBLE) AS fe "
    "FROM g JOIN e USING (feature) GROUP BY feature, q), "
    "w AS (SELECT d, feature, q, any_value(fi) AS fi, any_value(fe) AS fe, count(*) AS rows, count(v) AS n, "
    "count_if(v <= q) / CAST(count(v) AS DOUBLE) AS wi, count_if(v < q) / CAST(count(v) AS DOUBLE) AS we FROM r JOIN e USING (feature) GROUP BY d, feature, q) "
    "SELECT strftime(d, '%Y-%m-%d') AS day, feature, round(max(greatest(abs(wi - fi), abs(we - fe))), 6) AS ks, CAST(max(rows) AS BIGINT) AS rows, "
    "CAST(max(n) AS BIGINT) AS n, d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) AS closed FROM w GROUP BY d, feature")

# S6 / S7 round trips: what is read back must equal what was computed
Q["s_results_sink"] = Q["m_leaderboard"]
Q["s_drift_report"] = _chain(*_RC_PARTS, _ND) + _summary_sql(
    "SELECT feature, p < 0.05 AS drift FROM nd", None, len(LINE_NUMERIC), "ref", "cur",
)


def oracle_sql() -> dict[str, str]:
    return dict(Q)
