"""Quality rules: base rules, then robust multivariate outliers per language and source.

Each document becomes a vector of transformed statistics. For every (lang, source) group the
minimum-covariance-determinant estimate is sought by concentration steps: take the
``support`` share of rows nearest to the estimate, set mean and covariance to theirs, repeat.
There are three starts: medians and quartile ranges, mean and covariance of all rows, and
the covariance of spatial signs around the medians. After two steps the start with the least
determinant goes on until its determinant falls by less than ``TOLERANCE`` (as a share), at
most ``max_steps`` steps; of all estimates seen the one with the least determinant counts.

Statistics that hardly vary in a group get a least spread: eigenvalues of the covariance, in
units of ``FLOORS``, are raised to 1. The criterion that falls is then the logarithm of the
determinant plus the trace of the subset's covariance under the inverse, which is the
determinant up to a constant where nothing was raised. A final squared distance, made
consistent for normal rows, above ``cutoff`` rejects a row; 30 is the quantile of chi-square
with five degrees of freedom at 1 - 1.5e-5.

As Spark work: one Arrow pass turns texts into statistics (written to the shared folder, a
few numbers a row); each concentration step joins the group's estimate to the statistics by
the group key, salted by the size of that group, bins the distance, and sums moments per
(group, bin) with a map-side combine. The subset is made of bins, the last one with a weight
that gives the wanted share, so a group of any size is summed where its rows are; only at
most ``BINS`` rows of moments a group meet in one task. Groups whose determinant has settled
take no part in further steps.

A group under ``min_group`` rows is too small for an estimate of its own: its rows are
judged by the estimate of their whole language, and where that has too few rows too, by that
of the whole table (of any size). These pools are made of all their rows, by the same steps
and the same binned sums as a group, so every row has a robust distance; pools that no small
group needs are not computed.

Null text has no words; null lang or source are values of their own. Equal rows get equal
verdicts. Extra columns are kept by ``filter_documents`` and ignored otherwise. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import map_arrow, need, text_key, written
from riskframe.llm.textcols import U, Words, first_of_equals, mix, row_groups, row_sums, text_bytes, window_hashes, window_starts

BINS = 1024
ROWS_PER_SALT = 1_000_000
SLOTS = 1 << 30
PRIOR_WORDS, PRIOR_CHARS = 20, 5.5
FEATURES = ["x0", "x1", "x2", "x3", "x4"]
PAIRS = [(i, j) for i in range(5) for j in range(i, 5)]
# Smallest standard deviation that counts in each transformed statistic: a group whose rows
# nearly all agree (no symbols, no repeats) would else reject any row that differs at all.
FLOORS = (0.5, 0.35, 0.1, 0.5, 0.15)
TOLERANCE = 0.01

STATS_SCHEMA = ("doc_id long, text_key long, group_key string, lang_key string, slot int, n_words long, word_chars long, n_symbols long, "
                "n_dup_lines long, n_repeat_words long, " + ", ".join(f"{f} double" for f in FEATURES))

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Base statistics of a group of rows."""
    w = Words(data, offsets)
    rows = len(offsets) - 1
    lead = (data < 0x80) | (data >= 0xC0)  # bytes that begin a code point
    chars = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
    word_chars = np.bincount(w.row, weights=chars[w.end] - chars[w.start], minlength=rows).astype(np.int64)
    n_symbols = row_sums(_SYMBOL[data], offsets)

    # lines: split at newlines and row ends; equal bytes within a row make a duplicate
    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_row = np.searchsorted(offsets[1:], line_start, side="right")
    own = np.sort(np.concatenate([breaks, offsets[1:]]))
    # a newline that ends a row starts an empty line, which has no word and doesn't count
    line_row = np.minimum(line_row, rows - 1)
    words_before = np.searchsorted(w.start, line_start)
    has_word = np.searchsorted(w.start, own) > words_before
    s, e, r = line_start[has_word], own[has_word], line_row[has_word]
    firsts = first_of_equals(data, s, e, r)
    n_dup = np.bincount(r, minlength=rows) - np.bincount(r[firsts], minlength=rows)

    # words covered by 8-word windows that occur twice or more in the row
    at, row = window_starts(w.first, 8)
    key = mix(window_hashes(w.hashes(), at, 8) ^ (row.astype(np.uint64) * U(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(w) + 9, dtype=np.int32)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + 8, -1)
    covered = np.cumsum(step)[: len(w)] > 0
    return {"n_words": w.count.astype(np.int64), "word_chars": word_chars, "n_symbols": n_symbols,
            "n_dup_lines": n_dup.astype(np.int64), "n_repeat_words": row_sums(covered, w.first)}


def _features(s: dict[str, np.ndarray]) -> list[np.ndarray]:
    n = np.maximum(s["n_words"], 1)
    # the mean word length is drawn towards PRIOR_CHARS as if PRIOR_WORDS more words had been seen
    length = (s["word_chars"] + PRIOR_WORDS * PRIOR_CHARS) / (s["n_words"] + PRIOR_WORDS)
    return [np.log1p(s["n_words"]), length, np.sqrt(s["n_symbols"] / n),
            np.log1p(s["n_dup_lines"]), np.sqrt(s["n_repeat_words"] / n)]


def _stats_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slot = 0  # rows of a task are numbered round: copies of one row get different salts
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for lo, hi in row_groups(offsets):
            s = _statistics(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
            cols = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key", "group_key", "lang_key")]
            cols.append(pa.array((slot + np.arange(hi - lo)) % SLOTS, pa.int32()))
            slot = (slot + hi - lo) % SLOTS
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(v) for v in s.values()] + [pa.array(v, pa.float64()) for v in _features(s)],
                ["doc_id", "text_key", "group_key", "lang_key", "slot", *s, *FEATURES])


def _marked(c: str):
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document: key columns, base statistics and transformed statistics."""
    need(docs, "doc_id", "text", "lang", "source")
    group = F.concat_ws("\x01", _marked("lang"), _marked("source"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
                       group.alias("group_key"), F.concat(F.lit("L"), _marked("lang")).alias("lang_key"), F.col("text"))
    return map_arrow(rows, _stats_batches, STATS_SCHEMA)


def base_failed(min_words: int = 20, max_repeat_percent: int = 30):
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def chi2_cdf(x: float, p: int) -> float:
    """Chi-square distribution function by the series of the incomplete gamma function."""
    a, z = p / 2, x / 2
    term = total = 1 / a
    for k in range(1, 500):
        term *= z / (a + k)
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a))) if z > 0 else 0.0


def consistency(support: float, p: int = 5) -> float:
    """Factor that makes the covariance of the nearest ``support`` of normal rows unbiased."""
    lo, hi = 0.0, 100.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, p) < support else (lo, mid)
    return support / chi2_cdf(lo, p + 2)


_EST_SCHEMA = ("pool string, n long, start int, criterion double, falling boolean, " + ", ".join(f"m{i} double" for i in range(5))
               + ", " + ", ".join(f"w{i}{j} double" for i, j in PAIRS))
_EST_NAMES = [x.split()[0] for x in _EST_SCHEMA.split(", ")]


def raised(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """Inverse of ``cov`` with its eigenvalues, in units of FLOORS, raised to 1, and the
    criterion: logarithm of the determinant plus trace of ``cov`` under the inverse."""
    units = np.outer(FLOORS, FLOORS)
    values, vectors = np.linalg.eigh(cov / units)
    up = np.maximum(values, 1.0)
    return (vectors / up) @ vectors.T / units, float(np.sum(np.log(up) + values / up))


def _estimate(pool: str, n: int, start: int, mean: np.ndarray, cov: np.ndarray, before: float = math.inf) -> list:
    inv, criterion = raised(cov)
    return [pool, int(n), int(start), criterion, bool(criterion < before - TOLERANCE),
            *map(float, mean), *(float(inv[i, j]) for i, j in PAIRS)]


def _moments() -> list:
    """Sums s0.. and s00.. of the statistics and of their products."""
    return [*(F.sum(f"x{i}").alias(f"s{i}") for i in range(5)),
            *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in PAIRS)]


def _symmetric(of) -> np.ndarray:
    out = np.zeros((5, 5))
    for i, j in PAIRS:
        out[i, j] = out[j, i] = of(i, j)
    return out


def _mean_cov(weight: float, total) -> tuple[np.ndarray, np.ndarray]:
    mean = np.array([total(f"s{i}") / weight for i in range(5)])
    return mean, _symmetric(lambda i, j: total(f"s{i}{j}") / weight - mean[i] * mean[j])


def _plain_starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        out = []
        for r in pdf.itertuples(index=False):
            q = [np.asarray(getattr(r, f"q{i}"), dtype=float) for i in range(5)]
            spread = np.array([(x[2] - x[0]) / 1.349 for x in q])
            out.append(_estimate(r.pool, r.n, 0, np.array([x[1] for x in q]), np.diag(spread ** 2)))
            out.append(_estimate(r.pool, r.n, 1, *_mean_cov(r.n, lambda c: getattr(r, c))))
        yield pd.DataFrame(out, columns=_EST_NAMES)


def _sign_start(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        out = []
        for r in pdf.itertuples(index=False):
            scale = np.array([getattr(r, f"w{i}") ** -0.5 for i in range(5)])
            cov = _symmetric(lambda i, j: 5 * getattr(r, f"u{i}{j}") / r.n * scale[i] * scale[j])
            out.append(_estimate(r.pool, r.n, 2, np.array([getattr(r, f"m{i}") for i in range(5)]), cov))
        yield pd.DataFrame(out, columns=_EST_NAMES)


def starts(rows: DataFrame) -> DataFrame:
    """Three estimates of every pool to begin with."""
    sums = rows.groupBy("pool").agg(
        F.count(F.lit(1)).alias("n"), *_moments(),
        *(F.percentile_approx(f, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, f in enumerate(FEATURES)))
    plain = written(sums.mapInPandas(_plain_starts, _EST_SCHEMA), "mcd-start")
    j = _with_distance(rows, plain.where("start = 0"))
    z = [(F.col(f"x{i}") - F.col(f"m{i}")) * F.sqrt(f"w{i}{i}") for i in range(5)]
    signs = j.groupBy("pool").agg(
        F.max("n").alias("n"), *(F.max(f"m{i}").alias(f"m{i}") for i in range(5)), *(F.max(f"w{i}{i}").alias(f"w{i}") for i in range(5)),
        *(F.sum(F.when(F.col("distance2") > 0, z[i] * z[k] / F.col("distance2")).otherwise(0.0)).alias(f"u{i}{k}") for i, k in PAIRS))
    return plain.unionByName(written(signs.mapInPandas(_sign_start, _EST_SCHEMA), "mcd-start"))


def _concentrate(support: float):
    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        c = pdf["c"].to_numpy(dtype=float)
        n = int(pdf["c"].sum())
        # whole bins, then the share of a bin that makes support * n rows
        share = np.clip((support * n - (np.cumsum(c) - c)) / c, 0.0, 1.0)
        mean, cov = _mean_cov(support * n, lambda k: float((pdf[k].to_numpy() * share).sum()))
        r = pdf.iloc[0]
        return pd.DataFrame([_estimate(r["pool"], n, r["start"], mean, cov, r["before"])], columns=_EST_NAMES)

    return step


def salted(est: DataFrame) -> DataFrame:
    """One row per pool and salt: as many salts as the pool has millions of rows, at least one."""
    last = F.greatest(F.ceil(F.col("n") / ROWS_PER_SALT), F.lit(1)) - 1
    return est.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def _with_distance(rows: DataFrame, est: DataFrame) -> DataFrame:
    """Squared distance of each row, which names its pool and the pool's ``salts``, from the pool's estimates."""
    rows = rows.withColumn("salt", F.pmod(F.col("slot").cast("long"), F.col("salts"))).drop("slot", "salts")
    j = rows.join(salted(est), ["pool", "salt"])
    d = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(5)]
    total = sum((1 if i == j_ else 2) * d[i] * d[j_] * F.col(f"w{i}{j_}") for i, j_ in PAIRS)
    return j.withColumn("distance2", F.greatest(total, F.lit(0.0))).drop("salt")


TABLE = "T"  # the pool of all rows; group keys begin with = or -, those of languages with L


def pools(stats: DataFrame, min_group: int = 30) -> DataFrame:
    """Of every (lang, source) group: ``judge``, the pool whose estimate judges its rows (the
    group, its language or the table), and ``pools``, the pools that its rows are part of; each
    with its number of salts."""
    groups = written(stats.groupBy("lang_key", "group_key").agg(F.count(F.lit(1)).alias("n_group")), "quality-groups")
    langs = groups.groupBy("lang_key").agg(
        F.sum("n_group").alias("n_lang"), F.min("n_group").alias("least"))
    langs = written(langs.select("lang_key", "n_lang", (F.col("least") < min_group).alias("pooled"),
                                 (F.col("n_lang") < min_group).alias("few")), "quality-langs")
    whole, n_rows = langs.agg(F.max(F.col("pooled") & F.col("few")), F.sum("n_lang")).first()

    def pool(name, n):
        salts = F.greatest(F.ceil(n / ROWS_PER_SALT), F.lit(1)).cast("long")
        return F.struct(name.alias("pool"), salts.alias("salts"))

    own = F.col("n_group") >= min_group
    group, lang = pool(F.col("group_key"), F.col("n_group")), pool(F.col("lang_key"), F.col("n_lang"))
    table = pool(F.lit(TABLE), F.lit(n_rows or 0))
    judge = F.when(own, group).when(~F.col("few"), lang).otherwise(table)
    parts = F.array(F.when(own, group), F.when(F.col("pooled") & ~F.col("few"), lang), F.when(F.lit(bool(whole)), table))
    return written(groups.join(langs, "lang_key").select(
        "lang_key", "group_key", judge.alias("judge"), F.array_compact(parts).alias("pools")), "quality-pools")


def _step(rows: DataFrame, est: DataFrame, support: float) -> DataFrame:
    # log-spaced bins: 32 to a doubling of 1 + d2, the last one open
    bin_ = F.least(F.floor(F.log2(1 + F.col("distance2")) * 32), F.lit(BINS - 1)).cast("int")
    sums = _with_distance(rows, est).groupBy("pool", "start", bin_.alias("bin")).agg(
        F.count(F.lit(1)).alias("c"), F.max("before").alias("before"), *_moments())
    return sums.groupBy("pool", "start").applyInPandas(_concentrate(support), _EST_SCHEMA)


def _least(est: DataFrame) -> DataFrame:
    """The estimate with the least criterion of every pool."""
    least = F.min(F.struct("criterion", *(c for c in _EST_NAMES if c not in ("pool", "criterion")))).alias("e")
    return est.groupBy("pool").agg(least).select("pool", "e.*").select(_EST_NAMES)


def concentrations(rows: DataFrame, support: float = 0.75, max_steps: int = 30) -> list[DataFrame]:
    """The estimates after each step. The first two hold all starts, later ones the best start
    of the pools whose determinant still fell."""
    est, out = starts(rows).withColumn("before", F.lit(math.inf)), []
    while len(out) < max_steps:
        out.append(written(_step(rows, est, support), "mcd-step"))
        est = out[-1]
        if len(out) == 2:
            est = _least(est)
        elif len(out) > 2:
            est = est.where("falling")
            if est.isEmpty():
                break
        est = est.withColumn("before", F.col("criterion"))
    return out


def estimates(rows: DataFrame, support: float = 0.75, max_steps: int = 30) -> DataFrame:
    """MCD estimate of every pool, from ``rows`` that name theirs."""
    return written(_least(reduce(DataFrame.unionByName, concentrations(rows, support, max_steps))), "mcd")


def quality_rules(docs: DataFrame, support: float = 0.75, max_steps: int = 30, cutoff: float = 30.0,
                  min_group: int = 30, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """One row per document: doc_id, text_key, statistics, distance2, base_failed, kept."""
    stats = written(statistics(docs), "quality-stats")
    of_group = stats.join(pools(stats, min_group), ["lang_key", "group_key"])
    est = estimates(parts_of(of_group), support, max_steps)
    judged = of_group.drop("pools").withColumns({"pool": F.col("judge.pool"), "salts": F.col("judge.salts")})
    out = _with_distance(judged, est).withColumn("distance2", F.col("distance2") / consistency(support)).withColumn(
        "base_failed", base_failed(min_words, max_repeat_percent))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("distance2") <= cutoff)).select(
        "doc_id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "distance2", "base_failed", "kept", "group_key")


def parts_of(of_group: DataFrame) -> DataFrame:
    """A row for every pool that a row is part of."""
    parts = of_group.select("slot", F.explode("pools").alias("p"), *FEATURES)
    return written(parts.select("p.pool", "p.salts", "slot", *FEATURES), "quality-parts")


def filter_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    verdicts = quality_rules(docs, **options).where("kept").select(
        F.col("doc_id").alias("\x01q_id"), F.col("text_key").alias("\x01q_text"), F.col("group_key").alias("\x01q_group")).distinct()
    group = F.concat_ws("\x01", _marked("lang"), _marked("source"))
    cond = (F.col("doc_id").cast("long").eqNullSafe(F.col("\x01q_id")) & (text_key(F.col("text")) == F.col("\x01q_text"))
            & (group == F.col("\x01q_group")))
    return docs.join(verdicts.hint("shuffle_hash"), cond, "left_semi")
