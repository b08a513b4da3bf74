"""Bucketed prefix sums: running totals in a global order without one big partition.

``Window.orderBy(x)`` with no partition plans ``Exchange SinglePartition``: at scale the
whole column goes through one task. Instead:

1. the caller collapses ties (one row per key and order value);
2. rows get a range bucket from per-key ``percentile_approx`` cuts, found by binary
   search (a pure function of the value, so a re-executed task gets the same bucket);
3. per-(key, bucket) totals (at most #keys x #buckets rows) give exclusive offsets
   through a window over that small table;
4. a window partitioned by (key, bucket) adds its local running sum to the offset.

The number of buckets grows with the largest key so no bucket exceeds about
``rows_per_bucket`` rows; small inputs use one bucket.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.search import count_below
from riskframe.plans.broadcast import MAX_BROADCAST_ROWS, bounded_broadcast
from riskframe.plans.materialize import keep

DEFAULT_ROWS_PER_BUCKET = 2_000_000
DEFAULT_MAX_BUCKETS = 1 << 30  # in effect none: buckets follow the rows
SALTS = 64
MIN_ROWS_PER_BUCKET = 200_000


def bucket_count(max_rows: int, rows_per_bucket: int, max_buckets: int, parallelism: int = 1) -> int:
    """Buckets for the largest key: enough that none exceeds ``rows_per_bucket`` rows,
    and (when the key is big enough to be worth splitting) at least two per core, so
    a dominant key (e.g. the 99.8 % class) never runs in a single task."""
    by_size = math.ceil(max_rows / max(1, rows_per_bucket))
    by_cores = min(2 * max(1, parallelism), math.ceil(max_rows / MIN_ROWS_PER_BUCKET))
    return int(min(max_buckets, max(1, by_size, by_cores)))


def _join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be NULL; the left side's columns stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, cond).drop(*(f"_r_{k}" for k in keys))


def ordered_prefix(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    sum_cols: Sequence[str],
    *,
    descending: bool,
    with_next: bool = False,
    with_totals: bool = False,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    max_buckets: int = DEFAULT_MAX_BUCKETS,
    size_bound: tuple[int, int] | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum of ``c`` in ``order_col`` order per key).

    ``df`` must hold one row per (keys, order_col) with non-NULL ``order_col``.
    ``with_next`` (ascending only) adds ``next_<order_col>``: the following distinct
    value of the key, NULL on the last one. ``with_totals`` adds ``tot_<c>``, the
    key's total, taken from the small offsets table (no window over the data).
    ``size_bound=(max_rows_per_key, n_keys)``, when the caller can prove one, replaces
    the sizing job (and the cache it needs).
    """
    if with_next and descending:
        raise ValueError("with_next is defined for ascending order only")
    keys = list(keys)
    # read by the sizing job and by the ranking job: computed once
    work = df if size_bound is not None else keep(df)
    if not keys:
        work = work.withColumn("_pk", F.lit(0))
        keys = ["_pk"]

    if size_bound is not None:
        max_n, n_keys = int(size_bound[0]), int(size_bound[1])
    else:
        stats = work.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        row = stats.agg(F.max("_n").alias("m"), F.count(F.lit(1)).alias("k")).first()
        max_n, n_keys = int(row["m"] or 0), int(row["k"] or 0)
    n_buckets = bucket_count(max_n, rows_per_bucket, max_buckets, df.sparkSession.sparkContext.defaultParallelism)

    if n_buckets == 1:
        work = work.withColumn("_b", F.lit(0))
    else:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        # cuts only balance the buckets, so they may be rough. Sketches of a hot key are not
        # merged in one task: each salt of a key gives evenly spaced values, those give the cuts
        salt = F.pmod(F.xxhash64(order_col), F.lit(SALTS)).cast("int")
        steps = [i / (4 * n_buckets) for i in range(1, 4 * n_buckets)]
        # (salted by task here: a task then holds one sketch a key, not 64 and a sort to tell them apart)
        part = work.withColumn("_sl", F.spark_partition_id() % SALTS).groupBy(*keys, "_sl").agg(F.percentile_approx(order_col, steps, 1000).alias("_v"))
        cuts = part.select(*keys, F.explode("_v").alias("_v")).groupBy(*keys).agg(
            F.percentile_approx("_v", probs, max(1000, 4 * n_buckets)).alias("_cuts"))
        # one row per key holding n_buckets - 1 cut values: bounded by n_keys * n_buckets values.
        # Beyond the bound the keys are salted on both sides, so that a hot key is spread
        if n_keys * n_buckets <= MAX_BROADCAST_ROWS:
            work = _join_keys(work, F.broadcast(cuts), keys)
        else:
            salted = cuts.withColumn("_sl", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            work = _join_keys(work.withColumn("_sl", salt), salted, [*keys, "_sl"]).drop("_sl")
        work = work.withColumn(
            "_b", count_below(F.col("_cuts"), F.col(order_col).cast("double"), n_buckets - 1)
        ).drop("_cuts")

    # per-(key, bucket) totals: at most n_keys * n_buckets rows
    tot_aggs = [F.sum(c).alias(f"_t_{c}") for c in sum_cols]
    if with_next:
        tot_aggs.append(F.min(order_col).alias("_bmin"))
    totals = work.groupBy(*keys, "_b").agg(*tot_aggs)
    bw = Window.partitionBy(*keys).orderBy(F.col("_b").desc() if descending else F.col("_b").asc())
    prev = bw.rowsBetween(Window.unboundedPreceding, -1)
    off_cols = [F.coalesce(F.sum(f"_t_{c}").over(prev), F.lit(0)).alias(f"_o_{c}") for c in sum_cols]
    if with_next:
        off_cols.append(F.lead("_bmin").over(bw).alias("_bnext"))
    if with_totals:
        kw = Window.partitionBy(*keys)
        off_cols += [F.sum(f"_t_{c}").over(kw).alias(f"tot_{c}") for c in sum_cols]
    offsets = totals.select(*keys, "_b", *off_cols)

    work = _join_keys(work, bounded_broadcast(offsets, n_keys * n_buckets), [*keys, "_b"])
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = Window.partitionBy(*keys, "_b").orderBy(order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out_cols = [(F.sum(c).over(run) + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in sum_cols]
    if with_next:
        out_cols.append(F.coalesce(F.lead(order_col).over(w), F.col("_bnext")).alias(f"next_{order_col}"))
    drop = [f"_o_{c}" for c in sum_cols] + (["_bnext"] if with_next else [])
    result = work.select("*", *out_cols).drop(*drop, "_b")
    if "_pk" in result.columns:
        result = result.drop("_pk")
    return result
