"""Maxima over running totals by bounds: only buckets that can hold the maximum are sorted.

A quantity such as F1 or the gap of two distribution functions depends on running totals in the
order of a column. Rows are put into range buckets; the totals of a bucket and of all before it
bound the quantity within (``upper``), and its value at the bucket's end is reached (``lower``).
A bucket whose upper bound is under the best lower bound of its key holds no maximum. Only rows of
the other buckets are collapsed, shuffled and sorted.

What is counted first is one row a (key, bucket), with a map-side combine. Cuts come from salted
sketches and only balance the buckets, so they may be rough.
"""

from __future__ import annotations

import math
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.search import count_below
from riskframe.plans.broadcast import bounded_broadcast
from riskframe.plans.materialize import keep
from riskframe.plans.prefix import DEFAULT_ROWS_PER_BUCKET, SALTS, _join_keys

LEAST_BUCKETS = 256

Bound = Callable[[dict[str, Column], dict[str, Column], dict[str, Column]], Column]


def bucket_bounds(df: DataFrame, keys: Sequence[str], order_col: str, sum_cols: Sequence[str], upper: Bound, lower: Bound, *,
                  descending: bool, least_buckets: int = LEAST_BUCKETS) -> tuple[DataFrame, DataFrame, int]:
    """``df`` with its bucket ``_b``; one row a (key, bucket) with ``_o_`` (totals before it), ``tot_``
    (of the key) and ``alive``; and the most rows that table can have.

    ``upper`` and ``lower`` get the totals before a bucket, up to its end, and of the key, by column.
    A bound that is NULL says that the key has no maximum: its lowest bucket alone stays."""
    keys = list(keys)
    # salted by task: a task holds one sketch a key, and those of a hot key aren't merged in one task.
    # At most SALTS rows a key, each with its share of the rows and evenly spaced values of it
    steps = [i / (4 * least_buckets) for i in range(1, 4 * least_buckets)]
    part = keep(df.withColumn("_sl", F.spark_partition_id() % SALTS).groupBy(*keys, "_sl").agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx(order_col, steps, 8 * least_buckets).alias("_v")))
    size = part.groupBy(*keys).agg(F.sum("_n").alias("n")).agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("keys")).first()
    n_buckets = max(least_buckets, math.ceil((size["most"] or 0) / DEFAULT_ROWS_PER_BUCKET))
    n_rows = int(size["keys"]) * n_buckets
    cuts = part.select(*keys, F.explode("_v").alias("_v")).groupBy(*keys).agg(F.array_distinct(F.percentile_approx(
        "_v", [i / n_buckets for i in range(1, n_buckets)], 8 * n_buckets)).alias("_cuts"))
    work = _join_keys(df, bounded_broadcast(cuts, n_rows), keys)
    work = keep(work.withColumn("_b", count_below(F.col("_cuts"), F.col(order_col).cast("double"), n_buckets - 1)).drop("_cuts"))

    totals = work.groupBy(*keys, "_b").agg(*(F.sum(c).alias(f"_t_{c}") for c in sum_cols))
    of_key = Window.partitionBy(*keys)
    before = of_key.orderBy(F.col("_b").desc() if descending else F.col("_b").asc()).rowsBetween(Window.unboundedPreceding, -1)
    table = totals.select("*", *(F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols),
                          *(F.sum(f"_t_{c}").over(of_key).alias(f"tot_{c}") for c in sum_cols))
    sums = ({c: F.col(f"_o_{c}") for c in sum_cols}, {c: F.col(f"_o_{c}") + F.col(f"_t_{c}") for c in sum_cols},
            {c: F.col(f"tot_{c}") for c in sum_cols})
    table = table.withColumn("_up", upper(*sums)).withColumn("_low", lower(*sums))
    alive = F.coalesce(F.col("_up") >= F.max("_low").over(of_key), F.col("_b") == F.min("_b").over(of_key))
    table = table.withColumn("alive", alive).select(
        *keys, "_b", "alive", *(f"_o_{c}" for c in sum_cols), *(f"tot_{c}" for c in sum_cols))
    return work, table, n_rows


def candidates(df: DataFrame, keys: Sequence[str], order_col: str, sum_cols: Sequence[str], upper: Bound, lower: Bound, *,
               descending: bool, least_buckets: int = LEAST_BUCKETS) -> DataFrame:
    """One row per key and distinct ``order_col`` of the buckets that can hold the maximum, with
    ``cum_<c>`` and ``tot_<c>`` as ``ordered_prefix`` gives them. ``order_col`` must not be NULL;
    rows need not be collapsed."""
    keys, bare = list(keys), not keys
    if bare:
        df, keys = df.withColumn("_pk", F.lit(0)), ["_pk"]
    work, table, n_rows = bucket_bounds(df, keys, order_col, sum_cols, upper, lower, descending=descending, least_buckets=least_buckets)
    rows = _join_keys(work, bounded_broadcast(table.where("alive").drop("alive"), n_rows), [*keys, "_b"])
    fixed = [f"_o_{c}" for c in sum_cols] + [f"tot_{c}" for c in sum_cols]
    one = rows.groupBy(*keys, "_b", order_col).agg(
        *(F.sum(c).alias(c) for c in sum_cols), *(F.first(c).alias(c) for c in fixed))
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    run = Window.partitionBy(*keys, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = one.select("*", *((F.sum(c).over(run) + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in sum_cols))
    return out.drop("_b", *(f"_o_{c}" for c in sum_cols), *(["_pk"] if bare else []))
