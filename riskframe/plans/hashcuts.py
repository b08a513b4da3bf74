"""Exact splits by hash cut points: rows are assigned where they are read.

A split by rank of ``(md5(id | seed), id)`` inside each stratum needs only the few rows at
which the rank passes a wanted number, not the rank of every row:

1. rows are counted per (stratum, leading hash digits), with a map-side combine; running
   totals over these counts tell which digits hold each wanted rank;
2. only the rows with those digits are ranked (one 65,536th of a stratum per cut);
3. every row compares its own ``(hash, id)`` with its stratum's cut points.

No column but strata, id and hash is ever shuffled, and no row of the result is. The answer
is a pure function of (id, seed, stratum sizes). The cut points (a few per stratum) are
written to the shared folder, so later readers of the split scan the data once.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.hashing import row_hash
from riskframe.plans.broadcast import bounded_broadcast
from riskframe.plans.materialize import cut

DIGITS = 4  # leading hash digits that are counted: 65,536 counts per stratum


def cut_points(df: DataFrame, strata: Sequence[str], id_col: str, seed: int,
               ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """One row per stratum: strata (as ``_s0``..), ``_n`` and ``_cuts``, the ``(hash, id)`` at
    each of ``ranks(n)`` (ranks below 1 have no row and no entry)."""
    names = [f"_s{i}" for i in range(len(strata))]
    base = df.select(*(F.col(s).alias(n) for s, n in zip(strata, names)), F.col(id_col).alias("_id"),
                     row_hash(id_col, seed).alias("_h")).withColumn("_b", F.substring("_h", 1, DIGITS))
    counts = base.groupBy(*names, "_b").agg(F.count(F.lit(1)).alias("_c"))
    one = [F.lit(0)] if not names else names
    upto = Window.partitionBy(*one).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = counts.select(*names, "_b", "_c", F.sum("_c").over(upto).alias("_upto"), F.sum("_c").over(Window.partitionBy(*one)).alias("_n"))
    wanted = F.array(*(F.struct(F.lit(j).alias("j"), r.cast("long").alias("r")) for j, r in enumerate(ranks(F.col("_n")))))
    wanted = totals.withColumn("_w", F.explode(wanted)).where(
        (F.col("_w.r") <= F.col("_upto")) & (F.col("_w.r") > F.col("_upto") - F.col("_c")))
    wanted = cut(wanted.select(*(F.col(n).alias(f"_w{n}") for n in names), F.col("_b").alias("_wb"), F.col("_w.j").alias("_j"),
                               (F.col("_w.r") - F.col("_upto") + F.col("_c")).alias("_k"), "_n"), "split-digits")
    same = [F.col(n).eqNullSafe(F.col(f"_w{n}")) for n in names] + [F.col("_b") == F.col("_wb")]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    order = Window.partitionBy(*names, "_b", "_j").orderBy("_h", "_id")
    found = base.join(wanted, cond).withColumn("_r", F.row_number().over(order)).where("_r = _k")
    return cut(found.groupBy(*names).agg(
        F.max("_n").alias("_n"), F.sort_array(F.collect_list(F.struct("_h", "_id"))).alias("_cuts")), "split-cuts")


def assign_by_rank(df: DataFrame, strata: Sequence[str], id_col: str, seed: int,
                   ranks: Callable[[Column], list[Column]], out: str) -> DataFrame:
    """Add ``out`` (int): how many of its stratum's ``ranks(n)`` the row's rank exceeds.

    Rows with equal ids share a side. A stratum without any entry lies beyond all ranks."""
    n_ranks = len(ranks(F.lit(1)))
    cuts = cut_points(df, strata, id_col, seed, ranks)
    n_strata = cuts.count()
    names = [f"_s{i}" for i in range(len(strata))]
    work = df.withColumn("_h", row_hash(id_col, seed))
    cond = F.lit(True)
    for s, n in zip(strata, names):
        cond = cond & df[s].eqNullSafe(cuts[n])
    if not names:  # one row for the whole table
        row = cuts.first()
        points = [(r["_h"], r["_id"]) for r in row["_cuts"]] if row else []
        beyond = F.lit(n_ranks - len(points))
        for h, i in points:
            beyond = beyond + _after(F.lit(h), F.lit(i), id_col).cast("int")
        return work.withColumn(out, beyond).drop("_h")
    joined = work.join(bounded_broadcast(cuts.drop("_n"), n_strata), cond, "left")
    own = F.coalesce(F.filter("_cuts", lambda c: _after(c["_h"], c["_id"], id_col)), F.array())
    found = F.coalesce(F.size("_cuts"), F.lit(0))
    return joined.withColumn(out, (F.lit(n_ranks) - F.when(F.col("_cuts").isNull(), 0).otherwise(found) + F.size(own)).cast("int")).drop(
        "_h", "_cuts", *names)


def _after(h: Column, i: Column, id_col: str) -> Column:
    return F.coalesce((F.col("_h") > h) | ((F.col("_h") == h) & (F.col(id_col) > i)), F.lit(False))
