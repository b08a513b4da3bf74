"""Windowed drift on a stream (continuous monitoring re-aimed as Structured Streaming).

Each event gets a bin of the reference's equal-width [min, max] grid (two literals
computed once from the reference); a watermarked ``window(ts, '1 day')`` count per
(window, bin) runs in append mode, so state is dropped as the watermark passes and
the last window stays open until later data closes it. PSI per closed window is a
small batch job on the emitted counts against the reference shares (10 rows,
broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.operators.drift import PSI_BINS, PSI_EPS


def reference_edges(reference: DataFrame, value_col: str) -> tuple[float, float]:
    row = reference.agg(F.min(value_col).alias("lo"), F.max(value_col).alias("hi")).first()
    return float(row["lo"]), float(row["hi"])


def _bin(value: F.Column, lo: float, hi: float, bins: int) -> F.Column:
    if hi <= lo:
        return F.lit(0)
    return F.least(F.greatest(F.floor((value - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(0)), F.lit(bins - 1)).cast("int")


def reference_shares(reference: DataFrame, value_col: str, lo: float, hi: float, bins: int = PSI_BINS) -> DataFrame:
    c = reference.where(F.col(value_col).isNotNull()).groupBy(_bin(F.col(value_col), lo, hi, bins).alias("bin")).count()
    grid = reference.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = grid.join(c, "bin", "left").fillna(0, ["count"])
    tot = F.sum("count").over(Window.partitionBy())  # over the `bins` rows of the grid
    return full.select("bin", (F.col("count") / tot).alias("p_ref"))


def window_counts(events: DataFrame, ts_col: str, value_col: str, lo: float, hi: float, window: str = "1 day",
                  watermark: str = "1 day", bins: int = PSI_BINS) -> DataFrame:
    """(window, bin) counts of a stream, or of a table (whose windows are all open)."""
    ev = events.select(F.col(ts_col).cast("timestamp").alias("ts"), F.col(value_col).cast("double").alias("v"))
    return (
        ev.where(F.col("v").isNotNull())
        .withWatermark("ts", watermark)
        .groupBy(F.window("ts", window).alias("w"), _bin(F.col("v"), lo, hi, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "bin", "n")
    )


def start_window_counts(stream: DataFrame, ts_col: str, value_col: str, lo: float, hi: float, out_dir: str,
                        checkpoint: str, window: str = "1 day", watermark: str = "1 day",
                        bins: int = PSI_BINS, available_now: bool = True):
    """Streaming (window, bin) counts, appended to parquet at ``out_dir`` as windows close."""
    counts = window_counts(stream, ts_col, value_col, lo, hi, window, watermark, bins)
    w = counts.writeStream.outputMode("append").format("parquet").option("path", out_dir) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def window_psi(spark: SparkSession, counts_dir: str, ref_shares: DataFrame, bins: int = PSI_BINS,
               eps: float = PSI_EPS) -> DataFrame:
    """PSI per emitted window."""
    return psi_of_counts(spark.read.parquet(counts_dir), ref_shares, bins, eps)


def psi_of_counts(c: DataFrame, ref_shares: DataFrame, bins: int = PSI_BINS, eps: float = PSI_EPS) -> DataFrame:
    """PSI per window of (window, bin) counts: ``sum (c - r) ln(c / r)``, shares floored at ``eps``."""
    c = c.select("window_start", "window_end", "bin", "n")
    wins = c.select("window_start", "window_end").distinct()
    grid = wins.select("window_start", "window_end", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(c, ["window_start", "window_end", "bin"], "left").fillna(0, ["n"]) \
        .join(F.broadcast(ref_shares), "bin")  # `bins` rows
    tot = full.groupBy("window_start").agg(F.sum("n").alias("_t"))
    j = full.join(tot, "window_start")
    pc = F.greatest(F.col("n") / F.col("_t"), F.lit(eps))
    pr = F.greatest(F.col("p_ref"), F.lit(eps))
    return j.groupBy("window_start", "window_end").agg(
        F.round(F.sum((pc - pr) * F.log(pc / pr)), 6).alias("psi"), F.sum("n").cast("long").alias("rows")
    )
