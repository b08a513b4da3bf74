"""Distribution drift per window of a stream, many features at once, with late rows kept.

Each micro-batch turns its rows into mergeable quantile sketches (KLL), one per (window, feature),
and writes three folders named by its batch id: rows that came behind the watermark (``late``, as
they are), the sketches, and last a mark (its largest event time and its counts). A replayed batch
overwrites its folders, and readers only follow marks, so a batch counts as a whole or not at all.

* The watermark of a batch is the largest event time of the batches before it, less the delay; a row
  whose window ended by then is late, a row without a time too. Nothing is dropped: rows in
  windows, open or closed, and late rows add up to the input.
* Windows are merged sketches, however many batches fed them. What grows is a sketch per (batch,
  window, feature), not the rows.
* KS and W1 compare a window with the reference at ``points`` exact quantiles of the reference, on
  both sides of every point. KS is off by at most ``ks_error``: the rank error of the sketch (0 while
  it holds all values, else that of KLL at 99 % confidence) and the largest share of the reference
  strictly between two points. W1 takes the mean of the distances at both ends of a step between
  points; ``w1_error`` bounds what it is off by: the shares of both sides strictly inside each step,
  and what the window has beyond the reference's range.

NULL and NaN values count as rows of their window, not as values. A window without values has NULL
measures.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.exprs import nan_to_null
from riskframe.operators.drift import ROUND, ks_pvalue
from riskframe.plans.quantiles import select_ranks
from riskframe.plans.workers import ship

SKETCH_K = 4096
POINTS = 256


def _tagged(batch: DataFrame, ts_col: str, window: str, delay: str, mark) -> DataFrame:
    """The rows with their window, and whether they came behind the watermark."""
    ts = F.col(ts_col).cast("timestamp")
    # a window of a NULL time would drop the row
    w = F.window(F.coalesce("_ts", F.lit("1970-01-01").cast("timestamp")), window)
    late = F.col("_ts").isNull()
    if mark is not None:
        late = late | (F.col("_window.end") <= F.lit(mark) - F.expr(f"INTERVAL {delay}"))
    return batch.withColumn("_ts", ts).withColumn("_window", F.when(F.col("_ts").isNotNull(), w)).withColumn("_late", late)


def window_sketches(rows: DataFrame, features: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """(window_start, window_end, feature): rows, n (values) and the sketch of the values."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), nan_to_null(F.col(c).cast("double")).alias("v")) for c in features)))
    return rows.select("_window", each.alias("_f")).groupBy(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), F.col("_f.feature").alias("feature")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("_f.v").alias("n"), F.kll_sketch_agg_double("_f.v", F.lit(k)).alias("sketch"))


def _marks(spark: SparkSession, out_dir: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/marks")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema("max_ts timestamp, rows long, late long, batch_id long").parquet(f"{out_dir}/marks")


def _write_batch(out_dir: str, ts_col: str, features: Sequence[str], window: str, delay: str, k: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = _marks(spark, out_dir)
        mark = None if marks is None else marks.where(F.col("batch_id") < batch_id).agg(F.max("max_ts")).first()[0]
        rows = _tagged(batch, ts_col, window, delay, mark).persist()
        try:
            rows.where("_late").select(*batch.columns).write.mode("overwrite").parquet(f"{out_dir}/late/batch_id={batch_id}")
            window_sketches(rows.where("NOT _late"), features, k).write.mode("overwrite").parquet(f"{out_dir}/sketches/batch_id={batch_id}")
            rows.agg(F.max("_ts").alias("max_ts"), F.count(F.lit(1)).alias("rows"), F.count_if("_late").alias("late")).write.mode(
                "overwrite").parquet(f"{out_dir}/marks/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return write


def start_windows(stream: DataFrame, ts_col: str, features: Sequence[str], out_dir: str, checkpoint: str, window: str = "1 day",
                  delay: str = "1 day", k: int = SKETCH_K, available_now: bool = True):
    """Start the query that keeps sketches, late rows and marks under ``out_dir`` (a shared folder)."""
    w = stream.writeStream.foreachBatch(_write_batch(out_dir, ts_col, features, window, delay, k)).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def windows(spark: SparkSession, out_dir: str, delay: str = "1 day") -> DataFrame:
    """(window_start, window_end, feature, rows, n, sketch, closed) over all whole batches."""
    marks = _marks(spark, out_dir)
    sketches = spark.read.parquet(f"{out_dir}/sketches").join(marks.select("batch_id"), "batch_id", "left_semi")
    last = marks.agg(F.max("max_ts")).first()[0]
    closed = F.lit(False) if last is None else F.col("window_end") <= F.lit(last) - F.expr(f"INTERVAL {delay}")
    return sketches.groupBy("window_start", "window_end", "feature").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")).withColumn("closed", closed)


def late_rows(spark: SparkSession, out_dir: str) -> DataFrame:
    """The rows that came behind the watermark, with the batch that brought them."""
    return spark.read.parquet(f"{out_dir}/late").join(_marks(spark, out_dir).select("batch_id"), "batch_id", "left_semi")


def counts(spark: SparkSession, out_dir: str) -> dict[str, int]:
    """Rows read and rows late, over all whole batches."""
    r = _marks(spark, out_dir).agg(F.sum("rows").alias("rows"), F.sum("late").alias("late")).first()
    return {"rows": int(r["rows"] or 0), "late": int(r["late"] or 0)}


def reference_points(reference: DataFrame, features: Sequence[str], points: int = POINTS) -> dict[str, dict]:
    """Per feature: points q, the shares at most q and under q, the largest share strictly between two
    points, the number of values, their deviation and range. Two kinds of counting scans, no sort."""
    ref = reference.select(*(nan_to_null(F.col(c).cast("double")).alias(c) for c in features))
    grid = {}
    for _, c, n, at in select_ranks(ref, list(features), [j / points for j in range(points + 1)]):
        grid[c] = np.unique([at[math.floor(j / points * (n - 1))] for j in range(points + 1)])
    ship(reference.sparkSession)
    names = list(features)

    def count(parts):
        total = {c: np.zeros(2 * len(q) + 1, dtype=np.int64) for c, q in grid.items()}
        for p in parts:
            for c, q in grid.items():
                v = p[names[c]].to_numpy(dtype=np.float64)
                v = v[~np.isnan(v)]
                at = np.searchsorted(q, v, side="left")
                equal = q[np.minimum(at, len(q) - 1)] == v
                total[c] += np.bincount(2 * at + equal, minlength=2 * len(q) + 1)
        for c, t in total.items():
            yield pd.DataFrame({"c": np.full(len(t), c, dtype=np.int32), "cell": np.arange(len(t), dtype=np.int32), "n": t})

    cells = ref.mapInPandas(count, "c int, cell int, n long").groupBy("c", "cell").agg(F.sum("n").alias("n")).collect()
    spread = ref.agg(*(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(names))).first()
    out = {}
    for c, q in grid.items():
        t = np.zeros(2 * len(q) + 1, dtype=np.int64)
        for r in cells:  # two a point
            if r["c"] == c:
                t[r["cell"]] = r["n"]
        upto = np.cumsum(t)
        out[names[c]] = {"q": q, "incl": upto[1::2] / upto[-1], "excl": upto[:-1:2] / upto[-1], "gap": float(t[::2].max() / upto[-1]),
                         "n": int(upto[-1]), "sd": spread[f"s{c}"]}
    return out


def rank_error(k: int) -> float:
    """Rank error of a KLL sketch at 99 % confidence."""
    return 2.296 / k ** 0.9021


def drift_of_windows(wins: DataFrame, reference: dict[str, dict], k: int = SKETCH_K, threshold: float = 0.05) -> DataFrame:
    """Per window and feature: ks, ks_error, p_value, drift, w1, w1_error, w1_norm, rows, n, closed."""
    def per_feature(of):
        out = F.lit(None)
        for name, r in reference.items():
            out = F.when((F.col("feature") == name) & (F.col("n") > 0), of(r)).otherwise(out)
        return out

    def literal(values) -> F.Column:
        return F.lit([float(v) for v in values])

    incl = per_feature(lambda r: F.kll_sketch_get_rank_double("sketch", literal(r["q"])))
    excl = per_feature(lambda r: F.kll_sketch_get_rank_double("sketch", literal(np.nextafter(r["q"], -np.inf))))
    gap = lambda a, b: F.abs(a - b)
    j = wins.withColumns({"_i": incl, "_e": excl}).withColumns({
        "_di": F.zip_with("_i", per_feature(lambda r: literal(r["incl"])), gap), "_de": F.zip_with("_e", per_feature(lambda r: literal(r["excl"])), gap),
        "_step": per_feature(lambda r: literal(np.diff(r["q"]))), "_m": per_feature(lambda r: F.lit(r["n"])).cast("long"),
        "_least": F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.0))),
        "_most": F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(1.0))),
        "_gap": per_feature(lambda r: F.lit(r["gap"])), "_sd": per_feature(lambda r: F.lit(r["sd"]).cast("double"))})
    ks = F.greatest(F.array_max("_di"), F.array_max("_de"))
    # between two points the distance lies about halfway between its values at the ends
    ends = F.zip_with(F.slice("_di", F.lit(1), F.size("_step")), F.slice("_de", F.lit(2), F.size("_step")), lambda a, b: (a + b) / 2)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda t, v: t + v)
    product = lambda a, b: total(F.zip_with(a, b, lambda x, y: x * y))
    # shares strictly inside each step: under its end less up to its start
    inside_w = F.zip_with(F.slice("_e", F.lit(2), F.size("_step")), F.slice("_i", F.lit(1), F.size("_step")), lambda x, y: x - y)
    inside_r = per_feature(lambda r: literal(r["excl"][1:] - r["incl"][:-1]))
    low, high = (per_feature(lambda r, i=i: F.lit(float(r["q"][i]))) for i in (0, -1))
    eps = F.when(F.col("n") <= k, 0.0).otherwise(rank_error(k))
    beyond = (F.greatest(low - F.col("_least"), F.lit(0.0)) * (F.get("_e", F.lit(0)) + eps)
              + F.greatest(F.col("_most") - high, F.lit(0.0)) * (F.lit(1.0) - F.element_at("_i", -1) + eps))
    w1 = F.when(F.col("n") > 0, product(ends, F.col("_step")))
    w1_error = F.when(F.col("n") > 0, product(inside_w, F.col("_step")) + product(inside_r, F.col("_step")) + 3 * eps * total(F.col("_step")) + beyond)
    j = j.withColumns({"_ks": ks, "_w1": w1, "_w1e": w1_error}).withColumn("_p", ks_pvalue(F.col("_ks"), F.col("_m"), F.col("n")))
    return j.select("window_start", "window_end", "feature", F.round("_ks", ROUND).alias("ks"),
                    F.round(F.col("_gap") + eps, ROUND).alias("ks_error"),
                    F.round("_p", ROUND).alias("p_value"), (F.col("_p") < threshold).alias("drift"), F.round("_w1", ROUND).alias("w1"),
                    F.round("_w1e", ROUND).alias("w1_error"),
                    F.round(F.try_divide("_w1", "_sd"), ROUND).alias("w1_norm"), "rows", "n", "closed")
