"""Fold-routed scoring equals a union of scans; a run is in the log as a whole or not at all."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators.ensemble import oof_base_scores, route_by_fold
from riskframe.operators.split import kfold_assign
from riskframe.sources.io import RunLog


class _Mean:
    """A scorer that depends on the rows it was fitted on."""

    def __init__(self, frame):
        self.mean = frame.agg(F.avg("x")).first()[0]

    def transform(self, df):
        return df.withColumn("probability", F.lit(1.0)).withColumn("score", F.col("x") * F.lit(self.mean)).drop("probability")


def _rows(spark):
    return spark.range(200).select(F.col("id").alias("txn_id"), (F.col("id") % 17 + F.rand(1)).alias("x"), (F.col("id") % 4 == 0).cast("int").alias("Class"))


def test_routed_scores_equal_a_union_of_folds(spark):
    df = _rows(spark)
    got = oof_base_scores(df, [("a", _Mean), ("b", lambda f: _Mean(f.where("Class = 0")))], k=5)
    assert got.columns == ["txn_id", "x", "Class", "score_a", "score_b"]
    folded = kfold_assign(df, k=5).collect()
    spark_folded = spark.createDataFrame(folded, kfold_assign(df, k=5).schema)
    want = {}
    for f in range(5):
        rest = spark_folded.where(F.col("fold") != f)
        a, b = _Mean(rest).mean, _Mean(rest.where("Class = 0")).mean
        want.update({r["txn_id"]: (r["x"] * a, r["x"] * b) for r in folded if r["fold"] == f})
    for r in got.collect():
        assert (r["score_a"], r["score_b"]) == pytest.approx(want[r["txn_id"]], rel=1e-12)


def test_one_scan_whatever_the_folds(spark, tmp_path):
    path = str(tmp_path / "folds")
    kfold_assign(_rows(spark), k=5).write.parquet(path)
    df = spark.read.parquet(path)
    plan = route_by_fold(df, [("a", [_Mean(df) for _ in range(5)])])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan and "Exchange" not in plan


def test_a_broken_run_is_invisible(spark, tmp_path, monkeypatch):
    log = RunLog(spark, str(tmp_path / "log"))
    first = log.log("gbt", {"depth": 3, "rate": 0.1}, {"pr_auc": 0.5, "none": None})
    frame = spark.createDataFrame([("x", 0.25, 3)], "name string, pr_auc double, n int").withColumn("empty", F.lit(None).cast("double"))
    second = log.log("rf", {}, frame)
    real = RunLog._append

    def broken(self, table, rows):
        if table == "runs":
            raise OSError("disk")
        real(self, table, rows)

    monkeypatch.setattr(RunLog, "_append", broken)
    with pytest.raises(OSError):
        log.log("lost", {"depth": 9}, {"pr_auc": 0.9})
    assert {r["run_id"] for r in log.table("runs").collect()} == {first, second}
    assert sorted((r["run_id"] == first, r["k"], r["v"]) for r in log.table("run_metrics").collect()) == [
        (False, "n", 3.0), (False, "pr_auc", 0.25), (True, "pr_auc", 0.5)]
    assert {(r["run_id"], r["k"], r["v"]) for r in log.table("run_params").collect()} == {(first, "depth", "3"), (first, "rate", "0.1")}
    assert spark.read.parquet(str(tmp_path / "log" / "run_params")).count() == 3  # written, but of no run
