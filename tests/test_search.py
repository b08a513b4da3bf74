"""Trials side by side give what they give one after the other; weak ones are stopped at a rung."""

import time

import pytest
from pyspark.sql import functions as F

from riskframe.operators.train import TrainConfig, fit_score, ladder, tune_model


@pytest.fixture(scope="module")
def frame(spark):
    rows = spark.range(900).select(
        (F.col("id") % 97 / 97.0).alias("a"), (F.col("id") % 31 / 31.0).alias("b"), (F.hash("id") % 50 / 50.0).alias("c"),
        ((F.col("id") % 97 + F.col("id") % 31 + F.hash("id") % 20) > 90).cast("int").alias("Class"),
        F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.col("id") % 3 + 1).cast("int")).alias("split"))
    return rows.cache()


def test_parallel_equals_sequential(frame):
    cfg = TrainConfig(feature_cols=["a", "b", "c"], max_iter=3, fixed={"maxDepth": 3})
    seconds, found = [], []
    for parallelism in (1, 4):
        start = time.monotonic()
        best, trials = tune_model("rf", frame, cfg, n_trials=6, parallelism=parallelism, rungs=1)
        seconds.append(time.monotonic() - start)
        found.append((best, sorted(map(str, trials.collect()))))
    print(f"one by one {seconds[0]:.1f} s, four at a time {seconds[1]:.1f} s")
    assert found[0] == found[1]
    assert all("rounds=3" in row for row in found[0][1])


def test_rungs(frame):
    assert ladder(1000, 3, 3) == [111, 333, 1000] and ladder(2, 3, 3) == [1, 2] and ladder(9, 1, 3) == [9]
    cfg = TrainConfig(feature_cols=["a", "b", "c"], max_iter=9, fixed={"maxDepth": 2})
    best, trials = tune_model("rf", frame, cfg, n_trials=9, rungs=3)
    again = tune_model("rf", frame, cfg, n_trials=9, rungs=3, parallelism=2)
    rows = trials.orderBy("trial").collect()
    assert again[0] == best and again[1].orderBy("trial").collect() == rows
    assert sorted(r["rounds"] for r in rows) == [1] * 6 + [3] * 2 + [9]
    # what goes on was better than what stopped, on the same rung
    top = [r for r in rows if r["rounds"] == 9]
    assert len(top) == 1 and top[0]["params"] and "maxDepth" in best


def test_budget_over_leaves_the_first_trial(frame):
    cfg = TrainConfig(feature_cols=["a"], max_iter=2, fixed={"maxDepth": 2})
    _, trials = tune_model("rf", frame, cfg, n_trials=5, timeout_s=-1.0, rungs=1)
    assert [r["trial"] for r in trials.collect()] == [0]
    assert tune_model("rf", frame, cfg, n_trials=0)[1].count() == 0


def test_boosting_trials_use_the_val_rows(frame):
    cfg = TrainConfig(feature_cols=["a", "b"], max_iter=2, fixed={"maxDepth": 2})
    best, trials = tune_model("gbt", frame, cfg, n_trials=3, rungs=2)
    assert trials.agg(F.max("rounds")).first()[0] == 2
    assert fit_score("gbt", best, frame, cfg).transform(frame).where("score is null").count() == 0
