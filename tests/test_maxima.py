"""Maxima by bucket bounds: the same results as from all rows, and few buckets sorted."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import drift as D
from riskframe.operators import metrics as M
from riskframe.plans.maxima import bucket_bounds


def _scores(spark, n, seed):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        y = int(r.random() < 0.05)
        rows.append((r.choice(["a", "b", None]), y, round(min(1.0, max(0.0, r.gauss(0.3 + 0.4 * y, 0.15))), 4)))
    return spark.createDataFrame(rows, "k string, Class int, score double")


@pytest.mark.parametrize("least", [1, 7, 256])
def test_best_threshold_is_that_of_the_whole_curve(spark, least):
    df = _scores(spark, 6000, least).unionByName(spark.createDataFrame(
        [("none", 0, 0.5), ("none", 0, 0.7), ("one", 1, 0.2), ("a", 1, None), ("a", None, 0.3), ("b", 1, float("nan"))],
        "k string, Class int, score double"))
    whole = M.best_threshold(M.score_curve(df, keys=["k"]), ["k"])
    bounded = M.best_threshold_by_bounds(df, keys=["k"], least_buckets=least)
    assert sorted(map(str, whole.collect())) == sorted(map(str, bounded.collect()))
    assert M.best_threshold_by_bounds(df, least_buckets=least).first() == M.best_threshold(M.score_curve(df)).first()


def test_ties_take_the_lowest_threshold(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (0, 0.7), (1, 0.6), (1, 0.4), (0, 0.1)], "Class int, score double")
    for least in (1, 2, 6, 50):
        got = M.best_threshold_by_bounds(df, least_buckets=least).first()
        assert got == M.best_threshold(M.score_curve(df)).first()


def test_few_buckets_are_sorted(spark):
    df = _scores(spark, 20_000, 5).select("score", F.col("Class").cast("long").alias("tp"), (1 - F.col("Class")).cast("long").alias("fp"),
                                          F.lit(0).alias("all"))
    upper, lower = M.f1_bounds()
    _, table, _ = bucket_bounds(df, ["all"], "score", ["tp", "fp"], upper, lower, descending=True)
    r = table.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("alive").cast("int")).alias("alive")).first()
    assert r["n"] > 200 and 1 <= r["alive"] <= r["n"] / 4


@pytest.mark.parametrize("least", [1, 5, 256])
def test_ks_equals_the_full_sort(spark, least):
    r = random.Random(least)
    ref = spark.createDataFrame([(r.gauss(0, 1), float(r.randrange(5)), None) for _ in range(3000)], "x double, y double, z double")
    cur = spark.createDataFrame([(r.gauss(0.2, 1.1), float(r.randrange(6)), 1.0) for _ in range(2000)], "x double, y double, z double")
    names = ["feature", "ks_d", "p_value", "drift", "n_ref", "n_cur"]
    whole = D.numeric_drift(ref, cur, ["x", "y", "z"]).select(names).orderBy("feature").collect()
    assert D.ks_test(ref, cur, ["x", "y", "z"], least_buckets=least).select(names).orderBy("feature").collect() == whole


def test_ks_sorts_few_buckets(spark):
    ref = spark.range(20_000).select((F.col("id") / 20_000).alias("x"))
    cur = ref.select(F.pow("x", F.lit(1.5)).alias("x"))
    rows = D.side_by_side(ref, cur, ["x"]).select(
        "feature", "value", (F.col("side") == 0).cast("long").alias("r"), (F.col("side") == 1).cast("long").alias("c"))
    upper, lower = D.gap_bounds()
    _, table, _ = bucket_bounds(rows, ["feature"], "value", ["r", "c"], upper, lower, descending=False)
    n, alive = table.agg(F.count(F.lit(1)), F.sum(F.col("alive").cast("int"))).first()
    assert n > 200 and 1 <= alive <= n / 4


def test_ks_buckets_follow_the_rows(spark):
    """A gap by chance falls with the root of the rows: few of the buckets must hold it all the same."""
    rows = spark.range(200_000).select(F.rand(3).alias("x"), (F.rand(5) < 0.8).alias("ref"))
    both = D._wide(rows.where("ref"), rows.where("not ref"), ["x"])
    (counts, alive), = D.ks_buckets(both, D.ks_cuts(both, 1, 256))
    assert counts.sum() == 200_000
    assert counts[:, alive].sum() <= 200_000 / 4


def test_ks_of_extreme_and_missing_values(spark):
    ref = spark.createDataFrame([(float("inf"), None, 0.0), (float("-inf"), None, -0.0), (1.0, None, float("nan"))], "x double, y double, z double")
    cur = spark.createDataFrame([(1.0, None, 0.0), (2.0, None, None)], "x double, y double, z double")
    names = ["feature", "ks_d", "p_value", "drift", "n_ref", "n_cur"]
    whole = D.numeric_drift(ref, cur, ["x", "y", "z"]).select(names).orderBy("feature").collect()
    assert D.ks_test(ref, cur, ["x", "y", "z"]).select(names).orderBy("feature").collect() == whole
    assert D.ks_test(ref, cur.limit(0), ["x", "y"]).select(names).collect() == D.numeric_drift(ref, cur.limit(0), ["x", "y"]).select(names).collect()


def test_empty_table(spark):
    df = _scores(spark, 0, 1)
    assert M.best_threshold_by_bounds(df, keys=["k"]).count() == 0
