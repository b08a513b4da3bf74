import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskframe.operators.split import assign_split, kfold_assign, split_summary


def _frame(spark, n=1000, pos=10):
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame({"txn_id": np.arange(n), "Amount": rng.exponential(88, n),
                        "Class": [0] * (n - pos) + [1] * pos})
    return spark.createDataFrame(pdf)


def test_sizes_64_16_20(spark):
    s = assign_split(_frame(spark))
    c = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert c == {"train": 640, "val": 160, "test": 200}


def test_disjoint_and_complete(spark):
    s = assign_split(_frame(spark))
    assert s.select("txn_id").distinct().count() == 1000
    assert s.count() == 1000


def test_class_ratio_kept(spark):
    summ = {r["split"]: r for r in split_summary(assign_split(_frame(spark))).collect()}
    for r in summ.values():
        assert abs(r["positive_pct"] / 100 - 0.01) <= 0.02


def test_target_kept_and_unstratified(spark):
    s = assign_split(_frame(spark), stratify=False)
    assert "Class" in s.columns
    assert s.where(F.col("split") == "test").count() == 200


def test_partitioning_invariance(spark):
    df = _frame(spark)
    a = {r["txn_id"]: r["split"] for r in assign_split(df.repartition(1)).collect()}
    b = {r["txn_id"]: r["split"] for r in assign_split(df.repartition(7)).collect()}
    assert a == b


def _brute(pdf, seed, k):
    import hashlib

    pdf = pdf.copy()
    pdf["h"] = [hashlib.md5(f"{i}|{seed}".encode()).hexdigest() for i in pdf.txn_id]
    pdf = pdf.sort_values(["Class", "h", "txn_id"])
    r = pdf.groupby("Class", dropna=False).cumcount() + 1
    n = pdf.groupby("Class", dropna=False)["txn_id"].transform("count")
    fold = sum((r > n * j // k).astype(int) for j in range(1, k))
    test = (0.2 * n).round()
    split = np.where(r <= test, "test", np.where(r <= test + (0.2 * (n - test)).round(), "val", "train"))
    return dict(zip(pdf.txn_id, zip(fold, split)))


def test_cuts_equal_ranks(spark):
    df = _frame(spark, 3000, 40)
    both = assign_split(kfold_assign(df, k=7))
    got = {r["txn_id"]: (r["fold"], r["split"]) for r in both.collect()}
    assert got == _brute(df.toPandas(), 42, 7)


def test_no_data_column_is_shuffled(spark):
    plan = assign_split(_frame(spark).withColumn("wide", F.concat(F.lit("x"), F.col("Amount").cast("string"))))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan


def test_null_strata_and_repeated_ids(spark):
    rows = [(i, None if i % 3 == 0 else i % 2) for i in range(90)] + [(5, 1), (5, 1), (None, 0)]
    df = spark.createDataFrame(rows, "txn_id long, Class int")
    out = assign_split(df)
    assert out.count() == 93 and out.where("split is null").count() == 0
    nulls = {r["split"]: r["count"] for r in out.where("Class is null").groupBy("split").count().collect()}
    assert nulls == {"train": 19, "val": 5, "test": 6}
    assert assign_split(df.limit(0)).count() == 0 and kfold_assign(df.limit(0), stratify=False).count() == 0


def test_kfold_balanced(spark):
    f = kfold_assign(_frame(spark), k=5)
    counts = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert sorted(counts) == [200] * 5
    pos = [r["p"] for r in f.groupBy("fold").agg(F.sum("Class").alias("p")).collect()]
    assert sorted(pos) == [2] * 5


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=300), st.integers(0, 10**6), st.sampled_from([2, 5]))
def test_cuts_property_random_strata(spark, strata, seed, k):
    pdf = pd.DataFrame({"txn_id": np.arange(len(strata)), "Class": strata})
    both = assign_split(kfold_assign(spark.createDataFrame(pdf), k=k, seed=seed), seed=seed)
    got = {r["txn_id"]: (r["fold"], r["split"]) for r in both.collect()}
    want = _brute(pdf, seed, k)
    assert got == want
