import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.functions.search import count_below
from riskframe.operators import profile as A
from riskframe.plans.quantiles import exact_quantiles, select_ranks


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    wide = pd.DataFrame({"x": rng.integers(0, 500, 3000).astype(float), "y": rng.normal(0, 1e-300, 3000), "z": -rng.pareto(0.2, 3000), "one": -0.0})
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = exact_quantiles(spark.createDataFrame(wide).repartition(5), list(wide), probs).collect()
    assert len(got) == len(probs) * 4
    for r in got:
        assert r["q"] == pytest.approx(np.percentile(wide[r["feature"]], r["p"] * 100), rel=1e-12, abs=0)


def test_selected_ranks_are_the_sorted_values(spark):
    """Values bit by bit, per group and over all, with NULLs, NaN, infinities and both zeros."""
    rows = [(k, v) for k in ("a", "b", None) for v in (0.0, -0.0, 1.5, -1.5, float("inf"), float("-inf"), 5e-324, -5e-324, 1e308)]
    rows += [("b", None), ("b", float("nan")), ("c", None)] + [("a", 7.0)] * 50
    df = spark.createDataFrame(rows, "g string, v double")
    got = {g: (n, at) for g, _, n, at in select_ranks(df, ["v"], [i / 40 for i in range(41)], by="g")}
    assert set(got) == {"=a", "=b", "-", "all"}
    for g, (n, at) in got.items():
        values = [v for k, v in rows if v is not None and (g == "all" or g == ("-" if k is None else "=" + k))]
        want = sorted(values, key=lambda v: (v != v, v))
        assert n == len(want)
        for rank, v in at.items():
            assert v == want[rank] or (v != v and want[rank] != want[rank])
    assert exact_quantiles(df.limit(0), ["v"], [0.5]).count() == 0


def test_only_counts_are_shuffled(spark):
    """The plan of a round sorts no data and exchanges counts by group, column and digit."""
    from riskframe.plans.quantiles import _counter

    df = spark.range(1000).select(F.col("id").cast("double").alias("_c0"))
    plan = df.mapInArrow(_counter(["v"], 0, None, True, False), "g string, c int, head long, digit long, n long").groupBy(
        "g", "c", "head", "digit").agg(F.sum("n").alias("n"))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan and "Sort" not in plan
    assert plan.count("Exchange") == 1 and "hashpartitioning(g" in plan


def test_count_below(spark):
    df = spark.createDataFrame([(x,) for x in [-1.0, 0.0, 0.5, 1.0, 2.5, 9.0]], "v double")
    cuts = F.array(*[F.lit(c) for c in [0.0, 1.0, 1.0, 2.0, 3.0]])
    got = [r[0] for r in df.select(count_below(cuts, F.col("v"), 5)).collect()]
    assert got == [0, 0, 1, 1, 4, 5]


def test_histogram_counts_and_bins(spark):
    rng = np.random.default_rng(1)
    v = rng.uniform(0, 10, 1000)
    df = spark.createDataFrame(pd.DataFrame({"feature": "x", "value": v}))
    h = A.histogram(df, 10).orderBy("bin").collect()
    assert len(h) == 10 and sum(r["count"] for r in h) == 1000
    assert list(np.histogram(v, 10)[0]) == [r["count"] for r in h]


def test_iqr_outliers_and_duplicates(spark):
    vals = [1.0, 2.0, 3.0, 4.0] * 10 + [1000.0]
    df = spark.createDataFrame([(v, 0) for v in vals], "x double, Class int")
    out = A.iqr_outliers(df, ["x"]).collect()
    assert len(out) == 1 and out[0]["outliers"] == 1
    d = A.duplicates(df, ["x", "Class"]).first()
    assert d["duplicate_rows"] == 36


def test_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 0)], "c double, Class int")
    assert A.corr_with_target(df, ["c"]).first()["corr"] is None


def test_registered_queries_smoke(spark, sf):
    import __spark_entry__ as E

    assert E.entry(spark).count() == 3
    assert set(E.oracle_sql()) <= set(E.queries())


def test_csv_source_roundtrip_and_missing(spark, tmp_path):
    from riskframe.sources import io
    from riskframe.sources.tables import TXN_FEATURES

    rows = [tuple(float(i + j) for j in range(len(TXN_FEATURES))) + (i % 2,) for i in range(6)]
    rows.append(rows[0])  # a duplicate row keeps its own id
    df = spark.createDataFrame(rows, io.TXN_SCHEMA)
    path = str(tmp_path / "txn_csv")
    df.coalesce(1).write.option("header", True).csv(path)
    back = io.load_transactions(spark, path)
    assert back.count() == 7 and back.select("txn_id").distinct().count() == 7
    with pytest.raises(FileNotFoundError):
        io.load_transactions(spark, str(tmp_path / "nope.csv"))


def test_missing_pipeline_and_report_raise(spark, tmp_path):
    from riskframe.sources import io

    with pytest.raises(FileNotFoundError):
        io.load_pipeline(spark, str(tmp_path / "no_pipeline"))
    with pytest.raises(FileNotFoundError):
        io.load_drift_report(spark, str(tmp_path / "no_report"))


def test_moments_of_many_columns_in_one_scan(spark):
    """300 columns: one job over the rows, exact beside NumPy, with gaps and a large mean."""
    from riskframe.plans.moments import cross_moments

    rng = np.random.default_rng(2)
    n, m = 400, 300
    x = rng.normal(size=(n, m)) @ rng.normal(size=(m, m)) / 10
    x[:, 0] = 1e9 + rng.normal(size=n)  # a spread of 1 beside a mean of a billion
    x[:, 1] = x[:, 0] + rng.normal(size=n)
    x[:, 2] = 7.25
    x[rng.random((n, m)) < 0.02] = np.nan
    x[:, 2] = 7.25
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(m)])
    df = spark.createDataFrame(pdf).repartition(3)
    got = cross_moments(df, list(pdf), list(pdf)).correlation()
    want = pdf.assign(f0=pdf["f0"] - 1e9, f1=pdf["f1"] - 1e9).corr().to_numpy()
    assert np.isnan(got[2]).all() and np.isnan(got[:, 2]).all()
    keep = [i for i in range(m) if i != 2]
    assert np.allclose(got[np.ix_(keep, keep)], want[np.ix_(keep, keep)], atol=1e-9)
    both = pdf[["f0", "f1"]].dropna()
    a, b = (both[c].to_numpy() - 1e9 for c in both)
    assert got[0, 1] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-12)
    assert A.corr_matrix(df, list(pdf)[:5]).count() == 10


def test_class_comparison_matches_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 4.0, 8.0, np.nan], "y": [1e9, 1e9 + 1, 1e9 + 2, 1e9 + 3, 1e9], "Class": [0, 0, 1, 1, 1]})
    got = {r["feature"]: r for r in A.class_comparison(spark.createDataFrame(pdf), ["x", "y"]).collect()}
    for f in ("x", "y"):
        for k in (0, 1):
            v = pdf.loc[pdf["Class"] == k, f]
            assert got[f][f"mean_{k}"] == pytest.approx(v.mean(), abs=1e-6) and got[f][f"std_{k}"] == pytest.approx(v.std(), abs=1e-6)
