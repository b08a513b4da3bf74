import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskframe.operators.features import AmountScaler, Interactions, TimeCyclical, build_feature_pipeline

COLS = ["Time"] + [f"V{i}" for i in range(1, 29)] + ["Amount"]


def _txn(spark, n=200, seed=42):
    rng = np.random.default_rng(seed)
    d = {"Time": rng.uniform(0, 172792, n)}
    for i in range(1, 29):
        d[f"V{i}"] = rng.standard_normal(n)
    d["Amount"] = rng.exponential(88, n)
    return spark.createDataFrame(pd.DataFrame(d))


def test_sin_cos_range(spark):
    r = TimeCyclical().transform(_txn(spark)).agg(F.min("hour_sin"), F.max("hour_sin"), F.min("hour_cos"), F.max("hour_cos")).first()
    assert -1 <= r[0] and r[1] <= 1 and -1 <= r[2] and r[3] <= 1


def test_midnight_equals_next_midnight(spark):
    df = spark.createDataFrame([(0.0, 10.0), (86400.0, 10.0)], "Time double, Amount double")
    rows = TimeCyclical().transform(df).collect()
    assert abs(rows[0]["hour_sin"] - rows[1]["hour_sin"]) < 1e-10
    assert abs(rows[0]["hour_cos"] - rows[1]["hour_cos"]) < 1e-10
    assert "Time" not in rows[0].asDict()


def test_negative_time_floored_mod(spark):
    df = spark.createDataFrame([(-3600.0,), (82800.0,)], "Time double")
    r = TimeCyclical().transform(df).collect()
    assert abs(r[0]["hour_sin"] - r[1]["hour_sin"]) < 1e-10


def test_log1p_values(spark):
    df = spark.createDataFrame([(0.0,), (math.e - 1,)], "Amount double")
    m = AmountScaler(standardize=False).fit(df)
    v = sorted(r["Amount"] for r in m.transform(df).collect())
    assert v[0] == 0.0 and abs(v[1] - 1.0) < 1e-12


def test_standardized_population_std(spark):
    df = _txn(spark)
    out = AmountScaler().fit(df).transform(df)
    r = out.agg(F.avg("Amount"), F.stddev_pop("Amount")).first()
    assert abs(r[0]) < 1e-9 and abs(r[1] - 1) < 1e-9


def test_zero_variance_scales_by_one(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "Amount double")
    m = AmountScaler().fit(df)
    assert m.getOrDefault(m.std) == 1.0


def test_interactions_and_default_pairs(spark):
    df = _txn(spark)
    out = Interactions(pairs=[]).transform(df)
    r = out.select("V14", "V17", "V14_x_V17").first()
    assert abs(r[0] * r[1] - r[2]) < 1e-12
    assert {"V14_x_V17", "V12_x_V14", "V10_x_V17", "V4_x_V11"} <= set(out.columns)


def test_pipeline_35_columns(spark):
    out = build_feature_pipeline().fit(_txn(spark)).transform(_txn(spark))
    assert len(out.columns) == 35


def test_fit_on_a_transform_b(spark):
    a, b = _txn(spark, seed=1), _txn(spark, seed=2)
    m = build_feature_pipeline().fit(a)
    scaler = m.stages[1]
    mean_a = scaler.getOrDefault(scaler.mean)
    m.transform(b).count()
    assert scaler.getOrDefault(scaler.mean) == mean_a


def test_pipeline_save_load(spark, tmp_path):
    df = _txn(spark)
    m = build_feature_pipeline().fit(df)
    m.write().overwrite().save(str(tmp_path / "p"))
    m2 = PipelineModel.load(str(tmp_path / "p"))
    a = m.transform(df).select("Amount").collect()
    b = m2.transform(df).select("Amount").collect()
    assert a == b
