import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import early_stop as S
from riskframe.operators.blend_search import average_precision
from riskframe.operators.train import TrainConfig, build_model, fit_score


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(4)
    n = 900
    x = r.normal(size=(n, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # nothing to gain in the first splits
    y = np.where(r.random(n) < 0.1, 1 - y, y)
    pdf = pd.DataFrame(np.round(x, 2), columns=list("abcd")).assign(label=y, Class=y.astype(int), weight=1.0, split=np.where(np.arange(n) % 3 == 0, "val", "train"))
    df = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(spark.createDataFrame(pdf)).repartition(3).cache()
    return df, df.where("split = 'train'"), df.where("split = 'val'")


def _make(n):
    return GBTClassifier(maxIter=n, maxDepth=2, seed=3, stepSize=0.1, subsamplingRate=0.8, maxBins=32)


def _aps(model, val):
    rows = val.select(vector_to_array("features").alias("x"), "label").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([int(r["label"]) for r in rows])
    return [average_precision(m, y, 1 - y) for m in S.trees_of(model).margins(x)]


def test_margins_bounds_and_first_trees(data):
    _, train, val = data
    model = _make(12).fit(train)
    trees = S.trees_of(model)
    rows = val.select(vector_to_array("features").alias("x")).collect()
    margins = trees.margins(np.array([r["x"] for r in rows]))
    for k in (1, 5, 12):  # a cut model, and a shorter fit with the same seed, are the first rounds
        for m in (S.first_trees(model, k), _make(k).fit(train)):
            p = [r[0] for r in m.transform(val).select(vector_to_array("probability")[1]).collect()]
            assert np.allclose(p, 1 / (1 + np.exp(-2 * margins[k - 1])), atol=1e-12)
    aps, bounds = _aps(model, val), S.staged_bounds(trees, val)
    assert all(lo <= ap <= up for ap, (lo, up) in zip(aps, bounds))
    exact = S.staged_ap(trees, val, range(12))
    assert np.allclose([exact[k] for k in range(12)], aps, atol=1e-12)


def test_records_and_patience():
    r = np.random.default_rng(0)
    for _ in range(200):
        aps = np.round(r.random(40) * np.linspace(0.5, 1, 40), 2)
        width = r.random(40) * 0.1
        chosen = S.possible_records(np.stack([aps - width, aps + width], axis=1))
        for patience in (1, 3, 10):
            best, value = 0, aps[0]
            for k in range(40):
                if k - best > patience:
                    break
                if aps[k] > value:
                    best, value = k, aps[k]
            got, _ = S.best_round({k: aps[k] for k in chosen}, 40, patience)
            assert got == best


def test_patience_goes_on_where_the_tolerance_stops(data):
    df, train, val = data
    early = build_model("gbt", {"maxDepth": 2, "stepSize": 0.1, "validationTol": 0.01}, 3, 60, "is_val").fit(
        df.withColumn("is_val", F.col("split") == "val"))
    fit = S.fit_with_patience(_make, train, val, rounds=60, patience=15)
    aps = _aps(_make(fit.trained).fit(train), val)
    best, value = 0, -1.0
    for k, ap in enumerate(aps):
        if k - best > 15:
            break
        if round(ap, 9) > round(value, 9):
            best, value = k, ap
    assert fit.best_round == best + 1 == fit.model.getNumTrees
    assert early.getNumTrees < fit.best_round
    assert fit.exact_rounds < fit.trained


def test_fit_score_uses_patience(data):
    df, _, _ = data
    cfg = TrainConfig(feature_cols=list("abcd"), max_iter=24, fixed={"maxDepth": 2}, patience=6)
    scored = fit_score("gbt", {}, df.drop("features", "label", "weight"), cfg).transform(df.drop("features", "label", "weight"))
    assert scored.where("score BETWEEN 0 AND 1").count() == 900
