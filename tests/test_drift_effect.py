"""Chi-square tail against plain Python, Jensen-Shannon distance and the least effect."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.functions.special import chi_square_sf
from riskframe.operators import drift as D


def _tail(x, dof):
    """Q(dof / 2, x / 2) by its finite sums: Poisson for even dof, erfc and half-integers for odd."""
    h = x / 2
    if dof % 2 == 0:
        return math.fsum(math.exp(-h + k * math.log(h) - math.lgamma(k + 1)) for k in range(dof // 2))
    return math.fsum([math.erfc(math.sqrt(h)), *(math.exp(-h + (k - 0.5) * math.log(h) - math.lgamma(k + 0.5)) for k in range(1, (dof + 1) // 2))])


def test_chi_square_tail(spark):
    rows = [(dof, dof * f + z * math.sqrt(2 * dof)) for dof in (1, 2, 3, 4, 7, 10, 33, 100, 501, 2000, 9999, 10_000)
            for f, z in ((1, 0), (1, 1), (1, -1), (1, 3), (1, -3), (1, 8), (0.1, 0), (2, 0), (1, 0.01))]
    rows = [(k, x) for k, x in rows if x > 0]
    got = spark.createDataFrame(rows, "dof long, x double").select("dof", "x", chi_square_sf(F.col("x"), F.col("dof")).alias("p")).collect()
    for r in got:
        assert r["p"] == pytest.approx(_tail(r["x"], r["dof"]), abs=1e-10), r
    odd = spark.createDataFrame([(0, 1.0), (3, 0.0), (3, None), (3, 1e6)], "dof long, x double")
    assert [r[0] for r in odd.select(chi_square_sf(F.col("x"), F.col("dof"))).collect()] == [1.0, 1.0, None, 0.0]


def test_js_of_equal_apart_and_shifted(spark):
    r = np.random.default_rng(3)
    a = pd.DataFrame({"same": r.normal(size=2000), "apart": r.random(2000), "tied": r.integers(0, 3, 2000).astype(float), "none": np.nan})
    b = pd.DataFrame({"same": a["same"], "apart": 5 + r.random(2000), "tied": r.integers(0, 3, 2000).astype(float), "none": 1.0})
    got = {x["feature"]: x["js"] for x in D.js_distance(spark.createDataFrame(a), spark.createDataFrame(b), list(a)).collect()}
    assert got["same"] == 0 and got["apart"] == 1 and 0 < got["tied"] < 0.05 and got["none"] is None
    p, q = (np.bincount(x["tied"].astype(int), minlength=3) / 2000 for x in (a, b))
    m = (p + q) / 2
    assert got["tied"] == pytest.approx(math.sqrt(((p * np.log2(p / m)).sum() + (q * np.log2(q / m)).sum()) / 2), abs=1e-6)


def test_a_significant_but_small_shift_is_no_drift(spark):
    r = np.random.default_rng(4)
    a = pd.DataFrame({"small": r.normal(size=20_000), "large": r.normal(size=20_000), "kind": r.choice(["x", "y"], 20_000)})
    b = pd.DataFrame({"small": r.normal(0.08, 1, 20_000), "large": r.normal(1, 1, 20_000), "kind": r.choice(["x", "y"], 20_000, p=[0.52, 0.48])})
    x, y = spark.createDataFrame(a), spark.createDataFrame(b)
    for least, want in ((None, ["kind", "large", "small"]), (0.1, ["large"]), (0.9, [])):
        summary, detail = D.detect_data_drift(x, y, None, ["small", "large"], ["kind"], effect_min=least)
        assert summary.first()["drifted_features"] == want
        assert ("js" in detail.columns) == (least is not None)
