"""Hot keys: a third of all rows on one score value / one stratum."""

import numpy as np
import pandas as pd

from riskframe.operators import metrics as M
from riskframe.plans.prefix import bucket_count
from tests.test_metrics import brute


def test_hot_score_value(spark):
    rng = np.random.default_rng(11)
    n = 6000
    p = rng.uniform(0, 1, n)
    p[: n // 3] = 0.5  # one value holds a third of the rows
    y = (rng.uniform(0, 1, n) < 0.1 + 0.3 * p).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"Class": y, "score": p}))
    r = M.ranking_metrics(M.score_curve(df, rows_per_bucket=200)).first()
    ap, auc = brute(y, p)
    assert abs(r["pr_auc"] - ap) < 1e-6 and abs(r["roc_auc"] - auc) < 1e-6


def test_bucket_count_rules():
    assert bucket_count(10, 2_000_000, 1 << 16, 8) == 1            # small: one bucket
    assert bucket_count(10**12, 2_000_000, 1 << 20, 8) == 500_000   # size rule at scale
    assert bucket_count(1_000_000, 2_000_000, 1 << 16, 8) == 5      # at least one bucket per 200k rows
