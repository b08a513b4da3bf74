"""Windows of a stream: nothing is lost, and KS is that of the batch within the stated error."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.streaming import windows as W
from riskframe.streaming.scoring import run_to_completion


def _rows(seed=5, days=12, n=400):
    r = np.random.default_rng(seed)
    day = r.integers(0, days, n * days)
    ts = pd.Timestamp("2024-03-01") + pd.to_timedelta(day * 86400 + r.integers(0, 86400, len(day)), unit="s")
    x = np.round(r.normal(day * 0.05, 1), 2)
    x[r.random(len(x)) < 0.02] = np.nan
    return pd.DataFrame({"id": np.arange(len(day)), "ts": ts, "x": x, "tied": r.integers(0, 5, len(day)).astype(float)}), day


def _stream(spark, tmp_path, parts, k=W.SKETCH_K):
    schema = "id long, ts timestamp, x double, tied double"
    for p in parts:
        spark.createDataFrame(p, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run_to_completion(W.start_windows(s, "ts", ["x", "tied"], str(tmp_path / "out"), str(tmp_path / "ck"), k=k))
    return str(tmp_path / "out")


def _ks(a, b):
    v = np.unique(np.concatenate([a, b]))
    f = lambda s: np.searchsorted(np.sort(s), v, side="right") / len(s)
    return np.abs(f(a) - f(b)).max()


@pytest.mark.parametrize("k", [4096, 64])
def test_shuffled_days_lose_nothing_and_ks_holds(spark, tmp_path, k):
    rows, day = _rows()
    r = np.random.default_rng(1)
    order = r.permutation(12)  # whole days out of order, and some rows anywhere
    batch = np.array([int(np.flatnonzero(order == d)[0]) // 3 for d in day])
    batch = np.where(r.random(len(batch)) < 0.1, r.integers(0, 4, len(batch)), batch)
    parts = [rows[batch == b] for b in range(4)]
    parts[2] = pd.concat([parts[2], pd.DataFrame({"id": [-1], "ts": [pd.NaT], "x": [0.5], "tied": [1.0]})])
    out = _stream(spark, tmp_path, parts, k)
    late = W.late_rows(spark, out).toPandas()
    wins = W.windows(spark, out)
    per = {(w["closed"], w["feature"]): w["rows"] for w in wins.groupBy("closed", "feature").agg(F.sum("rows").alias("rows")).collect()}
    for f in ("x", "tied"):
        assert per[True, f] + per[False, f] + len(late) == len(rows) + 1
    assert W.counts(spark, out) == {"rows": len(rows) + 1, "late": len(late)} and -1 in set(late["id"])
    # late are exactly the rows whose day had ended a day before the latest time of earlier batches
    mark, want = None, [-1]
    for p in parts:
        if mark is not None:
            want += p.loc[p["ts"].dt.floor("D") + pd.Timedelta(days=1) <= mark - pd.Timedelta(days=1), "id"].tolist()
        mark = max(x for x in (mark, p["ts"].max()) if x is not None)
    assert sorted(late["id"]) == sorted(want) and 1 < len(want) < len(rows)
    fresh = rows[~rows["id"].isin(late["id"])]
    ref = W.reference_points(spark.createDataFrame(rows, "id long, ts timestamp, x double, tied double"), ["x", "tied"], points=100)
    got = W.drift_of_windows(wins, ref, k=k).collect()
    assert len(got) == 2 * fresh["ts"].dt.floor("D").nunique()
    for g in got:
        a, b = rows[g["feature"]].dropna().to_numpy(), fresh.loc[fresh["ts"].dt.floor("D") == g["window_start"], g["feature"]].dropna().to_numpy()
        assert g["n"] == len(b) and abs(g["ks"] - _ks(a, b)) <= g["ks_error"] + 1e-6
        v = np.sort(np.concatenate([a, b]))
        f = lambda s: np.searchsorted(np.sort(s), v[:-1], side="right") / len(s)
        w1 = (np.abs(f(a) - f(b)) * np.diff(v)).sum()
        assert abs(g["w1"] - w1) <= g["w1_error"] + 1e-6
    if k == 4096:
        assert all(abs(g["ks"] - _ks(rows["tied"].to_numpy(), fresh.loc[fresh["ts"].dt.floor("D") == g["window_start"], "tied"].to_numpy())) < 1e-6
                   for g in got if g["feature"] == "tied")


def test_a_batch_without_its_mark_does_not_count(spark, tmp_path):
    rows, _ = _rows(days=3, n=50)
    out = _stream(spark, tmp_path, [rows])
    sketches = spark.read.parquet(f"{out}/sketches/batch_id=0")
    sketches.write.parquet(f"{out}/sketches/batch_id=7")
    assert W.windows(spark, out).where("feature = 'x'").agg(F.sum("rows")).first()[0] == len(rows)
