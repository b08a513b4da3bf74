from pyspark.sql import functions as F

from riskframe.operators.flows import monitoring_flow, run_ensemble, run_full_training
from riskframe.sources.tables import txn


def test_training_ensemble_and_monitoring(spark, sf):
    run = run_full_training(txn(spark, sf), model_types=("gbt", "rf"), n_trials=1, timeout_s=120, max_iter=3)
    assert set(run.scorers) == {"gbt", "rf"}
    m = run.metrics.collect()
    assert len(m) == 2 * 2 * 2  # models x (val, test) x (tuned, default)
    assert all(r["pr_auc"] is None or 0 <= r["pr_auc"] <= 1 for r in m)
    lb = run_ensemble(run).collect()
    assert {r["model_name"] for r in lb} == {"gbt", "rf", "stacking", "blending"}
    assert sorted(r["rank"] for r in lb) == [1, 2, 3, 4]
    rows = {r["stage"]: r for r in monitoring_flow(run.features).collect()}
    assert rows["shifted"]["num_drifted_features"] >= rows["baseline"]["num_drifted_features"]
    assert {"V14", "V17"} <= set(rows["shifted"]["drifted_features"])
