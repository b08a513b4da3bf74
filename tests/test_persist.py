"""Saved scorers and ensembles score like the ones that were fitted."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators.ensemble import BlendingEnsemble, StackingEnsemble
from riskframe.operators.train import TrainConfig, build_model, fit_score, tune_model
from riskframe.session import scratch_path
from riskframe.sources import io


@pytest.fixture(scope="module")
def frame(spark):
    rows = spark.range(900).select(
        F.col("id").alias("txn_id"), (F.col("id") % 97 / 97.0).alias("a"), (F.col("id") % 31 / 31.0).alias("b"),
        ((F.col("id") % 97 + F.col("id") % 31) > 90).cast("int").alias("Class"),
        F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.col("id") % 3 + 1).cast("int")).alias("split"))
    return rows.cache()


def test_scorer_round_trip(spark, frame):
    cfg = TrainConfig(feature_cols=["a", "b"], max_iter=3, fixed={"maxDepth": 3})
    scorer = fit_score("gbt", {}, frame, cfg)
    again = io.load_scorer(spark, io.save_scorer(scorer, scratch_path(spark, "scorer")))
    one = scorer.transform(frame).select("txn_id", "score")
    two = again.transform(frame).select("txn_id", F.col("score").alias("other"))
    assert one.join(two, "txn_id").where("score <> other").count() == 0
    with pytest.raises(FileNotFoundError):
        io.load_scorer(spark, "/nonexistent/scorer")


def test_ensembles_round_trip(spark, frame):
    for ens in (BlendingEnsemble(["a", "b"]), StackingEnsemble(["a", "b"])):
        with pytest.raises(RuntimeError):
            ens.predict_proba(frame)
        with pytest.raises(RuntimeError):
            io.save_ensemble(ens, scratch_path(spark, "none"))
        ens.fit(frame.where("split = 'val'"))
        again = io.load_ensemble(spark, io.save_ensemble(ens, scratch_path(spark, "ensemble")))
        one, two = (e.predict_proba(frame).select("txn_id", F.col("score").alias(n)) for e, n in ((ens, "x"), (again, "y")))
        assert one.join(two, "txn_id").where("x <> y").count() == 0
    assert sum(BlendingEnsemble(["a", "b"]).fit(frame).weights_) == pytest.approx(1.0)


def test_unknown_types(frame):
    cfg = TrainConfig(feature_cols=["a"])
    for call in (lambda: build_model("tree"), lambda: tune_model("tree", frame, cfg)):
        with pytest.raises(ValueError):
            call()


def test_csv_ids_do_not_depend_on_the_layout(spark):
    cols = [F.col("id").cast("double").alias(c) if c == "Time" else F.lit(1.5).alias(c) for c in io.TXN_FEATURES]
    df = spark.range(40).select((F.col("id") % 20).alias("id")).select(*cols, F.lit(0).alias("Class"))
    ids = []
    for n in (1, 5):
        path = scratch_path(spark, "csv")
        df.repartition(n).write.option("header", True).csv(path)
        ids.append({r["txn_id"] for r in io.load_transactions(spark, path).collect()})
    assert ids[0] == ids[1] and len(ids[0]) == 40


def test_requests_are_read_in_training_order(spark):
    path = scratch_path(spark, "requests")
    spark.createDataFrame([(2.0, 1.0)], "Amount double, Time double").write.json(path)
    out = io.read_requests(spark, path)
    assert out.columns == io.TXN_FEATURES and out.select("Time", "Amount", "V1").first() == (1.0, 2.0, None)
