"""Stream jobs equal their batch counterparts on the same rows."""

from pyspark.sql import functions as F

from riskframe.sources import tables as T
from riskframe.streaming import drift as SD
from riskframe.streaming.scoring import file_stream, read_scored, run_to_completion, stream_score


class _AmountScorer:
    """A deterministic scorer on the events view (score = value / (value + 50))."""

    def transform(self, df):
        return df.withColumn("score", F.col("Amount") / (F.col("Amount") + F.lit(50.0)))


def test_stream_scoring_equals_batch(spark, sf, tmp_path):
    schema = T.table(spark, sf, "events").schema
    stream = T.txn_events_from(file_stream(spark, sf, "events.parquet", schema))
    q = stream_score(stream, _AmountScorer(), str(tmp_path / "out"), str(tmp_path / "ck"),
                     required=["Time", "Amount"], threshold=0.5, model_name="amount")
    run_to_completion(q)
    got = {r["txn_id"]: (r["is_fraud"], r["fraud_probability"]) for r in read_scored(spark, str(tmp_path / "out")).collect()}
    batch = _AmountScorer().transform(T.txn_events(spark, sf))
    exp = {r["txn_id"]: (r["score"] >= 0.5, round(r["score"], 6)) for r in batch.collect()}
    assert got == exp


def test_stream_window_counts_equal_batch(spark, sf, tmp_path):
    ev = T.table(spark, sf, "events")
    lo, hi = SD.reference_edges(ev, "value")
    stream = file_stream(spark, sf, "events.parquet", ev.schema)
    q = SD.start_window_counts(stream, "ts", "value", lo, hi, str(tmp_path / "c"), str(tmp_path / "ck"))
    run_to_completion(q)
    got = {(r["window_start"], r["bin"]): r["n"] for r in spark.read.parquet(str(tmp_path / "c")).collect()}
    assert got, "closed windows were emitted"
    days = {k[0] for k in got}
    b = ev.select(F.window(F.col("ts").cast("timestamp"), "1 day").start.alias("w"),
                  SD._bin(F.col("value"), lo, hi, 10).alias("bin")).groupBy("w", "bin").count()
    exp = {(r["w"], r["bin"]): r["count"] for r in b.collect() if r["w"] in days}
    assert got == exp
    psi = SD.window_psi(spark, str(tmp_path / "c"), SD.reference_shares(ev, "value", lo, hi))
    assert psi.count() == len(days) and psi.where(F.col("psi") < 0).count() == 0
