"""Stream scoring (the always-on scoring service re-aimed as a Structured Streaming job).

``readStream`` -> adapter projection -> validation -> features -> scorer -> decision,
written by ``foreachBatch`` into two parquet tables (``scored`` and ``quarantine``).
Each micro-batch overwrites its own ``batch_id=N`` folder, so a batch replayed after
a failure rewrites the same files: the sink is idempotent and, with the
checkpoint, exactly-once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from riskframe.operators.score import decide
from riskframe.operators.validate import validate


def file_stream(spark: SparkSession, directory: str, file_glob: str, schema) -> DataFrame:
    """A file source over ``directory`` restricted to ``file_glob`` (one table of many)."""
    return spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(directory)


def stream_score(
    stream: DataFrame,
    scorer,
    out_dir: str,
    checkpoint: str,
    features=None,
    required=None,
    non_negative=("Amount",),
    threshold: float = 0.5,
    model_name: str = "model",
    model_version: str = "0.1.0",
    id_col: str = "txn_id",
    available_now: bool = True,
):
    """Start the scoring stream; returns the ``StreamingQuery``.

    Scored rows land in ``out_dir/scored``, rejected rows in ``out_dir/quarantine``.
    """
    kw = {} if required is None else {"required": required}

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()  # both tables are written from one read of the source
        valid, quarantine = validate(df, non_negative=non_negative, **kw)
        x = features.transform(valid) if features is not None else valid
        scored = decide(scorer.transform(x), threshold, model_name, model_version)
        cols = [id_col, "is_fraud", "fraud_probability", "threshold", "model_name", "model_version"]
        scored.select(*cols).write.mode("overwrite").parquet(os.path.join(out_dir, "scored", f"batch_id={batch_id}"))
        quarantine.write.mode("overwrite").parquet(os.path.join(out_dir, "quarantine", f"batch_id={batch_id}"))
        df.unpersist()

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_scored(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out_dir, "scored"))


def run_to_completion(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(query.exception()))
