"""Sources and sinks.

* S1/S2 transactions CSV with a declared schema (no inference) and FAILFAST;
  a missing path raises ``FileNotFoundError`` like the reference.
* S3 scoring requests as NDJSON with the declared schema, projected to the
  training column order (the HTTP 10,000-row cap is not carried over).
* S4/S5 fitted pipelines and models through the stock MLlib writers/readers.
* S6/S7 result tables and drift reports as JSON/parquet tables.
* S8 an append-only run log: ``runs``, ``run_params``, ``run_metrics`` tables.
"""

from __future__ import annotations

import datetime as _dt
import importlib
import os
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql import types as T

from riskframe.sources.tables import TXN_FEATURES

TXN_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in TXN_FEATURES] + [T.StructField("Class", T.IntegerType(), True)]
)
REQUEST_SCHEMA = T.StructType([T.StructField(c, T.DoubleType(), True) for c in TXN_FEATURES])
DRIFT_SUMMARY_SCHEMA = T.StructType([
    T.StructField("dataset_drift_detected", T.BooleanType()),
    T.StructField("drifted_features", T.ArrayType(T.StringType())),
    T.StructField("num_drifted_features", T.IntegerType()),
    T.StructField("total_features", T.IntegerType()),
    T.StructField("drift_threshold", T.DoubleType()),
    T.StructField("drift_share", T.DoubleType()),
    T.StructField("reference_rows", T.LongType()),
    T.StructField("current_rows", T.LongType()),
])


def _missing(e: Exception) -> bool:
    msg = str(e)
    return "PATH_NOT_FOUND" in msg or "does not exist" in msg or "FileNotFoundException" in msg


def _load(what: str, path: str, fn):
    """Run a reader; a missing path surfaces as ``FileNotFoundError`` (as in the reference)."""
    try:
        return fn()
    except Exception as e:  # noqa: BLE001 - readers raise AnalysisException or Py4J errors
        if _missing(e):
            raise FileNotFoundError(f"{what} not found at {path}.") from e
        raise


def load_transactions(spark: SparkSession, path: str, schema: T.StructType = TXN_SCHEMA,
                      id_col: str | None = "txn_id") -> DataFrame:
    """Header CSV, declared schema, FAILFAST; NaN -> NULL; a row id is added.

    The id is the md5 of all columns and the number of the row among its equals: it does not
    depend on how the file is laid out, so a reloaded file splits alike.
    """
    df = _load("Dataset", path, lambda: spark.read.schema(schema).option("header", True)
               .option("mode", "FAILFAST").csv(path))
    df = df.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in TXN_FEATURES})
    if id_col:
        whole = F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
        equals = Window.partitionBy("_row").orderBy("_row")
        df = df.withColumn("_row", whole).withColumn(
            id_col, F.concat_ws("-", "_row", F.row_number().over(equals).cast("string"))).drop("_row")
    return df


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """S3: NDJSON request rows in the training column order."""
    return spark.read.schema(REQUEST_SCHEMA).json(path).select(*TXN_FEATURES)


def save_pipeline(model: PipelineModel, path: str) -> str:
    """Fitted feature pipeline (all stages are MLlib-writable)."""
    model.write().overwrite().save(path)
    return path


def load_pipeline(spark: SparkSession, path: str) -> PipelineModel:
    return _load("Pipeline", path, lambda: PipelineModel.load(path))


def save_model(model, path: str) -> str:
    """Any MLlib model (``MLWritable``)."""
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, cls, path: str):
    return _load("Model", path, lambda: cls.load(path))


def save_scorer(scorer, path: str) -> str:
    """A trained scorer: the fitted model and the columns that it reads."""
    inner = scorer.model
    save_model(inner.model, os.path.join(path, "model"))
    row = (f"{type(inner.model).__module__}:{type(inner.model).__name__}", list(inner.feature_cols), inner.label_col, scorer.output_col)
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([row], "cls STRING, feature_cols ARRAY<STRING>, label_col STRING, output_col STRING") \
        .write.mode("overwrite").parquet(os.path.join(path, "columns"))
    return path


def load_scorer(spark: SparkSession, path: str):
    from riskframe.operators.score import ProbabilityScorer
    from riskframe.operators.train import FeaturesThen

    row = _load("Scorer", path, lambda: spark.read.parquet(os.path.join(path, "columns"))).first()
    module, name = row["cls"].split(":")
    model = load_model(spark, getattr(importlib.import_module(module), name), os.path.join(path, "model"))
    return ProbabilityScorer(FeaturesThen(model, row["feature_cols"], row["label_col"]), row["output_col"])


def save_ensemble(ensemble, path: str) -> str:
    """A fitted blend (its weights) or stack (its meta-learner)."""
    spark = SparkSession.getActiveSession()
    weights = getattr(ensemble, "weights_", None)
    meta = getattr(ensemble, "model_", None)
    if weights is None and meta is None:
        raise RuntimeError("ensemble: not fitted")
    row = ("blend" if meta is None else "stack", list(ensemble.score_cols), weights, getattr(ensemble, "val_ap_", None))
    spark.createDataFrame([row], "kind STRING, score_cols ARRAY<STRING>, weights ARRAY<DOUBLE>, val_ap DOUBLE") \
        .write.mode("overwrite").parquet(os.path.join(path, "ensemble"))
    if meta is not None:
        save_model(meta, os.path.join(path, "meta"))
    return path


def load_ensemble(spark: SparkSession, path: str):
    from pyspark.ml.classification import LogisticRegressionModel

    from riskframe.operators.ensemble import BlendingEnsemble, StackingEnsemble

    row = _load("Ensemble", path, lambda: spark.read.parquet(os.path.join(path, "ensemble"))).first()
    if row["kind"] == "blend":
        out = BlendingEnsemble(row["score_cols"])
        out.weights_, out.val_ap_ = list(row["weights"]), row["val_ap"]
        return out
    stack = StackingEnsemble(row["score_cols"])
    stack.model_ = load_model(spark, LogisticRegressionModel, os.path.join(path, "meta"))
    return stack


def save_results(df: DataFrame, path: str, fmt: str = "json") -> str:
    """A results table (leaderboard, per-model metrics); ``threshold`` is dropped
    when ``optimal_threshold`` is present, as the reference's ensemble results do."""
    if "threshold" in df.columns and "optimal_threshold" in df.columns:
        df = df.drop("threshold")
    df.coalesce(1).write.mode("overwrite").format(fmt).save(path)
    return path


def save_drift_report(summary: DataFrame, path: str) -> str:
    """The 8-field drift summary as JSON."""
    summary.coalesce(1).write.mode("overwrite").json(path)
    return path


def load_drift_report(spark: SparkSession, path: str) -> DataFrame:
    return _load("Drift report", path, lambda: spark.read.schema(DRIFT_SUMMARY_SCHEMA).json(path))


class RunLog:
    """Append-only experiment tables under ``root`` (no tracking server).

    ``runs(run_id, model_name, ts)``, ``run_params(run_id, k, v)``, ``run_metrics(run_id, k, v)``.
    A run is logged as a whole or not at all: its parameters and metrics are written first, its row in
    ``runs`` last, and readers see only rows of runs that have one. What a broken run left behind
    is never read, and a run logged again gets an id of its own.
    """

    TABLES = {"runs": "run_id STRING, model_name STRING, ts TIMESTAMP_NTZ", "run_params": "run_id STRING, k STRING, v STRING",
              "run_metrics": "run_id STRING, k STRING, v DOUBLE"}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def log(self, model_name: str, params: dict, metrics: dict | DataFrame) -> str:
        """``metrics`` is a dict, or a one-row frame whose numeric columns are unpivoted where they lie."""
        run_id = uuid.uuid4().hex
        self._append("run_params", self._rows("run_params", [(run_id, str(k), str(v)) for k, v in params.items()]))
        if isinstance(metrics, DataFrame):
            cols = [f.name for f in metrics.schema.fields if isinstance(f.dataType, NumericType)]
            long = metrics.select(*(F.col(c).cast("double").alias(c) for c in cols)).unpivot([], cols, "k", "v")
            values = long.where(F.col("v").isNotNull()).select(F.lit(run_id).alias("run_id"), "k", "v")
        else:
            values = self._rows("run_metrics", [(run_id, str(k), float(v)) for k, v in metrics.items() if v is not None])
        self._append("run_metrics", values)
        ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self._append("runs", self._rows("runs", [(run_id, model_name, ts)]))
        return run_id

    def _rows(self, table: str, rows: list) -> DataFrame:
        return self.spark.createDataFrame(rows, self.TABLES[table]).coalesce(1)

    def _append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(os.path.join(self.root, table))

    def table(self, name: str) -> DataFrame:
        rows = self.spark.read.schema(self.TABLES[name]).parquet(os.path.join(self.root, name))
        if name == "runs":
            return rows
        return rows.join(self.table("runs").select("run_id"), "run_id", "left_semi")
