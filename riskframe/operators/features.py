"""Feature transforms as MLlib stages built from column expressions.

Each stage is a ``pyspark.ml`` Transformer/Estimator with Params, so a fitted
``PipelineModel`` saves and loads with the stock MLlib writers (S4). All stages
are projections: Catalyst collapses the whole chain into one ``Project``.
Fitting reads only the rows it is given (callers pass the train split).
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import cyclical_hour

# Fixed values (defaults of the reference's feature step)
DEFAULT_PAIRS = [["V14", "V17"], ["V12", "V14"], ["V10", "V17"], ["V4", "V11"]]
DEFAULT_PERIOD_SECONDS = 86400


class TimeCyclical(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``hour_sin``/``hour_cos`` of ``(Time mod period) / 3600`` on a 24-hour circle."""

    timeCol = Param(Params._dummy(), "timeCol", "seconds column", TypeConverters.toString)
    periodSeconds = Param(Params._dummy(), "periodSeconds", "period in seconds", TypeConverters.toFloat)
    dropOriginal = Param(Params._dummy(), "dropOriginal", "drop the time column", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, timeCol: str = "Time", periodSeconds: float = DEFAULT_PERIOD_SECONDS,
                 dropOriginal: bool = True):
        super().__init__()
        self._setDefault(timeCol="Time", periodSeconds=float(DEFAULT_PERIOD_SECONDS), dropOriginal=True)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        tcol = self.getOrDefault(self.timeCol)
        s, c = cyclical_hour(tcol, self.getOrDefault(self.periodSeconds))
        out = df.withColumns({"hour_sin": s, "hour_cos": c})
        return out.drop(tcol) if self.getOrDefault(self.dropOriginal) else out


class _AmountParams(Params):
    amountCol = Param(Params._dummy(), "amountCol", "amount column", TypeConverters.toString)
    logTransform = Param(Params._dummy(), "logTransform", "apply log1p", TypeConverters.toBoolean)
    standardize = Param(Params._dummy(), "standardize", "standardise after the log", TypeConverters.toBoolean)

    def _amount_expr(self):
        x = F.col(self.getOrDefault(self.amountCol)).cast("double")
        return F.log1p(x) if self.getOrDefault(self.logTransform) else x


class AmountScaler(Estimator, _AmountParams, DefaultParamsReadable, DefaultParamsWritable):
    """``log1p`` then standardise with the *population* std of the fit rows.

    MLlib ``StandardScaler`` uses the sample std, so it is not used here. A zero
    std scales by 1.
    """

    @keyword_only
    def __init__(self, amountCol: str = "Amount", logTransform: bool = True, standardize: bool = True):
        super().__init__()
        self._setDefault(amountCol="Amount", logTransform=True, standardize=True)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "AmountScalerModel":
        mean, std = 0.0, 1.0
        if self.getOrDefault(self.standardize):
            x = self._amount_expr()
            row = df.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).first()
            mean = float(row["m"]) if row["m"] is not None else 0.0
            std = float(row["s"]) if row["s"] is not None and row["s"] > 0 else 1.0
        model = AmountScalerModel(mean=mean, std=std)
        model._set(amountCol=self.getOrDefault(self.amountCol), logTransform=self.getOrDefault(self.logTransform),
                   standardize=self.getOrDefault(self.standardize))
        return model


class AmountScalerModel(Model, _AmountParams, DefaultParamsReadable, DefaultParamsWritable):
    mean = Param(Params._dummy(), "mean", "fitted mean", TypeConverters.toFloat)
    std = Param(Params._dummy(), "std", "fitted population std", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, mean: float = 0.0, std: float = 1.0):
        super().__init__()
        self._setDefault(amountCol="Amount", logTransform=True, standardize=True, mean=0.0, std=1.0)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        x = self._amount_expr()
        if self.getOrDefault(self.standardize):
            x = (x - F.lit(self.getOrDefault(self.mean))) / F.lit(self.getOrDefault(self.std))
        return df.withColumn(self.getOrDefault(self.amountCol), x)


class Interactions(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``a_x_b = a * b`` for each pair; an empty or missing list means the defaults."""

    pairs = Param(Params._dummy(), "pairs", "pairs as 'a|b' strings", TypeConverters.toListString)

    @keyword_only
    def __init__(self, pairs: list[str] | None = None):
        super().__init__()
        self._setDefault(pairs=[f"{a}|{b}" for a, b in DEFAULT_PAIRS])
        kw = dict(self._input_kwargs)
        if not kw.get("pairs"):
            kw.pop("pairs", None)
        self._set(**kw)

    @staticmethod
    def encode(pairs) -> list[str] | None:
        return [f"{a}|{b}" for a, b in pairs] if pairs else None

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = {}
        for p in self.getOrDefault(self.pairs):
            a, b = p.split("|")
            cols[f"{a}_x_{b}"] = F.col(a) * F.col(b)
        return df.withColumns(cols)


def build_feature_pipeline(
    time_period_seconds: float = DEFAULT_PERIOD_SECONDS,
    amount_log: bool = True,
    amount_standardize: bool = True,
    interaction_pairs=None,
    drop_time: bool = True,
    time_col: str = "Time",
    amount_col: str = "Amount",
) -> Pipeline:
    """F1 -> F2/F3 -> F4 as one MLlib ``Pipeline`` (30 -> 35 columns on the full shape)."""
    return Pipeline(stages=[
        TimeCyclical(timeCol=time_col, periodSeconds=float(time_period_seconds), dropOriginal=drop_time),
        AmountScaler(amountCol=amount_col, logTransform=amount_log, standardize=amount_standardize),
        Interactions(pairs=Interactions.encode(interaction_pairs)),
    ])


def fit_and_transform(df_split: DataFrame, pipeline: Pipeline | None = None) -> tuple[PipelineModel, DataFrame]:
    """fit on ``split = 'train'`` rows only, transform every row in one pass."""
    pipeline = pipeline or build_feature_pipeline()
    model = pipeline.fit(df_split.where(F.col("split") == "train"))
    return model, model.transform(df_split)
