"""Input validation with a quarantine instead of an HTTP 422.

Rows with a missing (NULL/NaN) required field or a negative value in a
non-negative field go to the quarantine frame with their reasons; the rest are
valid. One projection computes the reasons; two filters split the frame.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.sources.tables import TXN_FEATURES


def with_reasons(df: DataFrame, required: Sequence[str] = TXN_FEATURES,
                 non_negative: Sequence[str] = ("Amount",)) -> DataFrame:
    checks = []
    for c in required:
        col = F.col(c)
        bad = col.isNull() | (F.isnan(col) if dict(df.dtypes)[c] in ("double", "float") else F.lit(False))
        checks.append(F.when(bad, F.lit(f"missing:{c}")))
    for c in non_negative:
        checks.append(F.when(F.col(c) < 0, F.lit(f"negative:{c}")))
    return df.withColumn("reasons", F.array_compact(F.array(*checks)))


def validate(df: DataFrame, required: Sequence[str] = TXN_FEATURES,
             non_negative: Sequence[str] = ("Amount",)) -> tuple[DataFrame, DataFrame]:
    """Return ``(valid, quarantine)``; quarantine keeps every column plus ``reasons``."""
    tagged = with_reasons(df, required, non_negative)
    valid = tagged.where(F.size("reasons") == 0).drop("reasons")
    quarantine = tagged.where(F.size("reasons") > 0)
    return valid, quarantine


def quarantine_report(quarantine: DataFrame) -> DataFrame:
    """Rejected-row count per reason."""
    return quarantine.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows")
    )
