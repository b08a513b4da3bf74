"""Small column-expression helpers shared by operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL: Spark orders NaN as largest and lets it poison avg; pandas skips it."""
    c = col_of(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c.cast("double"))


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero denominator (ANSI mode raises on x/0)."""
    return F.try_divide(num, den)


def zero_div(num: Column, den: Column) -> Column:
    """``zero_division=0`` semantics: 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def cyclical_hour(time_col: str | Column, period_seconds: float = 86400.0) -> tuple[Column, Column]:
    """(hour_sin, hour_cos) of the hour-of-period; floored modulo like NumPy.

    The 24-hour divisor stays fixed even when the period changes.
    """
    hours = F.pmod(col_of(time_col).cast("double"), F.lit(float(period_seconds))) / F.lit(3600.0)
    angle = F.lit(2.0 * math.pi) * hours / F.lit(24.0)
    return F.sin(angle), F.cos(angle)


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """NULL-preserving clip (``greatest``/``least`` alone would turn NULL into a bound)."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(out)
