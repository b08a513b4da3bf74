"""Special functions as column expressions (bounded ``aggregate`` loops, no Python per row)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY = 1e-300
_SHIFT = 10
# Stirling's series, B(2j) / (2j (2j - 1))
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)


def log_gamma(a: Column) -> Column:
    """ln Gamma(a) for a > 0: Stirling's series at a + 10, taken back by the product a (a + 1) ..."""
    z = a + F.lit(float(_SHIFT))
    series = F.lit(0.0)
    for j, b in enumerate(_STIRLING):
        series = series + F.lit(b) / F.pow(z, F.lit(2.0 * j + 1))
    back = F.lit(0.0)
    for i in range(_SHIFT):
        back = back + F.log(a + F.lit(float(i)))
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - back


def upper_gamma(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(a, x), a > 0, x >= 0.

    Below a + 1 by the power series of P = 1 - Q, above by the continued fraction of Q in the form
    that needs no first term (Lentz). Both converge in a multiple of sqrt(a) steps near x = a."""
    steps = F.sequence(F.lit(1), F.ceil(F.lit(100.0) + F.lit(14.0) * F.sqrt(a)).cast("int"))
    front = F.exp(a * F.log(F.greatest(x, F.lit(_TINY))) - x - log_gamma(a))
    terms = F.aggregate(
        steps, F.struct((F.lit(1.0) / a).alias("t"), (F.lit(1.0) / a).alias("s")),
        lambda acc, i: F.struct((acc["t"] * x / (a + i)).alias("t"), (acc["s"] + acc["t"] * x / (a + i)).alias("s")), lambda acc: acc["s"])

    def away(v: Column) -> Column:  # from zero
        return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)

    def step(acc: Column, i: Column) -> Column:
        an, b = -i * (i - a), x + 1.0 - a + i * 2.0
        d = F.lit(1.0) / away(an * acc["d"] + b)
        c = away(b + an / acc["c"])
        return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * d * c).alias("h"))

    start = F.lit(1.0) / away(x + 1.0 - a)
    fraction = F.aggregate(steps, F.struct(F.lit(1 / _TINY).alias("c"), start.alias("d"), start.alias("h")), step, lambda acc: acc["h"])
    q = F.when(x < a + 1.0, F.lit(1.0) - front * terms).otherwise(front * fraction)
    return F.when(x <= 0, F.lit(1.0)).otherwise(F.greatest(F.least(q, F.lit(1.0)), F.lit(0.0)))


def chi_square_sf(statistic: Column, dof: Column) -> Column:
    """P(chi-square of ``dof`` >= ``statistic``); 1 without degrees of freedom, NULL for a NULL statistic."""
    s, k = statistic.cast("double"), dof.cast("double")
    tail = upper_gamma(F.greatest(k, F.lit(1.0)) / 2.0, s / 2.0)
    return F.when(s.isNull(), F.lit(None).cast("double")).when(k <= 0, F.lit(1.0)).otherwise(tail)
