"""Binary search over a sorted array column, as a bounded higher-order function."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_below(cuts: Column, value: Column, max_len: int) -> Column:
    """Number of elements of the ascending array ``cuts`` strictly below ``value``.

    A lower-bound binary search unrolled as ``aggregate`` over ``ceil(log2(n+1))+1``
    steps, so the per-row cost is O(log n) instead of the O(n) of
    ``size(filter(cuts, c -> c < value))``. Monotone in ``value``: equal values
    always land in the same bucket.
    """
    steps = max(1, math.ceil(math.log2(max_len + 1)) + 1)
    init = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))

    def step(acc, _i):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.shiftright(lo + hi, 1)
        go_right = F.element_at(cuts, mid + 1) < value
        moved = F.when(
            go_right, F.struct((mid + 1).alias("lo"), hi.alias("hi"))
        ).otherwise(F.struct(lo.alias("lo"), mid.alias("hi")))
        return F.when(lo < hi, moved).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step, lambda acc: acc["lo"])
