"""Broadcast only behind a proven size bound.

Callers pass the number of rows the small side can have at most (known from an
earlier aggregate, e.g. #strata x #buckets). Above the limit the join stays a
shuffle join, which the caller arranges to be co-partitioned with the next window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A row of an offsets/cuts table is a few longs and doubles; 2M rows stay well
# below the default 8 GB broadcast cap and the driver's memory.
MAX_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when ``max_rows`` (a proven upper bound) fits, else ``df``."""
    if max_rows <= limit:
        return F.broadcast(df)
    return df
