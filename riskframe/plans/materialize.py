"""Reuse of intermediate results inside one query.

``keep`` persists a frame that several jobs of the same query read (the split
assignment, the tie-collapsed score table the prefix plan counts before ranking).
Storage is MEMORY_AND_DISK: blocks lost with an executor are recomputed from the
lineage, which is deterministic everywhere in this package. ``release`` unpersists
everything kept so far. ``cut`` writes a table to the shared checkpoint folder and
reads it back, for long pipelines whose lineage should not be replayed.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from riskframe.session import scratch_path

_KEPT: list[DataFrame] = []


def keep(df: DataFrame) -> DataFrame:
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(out)
    return out


def release() -> None:
    while _KEPT:
        _KEPT.pop().unpersist(blocking=False)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under ``spark.checkpoint.dir`` and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
