"""Tables in the shared folder, and row keys that survive nulls and repeated rows."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import riskframe
from riskframe.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under spark.checkpoint.dir and read it back: lineage ends there, and a
    lost executor loses nothing."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``written`` returned, once all that is made of it has been written too."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df.scratch)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: Column) -> Column:
    """64 bits of a text. Beside doc_id it tells apart rows that share an id; null has its own."""
    return F.when(text.isNull(), F.lit(-1).cast("long")).otherwise(F.xxhash64(F.lit(1), text))


def need(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package as a zipped py-file, once per application."""
    sc = spark.sparkContext
    name = f"riskframe-{sc.applicationId}.zip"
    if any(p.endswith(name) for p in sc._python_includes):
        return
    root = Path(riskframe.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="riskframe-")) / name
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose function may come from this package."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)
