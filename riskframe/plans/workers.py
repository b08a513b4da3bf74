"""Python workers get this package as a zipped py-file, so that functions sent to them may use it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import riskframe


def ship(spark: SparkSession) -> None:
    """Send the package to the workers, once per application."""
    sc = spark.sparkContext
    name = f"riskframe-core-{sc.applicationId}.zip"
    if any(p.endswith(name) for p in sc._python_includes):
        return
    root = Path(riskframe.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="riskframe-")) / name
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
