"""Session helpers: a local session for tests/bench and the shared checkpoint folder.

On a cluster the session is created by the platform; we only read its settings.
``checkpoint_dir`` returns the shared folder named by ``spark.checkpoint.dir`` and
sets one only when the session has none (local tests), never a machine-local path
on a cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Runtime SQL settings our plans need in any session (also a cluster's).
# Constraint propagation grows combinatorially with the 30 NaN-normalised feature
# columns and the 30-way validation predicate: planning alone took minutes.
PLAN_SETTINGS = {
    "spark.sql.constraintPropagation.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``PLAN_SETTINGS`` (runtime SQL confs only; nothing cluster-level)."""
    for k, v in PLAN_SETTINGS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "16g",
                  app_name: str = "riskframe") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in {**_LOCAL_DEFAULTS, **PLAN_SETTINGS}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset and the
    master is local (tests) a scratch folder is created and registered; on a cluster
    an unset folder is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: a machine-local folder "
                           "cannot hold checkpoints or intermediate tables on a cluster")
    local = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
