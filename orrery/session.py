"""Session settings the library relies on, and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Behaviour settings only. Sizes (executors, memory, shuffle partitions) belong
# to the cluster's own configuration.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Map-side partial results of a hot key may still be large: let the optimizer
    # judge skew on compressed shuffle blocks of this size.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    # Recording the caller's source line for every column expression is costly.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "orrery", **conf: str) -> SparkSession:
    """Create (or get) a session with the library defaults; ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests, laptops) gets a
    temporary folder; on a cluster a missing setting is an error, because files
    in a machine-local folder die with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="orrery-scratch-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder."""
    root = scratch_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Like a checkpoint it ends the lineage and survives lost executors, but the
    rows are computed only once and later readers prune columns and rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
