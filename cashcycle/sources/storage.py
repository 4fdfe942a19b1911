"""Shared storage for staged tables.

Staged tables are written, not cached: a lost executor then costs a re-read of a
file, not a re-scan of the mart. They go to the folder the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session.

    Only a local session may fall back to a temporary folder; on a cluster the
    executors would not see it, so there the setting is required.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        context.setCheckpointDir(Path(tempfile.mkdtemp(prefix="cashcycle-")).as_uri())
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/cashcycle/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to shared storage and go on from the written copy."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
