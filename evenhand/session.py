"""Session helpers: lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; make one only for a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="evenhand-checkpoint-")
    context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and continue from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
