"""Cutting lineage so that a costly stage runs once and survives lost executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one is used. Only a
    local session (tests) that names none gets a temporary folder of this machine.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if not current:
            context.setCheckpointDir(named)
        return named
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="resma-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, so that later stages
    neither recompute it nor depend on executors that computed it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
