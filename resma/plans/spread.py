"""Giving every core a share of rows that are costly to work on."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores.

    A scan of one small file is one partition, which leaves all cores but one idle in the
    stages that follow. Such a frame is redistributed; a frame that already has a partition for
    each core, as any large table has, is left as it is and nothing is moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
