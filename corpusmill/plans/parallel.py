"""Enough tasks for work that costs far more than reading its input."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Repartitions an input that arrives in fewer partitions than there are cores, such as one small
    file. For scans: asking a frame with a shuffle for its partitions would run it. An input with enough partitions, as any large one has, passes through without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
