"""Unbounded synthetic examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.synth import sum_one


def sample_stream(spark: SparkSession, rows_per_batch: int, partitions: int) -> DataFrame:
    """(sample_id): an endless count from 0."""
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("numPartitions", partitions)
        .load()
        .select(F.col("value").alias("sample_id"))
    )


def sum_one_stream(samples: DataFrame, length: int, vocab_size: int, seed: int, split: str = "train") -> DataFrame:
    """The batch generator over a stream of sample ids: the same id gives the same example."""
    return sum_one(samples, length, vocab_size, seed, split)
