"""Metrics and length checks over prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.sequences import IGNORED_LABEL


def metrics(predictions: DataFrame) -> DataFrame:
    """(name, value): mean squared error and mean prediction, over all rows and over the rows whose
    label is not masked."""
    p, y = F.col("prediction"), F.col("label")
    seen = y != IGNORED_LABEL
    squared = F.pow(y - p, F.lit(2.0))
    wide = predictions.agg(
        F.avg(squared).alias("mean_squared_error"),
        F.avg(p).alias("mean_prediction"),
        F.avg(F.when(seen, squared)).alias("masked_mean_squared_error"),
        F.avg(F.when(seen, p)).alias("masked_mean_prediction"),
    )
    return wide.unpivot([], wide.columns, "name", "value")


def write_metrics(named: DataFrame, location: str) -> None:
    """One JSON object that maps each metric's name to its value."""
    named.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("name", "value")))).alias("value")).write.mode(
        "overwrite"
    ).text(location)


def length_check(examples: DataFrame, steps: int, batch_size: int) -> DataFrame:
    """Whether the data lasts for ``steps`` batches, and how many full batches there are."""
    return examples.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(steps).cast("bigint").alias("expected_steps"),
        F.least(F.expr(f"n div {batch_size}"), F.lit(steps).cast("bigint")).alias("steps_done"),
        (F.expr(f"n div {batch_size}") >= steps).alias("lasts"),
    )
