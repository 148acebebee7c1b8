"""Dataset description next to the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SIDECAR = "dataset.info.json"


def write_sidecar(info: DataFrame, location: str) -> None:
    """One row of settings as JSON below the dataset folder."""
    info.coalesce(1).write.mode("overwrite").json(f"{location.rstrip('/')}/{SIDECAR}")


def read_sidecar(spark: SparkSession, location: str, schema: str | None = None) -> DataFrame:
    """The settings of a dataset folder, or of a JSON file given by name."""
    path = location if location.endswith(".json") else f"{location.rstrip('/')}/{SIDECAR}"
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path, multiLine=True)
