"""Continuous language filter over a stream of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpusmill.operators.lang import filter_units


def line_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """(text): the lines of text files as they arrive in a folder."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder).withColumnRenamed("value", "text")


def filter_stream(
    lines: DataFrame, model: DataFrame, languages: list[str], langs: list[str], output: str, checkpoint: str,
    threshold: float = 0.9, reverse: bool = False, available_now: bool = True,
) -> StreamingQuery:
    """The batch filter on a stream, into text files. The file sink and the checkpoint make a restart
    neither lose nor double a line. ``available_now`` stops when the present input is done."""
    writer = (
        filter_units(lines, model, languages, langs, threshold, reverse)
        .writeStream.format("text")
        .option("checkpointLocation", checkpoint)
        .option("lineSep", "\n")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start(output)


def kept_lines(spark: SparkSession, output: str) -> DataFrame:
    """The lines written so far."""
    return spark.read.option("lineSep", "\n").text(output).withColumnRenamed("value", "text")
