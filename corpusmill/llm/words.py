"""Words of a text and the narrow rows operators work on.

A word is a run of bytes other than space and U+0009 to U+000D. ``bytes.split()`` cuts at exactly these,
so tasks in Python and expressions in the JVM see the same words.
"""

from __future__ import annotations

import gc
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import delete_path, scratch_path

# Fixed value: what separates words.
SPACE = "[ \\t\\n\\x0B\\f\\r]"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Array of the words; empty for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def rows_of(docs: DataFrame, id: str, **columns: str | Column) -> DataFrame:
    """(doc_id, columns): only what an operator reads, under its own names, so that other columns of
    the input never clash with the operator's."""
    picked = [(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    return docs.select(F.col(f"`{id}`").alias("doc_id"), *picked)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts its lineage, in columns and compressed."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(df: DataFrame) -> None:
    """Lets Spark delete the files of shuffles whose results are stored. It does so when the driver collects its garbage, which
    a driver with little to do puts off, so that the files of all steps would be on disk together."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` returned and nothing reads any more."""
    for df in tables:
        for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            delete_path(df.sparkSession, path)
