"""The given tables as the inputs the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.plans.parallel import spread

# The path of a document in SQL, the same for both engines.
PATH_SQL = "concat('/', source, '/', lpad(cast(doc_id as varchar(20)), 9, '0'), '.txt')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents for work per character, in at least as many partitions as there are cores."""
    return spread(table(spark, sf_dir, "documents").select(*columns))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: (ordinal, path, text)."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ordinal"), F.expr(PATH_SQL).alias("path"), "text"
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id sequences to feed: the word lengths of each conversation turn, past the reserved ids."""
    ids = F.transform(F.split("text", " "), lambda w: (F.length(w) + 3).cast("bigint"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", ids.alias("target"))


SEQUENCES_SQL = """
    SELECT conv_id, turn, list_transform(string_split(text, ' '), lambda w: CAST(length(w) + 3 AS BIGINT)) AS target
    FROM conversations
"""
