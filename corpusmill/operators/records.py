"""Example tables to record files and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources.tfrecord import register, write_records

EXAMPLES = "id bigint, content string, target array<bigint>, offset_start array<bigint>, offset_end array<bigint>"
SEQ2SEQ = "content array<bigint>, target array<bigint>"
FIXED = "tokens array<bigint>, idx array<bigint>"

# Record files hold signed integers: ids from 2**63 on are stored as id - 2**64.
_HALF, _FULL = "9223372036854775808", "18446744073709551616"


def signed_id(value: Column) -> Column:
    unsigned = value.cast("decimal(20,0)")
    return F.when(unsigned >= F.lit(_HALF).cast("decimal(20,0)"), unsigned - F.lit(_FULL).cast("decimal(20,0)")).otherwise(
        unsigned
    ).cast("bigint")


def unsigned_id(value: Column) -> Column:
    wide = value.cast("decimal(20,0)")
    return F.when(value < 0, wide + F.lit(_FULL).cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def write_examples(
    examples: DataFrame, location: str, total: int, shard: str = "shard", compression: str = "lz",
    name: str = "dataset", mode: str = "append", order: list[str] | None = None, placed: bool = False,
) -> None:
    """(shard, id, content, target, offset_start, offset_end) to one file per shard. Refuses a folder
    that is not empty unless ``mode`` is overwrite. ``placed`` examples are in the order of their files."""
    # Under names of their own, as they may be columns of the records, too.
    keys = {f"_order_{i}": column for i, column in enumerate(order or [])}
    rows = examples.select(
        shard, *[F.col(column).alias(key) for key, column in keys.items()],
        signed_id(F.col("id")).alias("id"), "content", "target", "offset_start", "offset_end",
    )
    write_records(rows, location, shard, total, compression, name, mode, list(keys), placed)


def read_examples(spark: SparkSession, location: str) -> DataFrame:
    """Examples with unsigned ids; the ids of the tokens come as ``targets``."""
    register(spark)
    rows = spark.read.format("tfrecord").schema(EXAMPLES).load(location)
    return rows.withColumn("id", unsigned_id(F.col("id"))).withColumnRenamed("target", "targets")


def write_seq2seq(pairs: DataFrame, location: str, compression: str = "none", mode: str = "overwrite") -> None:
    """(content, target) to one file per task."""
    write_records(pairs.select("content", "target"), location, compression=compression, name="synth", mode=mode)


def read_seq2seq(spark: SparkSession, location: str) -> DataFrame:
    register(spark)
    return spark.read.format("tfrecord").schema(SEQ2SEQ).load(location)


def checked_fixed(rows: DataFrame, ndigits: int) -> DataFrame:
    """(tokens, idx) rows, failing the job at the first one that has not exactly ``3 * ndigits`` ids."""
    n = 3 * ndigits
    ok = (F.size("tokens") == n) & (F.size("idx") == n)
    checked = lambda c: F.when(ok, F.col(c)).otherwise(
        F.raise_error(F.lit(f"tokens and idx must have {n} ids")).cast("array<bigint>")
    )
    return rows.withColumns({c: checked(c) for c in ("tokens", "idx")})


def write_fixed(rows: DataFrame, location: str, ndigits: int, compression: str = "none") -> None:
    write_records(checked_fixed(rows, ndigits).select("tokens", "idx"), location, compression=compression)


def read_fixed(spark: SparkSession, location: str, ndigits: int) -> DataFrame:
    register(spark)
    return checked_fixed(spark.read.format("tfrecord").schema(FIXED).load(location), ndigits)
