"""Assignment of files to size-bounded record files, and the encode totals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from corpusmill.plans.greedy import cut_when_reached
from corpusmill.plans.ordinal import with_running
from corpusmill.session import cut_lineage

# Record file suffixes by compression.
SUFFIXES = {"none": "tfrecord", "gz": "tfrecord.gz", "gzip": "tfrecord.gz",
            "lz": "tfrecord.lz", "zlib": "tfrecord.lz"}


def size_shards(
    files: DataFrame, order: list[str], size: str, limit: int, fanout: int | None = None
) -> DataFrame:
    """(order columns, shard): files in order, a shard closes once it holds ``limit`` bytes.

    A null size counts as 0. Works on the order key and the size only; join the result to the wide rows."""
    narrow = files.select(*order, F.coalesce(F.col(size).cast("bigint"), F.lit(0).cast("bigint")).alias("_size"))
    items = with_running(narrow, order, "_size")
    return cut_when_reached(items, limit, order, fanout).select(*order, F.col("chunk").alias("shard"))


# Ranges of keys sent to the tasks: 24 bytes each.
MOST_SENT_SHARDS = 5_000_000


def with_shard(rows: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """Adds the ``shard`` of the plan to wide rows with the same BIGINT ``key`` that ordered the plan.

    A shard is a range of keys, from its first to its last one, and a row belongs to the shard whose range its key lies in. Rows with
    a null key or a key outside every range are dropped. The rows look their shard up in the sorted ranges, without a
    shuffle. Where there are too many ranges to send, neighbouring ones are looked up together, and which of these few it is
    is decided in a join on their common number."""
    known = plan.where(F.col(key).isNotNull())
    bounds = known.groupBy("shard").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    n = (plan.agg(F.max("shard")).first()[0] or 0) + 1
    if n <= MOST_SENT_SHARDS:
        return _looked_up(rows, bounds, key, "shard").where("shard IS NOT NULL")
    together = -(-n // MOST_SENT_SHARDS)
    bounds = cut_lineage(bounds.withColumn("_group", F.expr(f"shard div {together}")))
    groups = bounds.groupBy("_group").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    grouped = _looked_up(rows, groups, key, "_group")
    inside = (F.col(key) >= F.col("_first")) & (F.col(key) <= F.col("_last"))
    return grouped.join(bounds, "_group").where(inside).drop("_group", "_first", "_last")


def _looked_up(rows: DataFrame, bounds: DataFrame, key: str, name: str) -> DataFrame:
    """Adds the ``name`` of the range (_first, _last) that the key lies in, null if there is none."""
    table = bounds.orderBy("_first").toArrow()
    sent = rows.sparkSession.sparkContext.broadcast(
        tuple(table[c].to_numpy().astype(np.int64) for c in ("_first", "_last", name))
    )

    def lookup(keys: pa.Array) -> pa.Array:
        first, last, number = sent.value
        if len(first) == 0:
            return pa.nulls(len(keys), pa.int64())
        known = keys.is_valid().to_numpy(zero_copy_only=False)
        values = keys.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.searchsorted(first, values, side="right") - 1
        inside = known & (at >= 0) & (values <= last[at])
        return pa.array(number[at], pa.int64(), mask=~inside)

    return rows.withColumn(name, F.arrow_udf(lookup, LongType())(F.col(key)))


def count_chunks(files: DataFrame, order: list[str], n: int) -> DataFrame:
    """(order columns, chunk): a fixed number of files per chunk; ``n`` below 1 gives singletons."""
    placed = with_running(files.select(*order), order)
    return placed.select(*order, F.expr(f"_ordinal div {max(n, 1)}").alias("chunk"))


def shard_file_name(shard: Column, total: Column, name: str = "dataset", compress: str = "lz") -> Column:
    return F.format_string(f"{name}_%05d_%05d.{SUFFIXES[compress]}", shard, total)


def compression_of(paths: DataFrame) -> DataFrame:
    """One row: GZIP when every path ends in gz, NONE when no path does; a mix is an error."""
    ends = F.col("path").endswith("gz")
    return paths.agg(F.bool_or(ends).alias("any_gz"), F.bool_and(ends).alias("all_gz")).select(
        F.when(F.col("all_gz"), "GZIP").when(F.col("any_gz"), "INVALID").otherwise("NONE").alias(
            "compression"
        )
    )


def require_one_compression(paths: DataFrame) -> DataFrame:
    """``compression_of`` that fails the job on a mix."""
    error = F.raise_error(F.lit("some record files end in gz and some do not")).cast("string")
    return compression_of(paths).select(
        F.when(F.col("compression") == "INVALID", error).otherwise(F.col("compression")).alias("compression")
    )


def observed_totals(examples: DataFrame, ids: str = "target") -> tuple[DataFrame, Observation]:
    """The examples, and an observation that holds ``tokens`` and ``examples`` once they have been written:
    the totals of an encode run without a second pass."""
    totals = Observation("encode totals")
    counted = examples.observe(
        totals,
        F.coalesce(F.sum(F.size(ids).cast("bigint")), F.lit(0)).alias("tokens"),
        F.count(F.lit(1)).alias("examples"),
    )
    return counted, totals


def encode_totals(examples: DataFrame, ids: str = "target", shard: str = "shard") -> DataFrame:
    """Tokens, examples, record files and tokens per record file of sharded examples."""
    return examples.agg(
        F.coalesce(F.sum(F.size(ids).cast("bigint")), F.lit(0)).alias("tokens"),
        F.count(F.lit(1)).alias("examples"),
        F.count_distinct(shard).alias("record_files"),
    ).withColumn("tokens_per_file", F.round(F.col("tokens") / F.col("record_files"), 2))
