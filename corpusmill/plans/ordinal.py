"""Positions in a global order without sorting the table in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusmill.session import cut_lineage


def with_running(df: DataFrame, keys: list[str], size: str | None = None) -> DataFrame:
    """Adds ``_ordinal`` (rows before) and, with ``size``, ``_start`` (sum of sizes before).

    The rows are range-partitioned and sorted once and written to the shared folder, so that both
    passes below see the same partitions. Running values are local to a partition; the offsets added
    to them come from one row per partition. ``keys`` must be unique together, which also lets the
    range partitioner split anything. Pass narrow rows: they are written out.
    """
    ordered = cut_lineage(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id())
    )
    out = StructType(
        [*ordered.schema.fields, StructField("_rows", LongType()), StructField("_sum", LongType())]
    )

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = total = 0
        for batch in batches:
            n = batch.num_rows
            sizes = batch.column(size).to_numpy(zero_copy_only=False) if size else np.zeros(n, np.int64)
            ends = total + np.cumsum(sizes, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.arange(rows, rows + n)), pa.array(ends - sizes)],
                names=[*batch.schema.names, "_rows", "_sum"],
            )
            rows, total = rows + n, int(ends[-1]) if n else total

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = F.sum(size).alias("_size") if size else F.lit(0).alias("_size")
    # One row per partition, so this window and the broadcast stay small whatever the table.
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_count"), sizes)
        .select(
            "_part",
            F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_sum_before"),
        )
    )
    placed = ordered.mapInArrow(running, out).join(F.broadcast(offsets), "_part")
    columns = [*df.columns, (F.col("_rows") + F.col("_rows_before")).cast("bigint").alias("_ordinal")]
    if size:
        columns.append((F.col("_sum") + F.col("_sum_before")).cast("bigint").alias("_start"))
    return placed.select(*columns)
