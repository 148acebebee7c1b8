"""Training feed: end marks, packing or padding, repetition, shuffling, batching, sampling."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapreplace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from corpusmill.functions.numbers import seeded_draw, seeded_key
from corpusmill.functions.sequences import PAD, append_eos, trim_and_pad
from corpusmill.plans.greedy import cut_before_overflow
from corpusmill.plans.ordinal import with_running
from corpusmill.plans.skew import join_on_counted_key
from corpusmill.session import cut_lineage


def with_eos(examples: DataFrame, ids: str = "target") -> DataFrame:
    return examples.withColumn(ids, append_eos(F.col(ids)))


def pad_rows(examples: DataFrame, length: int, ids: str = "target") -> DataFrame:
    """One example per row, cut or zero-padded to ``length``."""
    return examples.withColumn(ids, trim_and_pad(F.col(ids), length))


def pack_placement(
    examples: DataFrame, order: list[str], length: int, ids: str = "target", fanout: int | None = None
) -> DataFrame:
    """(order columns, row_no, offset, size): which packed row each example goes to, and where.

    Whole examples go one after the other into rows of ``length``; one that does not fit opens the
    next row. Over-long examples count with ``length``, null ones are empty and placed nowhere. Works on lengths only, never on the ids.
    """
    sizes = examples.select(*order, F.least(F.coalesce(F.size(ids), F.lit(0)), F.lit(length)).cast("bigint").alias("_size"))
    # Range partitioning reads its input twice: the lengths are written first, as the ids may be costly to make.
    items = with_running(cut_lineage(sizes.where("_size > 0")), order, "_size")
    placed = cut_before_overflow(items, length, [*order, "_start", "_size"], fanout)
    return placed.select(
        *order,
        F.col("chunk").alias("row_no"),
        (F.col("_start") - F.col("chunk_start")).alias("offset"),
        F.col("_size").alias("size"),
    )


def pack_rows(
    examples: DataFrame, order: list[str], length: int, ids: str = "target", fanout: int | None = None
) -> DataFrame:
    """(row_no, targets, segmentation, position), every array of ``length``; zeros fill the rest.

    A packed row gathers at most ``length`` ids, so no group can grow with the data."""
    placed = pack_placement(examples, order, length, ids, fanout)
    trimmed = examples.select(*order, F.slice(ids, 1, length).alias("_ids"))
    rows = (
        placed.join(trimmed, order)
        .groupBy("row_no")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "_ids"))).alias("_parts"))
    )
    segments = F.transform("_parts", lambda p, i: F.transform(p["_ids"], lambda _: (i + 1).cast("bigint")))
    positions = F.transform("_parts", lambda p: F.transform(p["_ids"], lambda _, j: j.cast("bigint")))
    fill = F.array_repeat(F.lit(PAD).cast("bigint"), length)
    full = lambda arrays: F.slice(F.concat(F.flatten(arrays), fill), 1, length)
    return rows.select(
        "row_no",
        full(F.transform("_parts", lambda p: p["_ids"])).alias("targets"),
        full(segments).alias("segmentation"),
        full(positions).alias("position"),
    )


def batches(
    examples: DataFrame, order: list[str], size: int, columns: list[str], drop_remainder: bool = False
) -> DataFrame:
    """(batch, n_examples, examples): ``size`` consecutive examples per row, the last one may be
    short. Rows carry their payload to the batch in one shuffle."""
    placed = with_running(examples.select(*order), order)
    slots = placed.select(
        *order, F.expr(f"_ordinal div {size}").alias("batch"), F.expr(f"_ordinal % {size}").alias("slot")
    )
    out = (
        examples.select(*dict.fromkeys([*order, *columns]))
        .join(slots, order)
        .groupBy("batch")
        .agg(F.sort_array(F.collect_list(F.struct("slot", *columns))).alias("examples"))
        .withColumn("n_examples", F.size("examples").cast("bigint"))
        .select("batch", "n_examples", "examples")
    )
    return out.where(F.col("n_examples") == size) if drop_remainder else out


def repeat(examples: DataFrame, epochs: int) -> DataFrame:
    """Every example once per epoch; a map-only step."""
    return examples.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def shuffled(examples: DataFrame, seed: int, keys: list[str]) -> DataFrame:
    """Adds ``shuffle_key`` and sorts by it: a reproducible order of the whole table. Equal seeds give
    equal orders; include ``epoch`` in ``keys`` to reshuffle each pass."""
    return examples.withColumn(
        "shuffle_key", seeded_key(seed, *[F.col(k) for k in keys])
    ).orderBy("shuffle_key")


def take(examples: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` examples: each task keeps its own ``n``, only those are merged."""
    return examples.orderBy(*order).limit(n)


def sample_with_replacement(files: DataFrame, order: list[str], draws: DataFrame, seed: int) -> DataFrame:
    """One file per row of ``draws`` (column ``draw``), every file equally likely each time."""
    placed = with_running(files.select(*order), order)
    n = placed.count()
    pick = F.pmod(seeded_draw(seed, F.col("draw")), F.lit(n)) if n else F.lit(None).cast("bigint")
    picks = draws.withColumn("_ordinal", pick)
    return picks.join(placed, "_ordinal").drop("_ordinal")


def split_test(problems: DataFrame, key: str, seed: int, share: float = 0.2, most: int = 1000) -> DataFrame:
    """Adds ``is_test``: the first ``min(share * n, most)`` problems of a seeded permutation.

    The test side has at most ``most`` rows, so it is a top-k and a broadcast, not a global sort.
    """
    # The test side is a fifth of the problems and at most 1,000 of them.
    size = problems.agg(F.least(F.floor(F.count(F.lit(1)) * share), F.lit(most)).alias("n_test"))
    first = (
        problems.select(key, seeded_key(seed, F.col(key)).alias("_key"))
        .orderBy("_key", key)
        .limit(most)
    )
    ranked = first.agg(F.sort_array(F.collect_list(F.struct("_key", F.col(key)))).alias("_rows"))
    test = (
        ranked.select(F.slice("_rows", F.lit(1), size.scalar().cast("int")).alias("_rows"))
        .select(F.explode("_rows").alias("_row"))
        .select(F.col(f"_row.{key}").alias(key), F.lit(True).alias("is_test"))
    )
    return problems.join(F.broadcast(test), key, "left").withColumn(
        "is_test", F.coalesce("is_test", F.lit(False))
    )


def interleaved(rows: DataFrame, file: str, order: list[str], cycle: int = 4) -> DataFrame:
    """Round-robin order over groups of ``cycle`` files: adds ``cycle_no``, ``row_in_file`` and
    ``file_slot`` and sorts by them.

    The position within a file is a difference of global positions, so a file that holds a third of
    the rows is numbered by many tasks.
    """
    placed = with_running(rows.select(file, *order), [file, *order])
    files = placed.groupBy(file).agg(F.min("_ordinal").alias("first"), F.count(F.lit(1)).alias("n_rows"))
    slots = with_running(files, [file]).withColumnRenamed("_ordinal", "file_slot")
    keyed = join_on_counted_key(placed, slots, file, "_ordinal")
    return keyed.select(
        file,
        *order,
        F.expr(f"file_slot div {cycle}").alias("cycle_no"),
        (F.col("_ordinal") - F.col("first")).alias("row_in_file"),
        "file_slot",
    ).orderBy("cycle_no", "row_in_file", "file_slot")


def interleaved_slots(rows: DataFrame, file: str, order: list[str], cycle: int = 4) -> DataFrame:
    """The order of a reader that takes one row from each of ``cycle`` open files in turn: adds ``turn`` and ``slot`` and sorts by them.

    A file that ends leaves its slot empty for one turn; then the slot opens the next file. Which slot and turn a file
    begins at follows from the numbers of rows of the files before it alone, so one task schedules (file, rows); the rows themselves are numbered
    by many tasks, whatever the share of one file."""
    placed = with_running(rows.select(file, *order), [file, *order])
    files = placed.groupBy(file).agg(F.min("_ordinal").alias("first"), F.count(F.lit(1)).alias("n_rows"))

    def schedule(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = [(0, slot) for slot in range(cycle)]
        for batch in batches:
            begins, slots = [], []
            for n in batch["n_rows"].to_pylist():
                turn, slot = free[0]
                heapreplace(free, (turn + n + 1, slot))
                begins.append(turn)
                slots.append(slot)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(begins, pa.int64()), pa.array(slots, pa.int32())], names=[*batch.schema.names, "begin", "slot"]
            )

    out = StructType([*files.schema.fields, StructField("begin", LongType()), StructField("slot", IntegerType())])
    # One row per file, 8 numbers at most: what a single task reads is the list of files, not their rows.
    scheduled = cut_lineage(files.orderBy(file).coalesce(1).mapInArrow(schedule, out))
    keyed = join_on_counted_key(placed, scheduled, file, "_ordinal")
    turn = F.col("begin") + F.col("_ordinal") - F.col("first")
    return keyed.select(file, *order, turn.alias("turn"), "slot").orderBy("turn", "slot")


def buffer_shuffled(examples: DataFrame, order: list[str], buffer: int, seed: int) -> DataFrame:
    """(order columns, position): a shuffle that moves no example by ``buffer`` places or more.

    An example is put off by a seeded draw below ``buffer`` and the positions are those in the order of place plus draw. Only keys are moved, and they
    only move to neighbouring ranges; the rows are read in the order of the positions."""
    if buffer < 1:
        raise ValueError("a buffer holds one example at least")
    placed = with_running(examples.select(*order), order).withColumnRenamed("_ordinal", "_place")
    drawn = placed.withColumn("_key", F.col("_place") + F.pmod(seeded_draw(seed, F.col("_place")), F.lit(buffer)))
    return with_running(drawn, ["_key", "_place"]).select(*order, F.col("_ordinal").alias("position"))
