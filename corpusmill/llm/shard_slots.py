"""Sharding by fixed virtual slots.

Records are hashed into a fixed, large number of slots. Only the bytes of each slot are aggregated, and a
versioned map from slot to shard decides where records go. The first version deals the slots out in turn;
a later one is an edit of the one before: a slot stays in its shard as long as the shard is below its
share of the bytes, otherwise it moves to the shard with the fewest bytes. Slots are visited from the largest
down, so the last, small ones even out the shards.

The map has one row per slot, whatever the number of records: it is the only thing that is broadcast or
folded in one task, and its size is the parameter ``n_slots``.

Defined cases: a null text counts as empty; rows with the same id (or none) hash to one slot and each gets
its own position; an empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.words import rows_of, stored

SLOTS = 8192
# Bytes that a record needs besides its text.
RECORD_BYTES = 16


def virtual_slot(id: Column, n_slots: int) -> Column:
    """The slot of a record: its id alone decides, in every version of the map."""
    return F.pmod(F.xxhash64(id), F.lit(n_slots)).cast("int")


def first_map(spark: SparkSession, n_shards: int, n_slots: int = SLOTS) -> DataFrame:
    """(version, virtual_slot, shard): slots dealt out in turn."""
    slot = F.col("id").cast("int")
    return spark.range(n_slots).select(
        F.lit(1).alias("version"), slot.alias("virtual_slot"), F.pmod(slot, F.lit(n_shards)).alias("shard")
    )


def slot_bytes(rows: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, n_rows): at most one row per slot and task is shuffled."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def rebalanced(old: DataFrame, sizes: DataFrame, n_shards: int) -> DataFrame:
    """The next version of a map for ``n_shards``: as few slots as needed move to make bytes near equal.

    A fold over the slots, largest first, with the bytes of each shard as its state. Slots of a shard
    that no longer exists move."""
    slot = F.struct(
        (-F.coalesce("bytes", F.lit(0))).cast("long").alias("less"), "virtual_slot", "shard", "version"
    )
    slots = old.join(sizes, "virtual_slot", "left").agg(F.sort_array(F.collect_list(slot)).alias("slots"))
    total = F.aggregate("slots", F.lit(0).cast("long"), lambda a, s: a - s["less"])
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), n_shards).alias("loads"),
        F.array().cast("array<int>").alias("shards"),
    )

    def step(state: Column, s: Column) -> Column:
        loads = state["loads"]
        stays = F.coalesce((F.get(loads, s["shard"]) - s["less"]) * n_shards <= F.col("total"), F.lit(False))
        least = (F.array_position(loads, F.array_min(loads)) - 1).cast("int")
        to = F.when(stays, s["shard"]).otherwise(least)
        grown = F.transform(loads, lambda x, i: F.when(i == to, x - s["less"]).otherwise(x))
        return F.struct(grown.alias("loads"), F.concat(state["shards"], F.array(to)).alias("shards"))

    placed = slots.withColumn("total", total).select(
        F.explode(F.arrays_zip("slots", F.aggregate("slots", start, step, lambda s: s["shards"]).alias("to"))).alias("s")
    )
    return placed.select(
        (F.col("s.slots.version") + 1).alias("version"), "s.slots.virtual_slot", F.col("s.to").alias("shard")
    )


def sized(docs: DataFrame, id: str = "doc_id", text: str = "text", n_slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot)."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return rows_of(docs, id, text=text).select(
        "doc_id",
        (F.octet_length(body) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        virtual_slot(F.col("doc_id"), n_slots).alias("virtual_slot"),
    )


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds ``shard``, ``map_version`` and ``slot``, the record's gapless position in its shard.

    A position is the number of records in earlier slots of the shard, from the slot counts, plus the
    position within the slot, so no shard is sorted as a whole."""
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.join(slot_bytes(rows), "virtual_slot").select(
        "virtual_slot",
        "shard",
        F.col("version").alias("map_version"),
        F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("_at", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "virtual_slot")
        .withColumn("slot", F.col("_before") + F.col("_at"))
        .drop("_before", "_at")
    )


def shard_documents(
    docs: DataFrame, n_shards: int = 40, n_slots: int = SLOTS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, shard, map_version, slot) with near equal bytes per shard."""
    rows = stored(sized(docs, id, text, n_slots), "sharded-rows")
    slot_map = stored(rebalanced(first_map(docs.sparkSession, n_shards, n_slots), slot_bytes(rows), n_shards), "slot-map")
    return placed(rows, slot_map)


def op8_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 39 of near equal bytes."""
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )
