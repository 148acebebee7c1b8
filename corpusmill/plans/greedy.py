"""Greedy cuts of a long sequence, computed in parallel.

Two operators walk a whole sequence from its start and cut it greedily: size shards close once their
bytes reach a limit, packed rows close before their tokens exceed one. Each cut depends on the one
before, so the plain form is a single-task fold. Here the sequence is divided into blocks of a fixed
span. Wherever the walk enters a block, only items near the block's beginning can be its first cut, so
each block turns these few candidates into jumps out of the block. Jumps are composed block of blocks
by block of blocks until one is left, and then the real walk is followed back down. The result equals
the single-task fold, and no task sees more than one block.

``_start`` is the sum of the sizes before an item (see ``with_running``).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusmill.plans.skew import join_on_counted_key
from corpusmill.session import cut_lineage

# A block spans about this many items, which is what one task holds.
ITEMS_PER_BLOCK = 200_000
_JUMPS = "block long, at long, to long, hops long, last long"
_WALK = "at long, to long, hops long, last long, chunk long"


def cut_when_reached(
    items: DataFrame, limit: int, keys: list[str], fanout: int | None = None
) -> DataFrame:
    """Chunks that close with the item that brings their size to ``limit`` or more."""
    if limit <= 0:
        return items.select(*keys, F.col("_ordinal").alias("chunk"), F.col("_start").alias("chunk_start"))

    def next_cut(at: np.ndarray, bounds: np.ndarray, beyond: int) -> np.ndarray:
        i = np.searchsorted(bounds, at + limit, side="left")
        return np.where(i < len(bounds), bounds[np.minimum(i, len(bounds) - 1)], beyond)

    return _cut(items, limit, keys, next_cut, fanout)


def cut_before_overflow(
    items: DataFrame, limit: int, keys: list[str], fanout: int | None = None
) -> DataFrame:
    """Chunks of at most ``limit``: an item that does not fit opens the next chunk. Sizes lie in
    [1, limit]."""

    def next_cut(at: np.ndarray, bounds: np.ndarray, beyond: int) -> np.ndarray:
        return bounds[np.searchsorted(bounds, at + limit, side="right") - 1]

    return _cut(items, limit, keys, next_cut, fanout)


def _cut(
    items: DataFrame, limit: int, keys: list[str], next_cut: Callable, fanout: int | None
) -> DataFrame:
    """(keys, chunk, chunk_start) for every item.

    Items of size 0 decide no cut, and any number of them may share a position. One per position goes through the blocks, the others
    take its chunk."""
    items = cut_lineage(items.select(*dict.fromkeys([*keys, "_start", "_size"])))
    stats = items.agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("total")).first()
    total = int(stats["total"] or 0)
    if total == 0:
        return items.select(*keys, F.lit(0).cast("bigint").alias("chunk"), F.col("_start").alias("chunk_start"))
    per_limit = max(1.0, stats["n"] * limit / total)
    fanout = fanout or int(max(2, ITEMS_PER_BLOCK / per_limit))
    spans = [fanout * limit]
    while spans[-1] <= total:
        spans.append(spans[-1] * fanout)

    empty = items.where("_size = 0")
    shared = empty.groupBy("_start").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(0).cast("bigint").alias("_size"))
    every, items = items, items.where("_size > 0").unionByName(shared, allowMissingColumns=True)
    if len(spans) == 1:
        # One block holds everything: the walk enters it at 0 and nothing needs composing.
        walk = items.sparkSession.createDataFrame([(0, 0, 0, 0, 0)], _WALK)
        return _with_empty(_assign(items, [*every.columns, "n_rows"], walk, spans[0], next_cut, total), empty, keys)
    jumps = [cut_lineage(_block_jumps(items, spans[0], limit, next_cut, total))]
    for span in spans[1:]:
        jumps.append(cut_lineage(_compose(jumps[-1], span, limit)))

    walk = jumps[-1].where("at = 0").select("at", "to", "hops", "last", F.lit(0).cast("bigint").alias("chunk"))
    for level in range(len(spans) - 1, 0, -1):
        walk = cut_lineage(_follow(jumps[level - 1], walk, spans[level]))
    return _with_empty(_assign(items, [*every.columns, "n_rows"], walk, spans[0], next_cut, total), empty, keys)


def _with_empty(placed: DataFrame, empty: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, chunk, chunk_start) of the items that went through the blocks, and of all items of size 0."""
    columns = [*keys, "chunk", "chunk_start"]
    sized = placed.where("n_rows IS NULL").select(*columns)
    if empty.isEmpty():
        return sized
    positions = placed.where("n_rows IS NOT NULL").select("_start", "n_rows", "chunk", "chunk_start")
    spread = [k for k in keys if k not in ("_start", "_size")] or ["_start"]
    return sized.unionByName(join_on_counted_key(empty, cut_lineage(positions), "_start", spread).select(*columns))


def _block_of(column: str, span: int) -> Column:
    return F.expr(f"`{column}` div {span}L")


def _candidates(at: np.ndarray, block: int, span: int, limit: int) -> np.ndarray:
    """Which sorted positions of a block the walk can enter it at: those up to the first one that
    lies a full limit behind the beginning of the block."""
    if block == 0:
        return at == 0
    cut = np.searchsorted(at, block * span + limit, side="left") + 1
    return np.arange(len(at)) < cut


def _chase(nxt: np.ndarray, hops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every position the last position of its block on the walk, and the hops to leave the block.

    ``nxt`` is an index into the same array, or its own index where the walk leaves the block."""
    root = nxt.copy()
    own = np.arange(len(nxt))
    reach = np.where(root == own, 0, hops)
    while True:
        further = root[root]
        if np.array_equal(further, root):
            return root, reach + hops[root]
        reach = reach + reach[root]
        root = further


def _block_jumps(
    items: DataFrame, span: int, limit: int, next_cut: Callable, total: int
) -> DataFrame:
    """Jumps of the candidate items of each block. Items within ``limit`` of the beginning of a block
    also go to the block before, whose cuts may fall on them."""

    def jumps(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        start = table["_start"].to_numpy()
        bounds = np.unique(np.concatenate([start, start + table["_size"].to_numpy()]))
        at = np.unique(start[start // span == block])
        if len(at) == 0:
            return _jump_table(block, at, at, at, at)
        to = next_cut(at, bounds, total + 1)
        i = np.minimum(np.searchsorted(at, to), len(at) - 1)
        inside = at[i] == to
        root, hops = _chase(np.where(inside, i, np.arange(len(at))), np.ones(len(at), np.int64))
        keep = _candidates(at, block, span, limit)
        return _jump_table(block, at[keep], to[root][keep], hops[keep], at[root][keep])

    home = _block_of("_start", span)
    blocks = F.when(
        (F.col("_start") % span < limit) & (home > 0), F.array(home, home - 1)
    ).otherwise(F.array(home))
    # Items of size 0 share the position of the next item and decide no cut.
    return (
        items.where("_size > 0")
        .select(F.explode(blocks).alias("block"), "_start", "_size")
        .groupBy("block")
        .applyInArrow(jumps, _JUMPS)
    )


def _compose(lower: DataFrame, span: int, limit: int) -> DataFrame:
    """Jumps out of larger blocks, made of the jumps out of the blocks inside."""

    def compose(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        table = table.sort_by("at")
        at, to = table["at"].to_numpy(), table["to"].to_numpy()
        i = np.minimum(np.searchsorted(at, to), len(at) - 1)
        inside = at[i] == to
        root, hops = _chase(np.where(inside, i, np.arange(len(at))), table["hops"].to_numpy())
        keep = _candidates(at, block, span, limit)
        return _jump_table(
            block, at[keep], to[root][keep], hops[keep], table["last"].to_numpy()[root][keep]
        )

    return (
        lower.withColumn("block", _block_of("at", span))
        .groupBy("block")
        .applyInArrow(compose, _JUMPS)
    )


def _jump_table(block: int, at, to, hops, last) -> pa.Table:
    return pa.table(
        {"block": np.full(len(at), block, np.int64), "at": at, "to": to, "hops": hops, "last": last}
    ).cast(pa.schema([(n, pa.int64()) for n in ("block", "at", "to", "hops", "last")]))


def _follow(lower: DataFrame, walk: DataFrame, span: int) -> DataFrame:
    """The walk in jumps of the level below: within each block, from where the walk enters it."""
    names = ("at", "to", "hops", "last", "chunk")

    def follow(table: pa.Table) -> pa.Table:
        entry = table.filter(table["chunk"].is_valid())
        table = table.filter(table["chunk"].is_null()).sort_by("at")
        at, to, hops = (table[n].to_numpy() for n in ("at", "to", "hops"))
        taken, chunks = [], []
        if entry.num_rows:
            here, chunk = entry["at"][0].as_py(), entry["chunk"][0].as_py()
            i = int(np.searchsorted(at, here))
            while i < len(at) and at[i] == here:
                taken.append(i)
                chunks.append(chunk)
                here, chunk = to[i], chunk + hops[i]
                i = int(np.searchsorted(at, here))
        out = table.select(names[:4]).take(pa.array(taken, pa.int64()))
        return out.append_column("chunk", pa.array(np.array(chunks, np.int64)))

    block = _block_of("at", span).alias("block")
    below = lower.select(block, *names[:4], F.lit(None).cast("bigint").alias("chunk"))
    return (
        below.unionByName(walk.select(block, *names))
        .groupBy("block")
        .applyInArrow(follow, _WALK)
    )


def _assign(
    items: DataFrame, keys: list[str], walk: DataFrame, span: int, next_cut: Callable, total: int
) -> DataFrame:
    """The chunk of every item, from one row per block that says which chunk is open when the block
    begins and where the next one starts."""
    first = walk.where("at = 0").select(
        F.lit(0).cast("bigint").alias("block"),
        F.col("at").alias("entry"),
        "chunk",
        F.lit(0).cast("bigint").alias("open_start"),
    )
    entered = walk.where(_block_of("at", span) < _block_of("to", span)).select(
        F.explode(F.sequence(_block_of("at", span) + 1, _block_of("to", span))).alias("block"),
        F.col("to").alias("entry"),
        (F.col("chunk") + F.col("hops")).alias("chunk"),
        F.col("last").alias("open_start"),
    )

    def assign(table: pa.Table) -> pa.Table:
        entry = table.filter(table["entry"].is_valid())
        table = table.filter(table["entry"].is_null())
        start = table["_start"].to_numpy()
        here, chunk, open_start = (entry[n][0].as_py() for n in ("entry", "chunk", "open_start"))
        cuts = [open_start]
        bounds = np.unique(np.concatenate([start, start + table["_size"].to_numpy()]))
        last_start = start.max(initial=-1)
        while here <= last_start:
            cuts.append(here)
            here = int(next_cut(np.array([here]), bounds, total + 1)[0])
        i = np.searchsorted(np.array(cuts[1:], np.int64), start, side="right")
        columns = {k: table[k] for k in keys}
        columns["chunk"] = pa.array(chunk - 1 + i, pa.int64())
        columns["chunk_start"] = pa.array(np.array(cuts, np.int64)[i], pa.int64())
        return pa.table(columns)

    rows = items.withColumn("block", _block_of("_start", span))
    out = StructType(
        [*items.select(*keys).schema.fields]
        + [StructField("chunk", LongType()), StructField("chunk_start", LongType())]
    )
    return (
        rows.unionByName(first.unionByName(entered), allowMissingColumns=True)
        .groupBy("block")
        .applyInArrow(assign, out)
    )
