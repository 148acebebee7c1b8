"""Connected components of an edge table, and groups of sorted rows inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.words import stored

# Edge tables of up to this many rows, some tens of MB, are shuffled into a few partitions instead of the session's number.
FEW_EDGES = 1_000_000
EDGES_PER_PARTITION = 200_000


def _placed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of a table of ``rows`` edges, by ``u``: rounds over few edges need no hundreds of tasks for each shuffle."""
    return df.repartition(1 + rows // EDGES_PER_PARTITION, "u") if rows <= FEW_EDGES else df


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of an undirected edge table reaches.

    Every round hangs the larger neighbours of a node, and then the smaller ones, below the smallest of
    them, so a chain of any length takes a number of rounds that is logarithmic in practice. All rounds are
    joins and partial aggregations over edges; only a row count and a checksum reach the driver. Nulls and
    loops are no edges."""
    pairs = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL")
        .where("u <> v")
        .distinct()
    )
    pairs = stored(pairs, "edges")
    state, rows = None, pairs.count()
    while True:
        both = _placed(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), rows)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = _placed(large, rows).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        pairs = stored(_placed(small.where("u <> v"), rows).distinct(), "edges")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
        if now == state or now[0] == 0:
            break
        state, rows = now, now[0]
    least = pairs.groupBy("u").agg(F.min("v").alias("component"))
    roots = least.select(F.col("component").alias("node"), "component").distinct()
    return least.select(F.col("u").alias("node"), "component").unionByName(roots)


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows that arrive sorted by ``keys``, one table each.

    One pass over a sorted partition costs far less per group than a call per group, and holds one group and
    one batch at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        values = [table[k].to_numpy() for k in keys]
        change = np.zeros(table.num_rows, bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), table.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            key = tuple(v[start] for v in values)
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            last = key
            held.append(table.slice(start, end - start))
    if held:
        yield pa.concat_tables(held)
