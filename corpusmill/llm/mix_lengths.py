"""Mixing sources to target weights by subset sums over document lengths.

Documents are counted by source and exact length. Each source's target is met in three steps: whole epochs,
an equal share of the documents of every length, and a bounded-knapsack dynamic programme over the lengths
left for what then remains of the budget. The plan says how many documents of each length to take once more;
which ones is decided by a seeded order of the documents of that length.

Only (source, length, count) rows are gathered per source. Their number is bounded by the longest text, not
by the documents. Documents move as (id, source, length) alone.

Defined cases: a null text has length 0; a null source is a source of its own and comes last; rows with the
same id count and are drawn one by one; ties in the seeded order go by id; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.words import rows_of, stored, words

# The dynamic programme works on budgets up to this; what is above goes by whole documents first.
DP_BUDGET = 1 << 15
# Documents of one source and length are ranked in groups of about this many.
RANKED_TOGETHER = 10_000
_SOURCE = ["no_source", "source_key"]


def source_targets(totals: DataFrame, share: float, weights: Sequence[int], most: float) -> DataFrame:
    """Adds ``target`` to (no_source, source_key, source_size), one row per source.

    The budget is ``share`` of all sizes, dealt by weight; a source stops at ``most`` times its size and
    the rest is dealt to the others. With sources in the order of cap per weight the ones that stop are a
    prefix, so the level of the rest is the largest value of one running expression. One row per
    source is all that this window sees."""
    turn = F.pmod(F.row_number().over(Window.orderBy(*_SOURCE)) - 1, F.lit(len(weights)))
    ranked = totals.withColumn("_weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)).withColumn(
        "_cap", F.col("source_size") * F.lit(float(most))
    )
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), *_SOURCE)
    everything = Window.partitionBy(F.lit(1))
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    spent = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = ranked.withColumn("_level", (budget - spent) / weight_left)
    return level.select(
        *totals.columns,
        F.least("_cap", F.col("_weight") * F.max("_level").over(everything)).alias("target"),
    )


def fitting_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, dp_budget: int = DP_BUDGET) -> np.ndarray:
    """How many documents of each length to take so that the lengths sum up to ``budget`` or, where no
    subset does, closely below. ``lengths`` are distinct, ``budget`` is at most the sum of all."""
    taken = np.zeros(len(lengths), np.int64)
    total = int(lengths @ counts) if len(lengths) else 0
    if budget <= 0 or total == 0:
        return taken
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    exact = counts * (budget / total)
    taken = np.where(lengths > 0, np.minimum(counts, exact.astype(np.int64)), 0)
    left = budget - int(lengths @ taken)
    for i in np.argsort(-lengths, kind="stable"):
        if left <= dp_budget:
            break
        if lengths[i] > 0:
            more = min(int(counts[i] - taken[i]), (left - dp_budget) // int(lengths[i]) + 1, left // int(lengths[i]))
            taken[i] += more
            left -= more * int(lengths[i])
    # Bounded knapsack: bit b of ``reach`` says that some choice of the parts so far sums up to b. Counts are
    # taken apart into powers of two.
    mask, reach, parts = (1 << (left + 1)) - 1, 1, []
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        if reach >> left & 1:
            break
        if not 0 < length <= left:
            continue
        free, size = min(int(counts[i] - taken[i]), left // length), 1
        while free > 0:
            n = min(size, free)
            parts.append((i, n, reach))
            reach |= reach << n * length & mask
            free, size = free - n, size * 2
    at = reach.bit_length() - 1
    for i, n, before in reversed(parts):
        if not before >> at & 1:
            taken[i] += n
            at -= n * int(lengths[i])
    return taken


def length_plan(counted: DataFrame, dp_budget: int = DP_BUDGET) -> DataFrame:
    """(no_source, source_key, size, n_rows, source_size, target, epochs, extra): each document of the length is taken
    ``epochs`` times, and ``extra`` of them once more."""

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", kind="stable").reset_index(drop=True)
        size, target = int(rows["source_size"].iloc[0]), int(round(rows["target"].iloc[0]))
        rows["epochs"] = target // size if size else 0
        lengths, counts = (rows[c].to_numpy(np.int64) for c in ("size", "n_rows"))
        rows["extra"] = fitting_counts(lengths, counts, target % size if size else 0, dp_budget)
        return rows

    return counted.groupBy(*_SOURCE).applyInPandas(
        plan, "no_source boolean, source_key string, size long, n_rows long, source_size long, target double, epochs long, extra long"
    )


def mixed(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = 1.5,
    weights: Sequence[int] = (3, 1, 2),
    most: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, times): how often the mix takes each document."""
    rows = stored(
        rows_of(docs, id, source=source, size=F.size(words(F.col(f"`{text}`"))).cast("long"))
        .withColumn("no_source", F.col("source").isNull())
        .withColumn("source_key", F.coalesce(F.col("source").cast("string"), F.lit(""))),
        "mixed-rows",
    )
    counted = rows.groupBy(*_SOURCE, "size").agg(F.count(F.lit(1)).alias("n_rows"))
    totals = counted.groupBy(*_SOURCE).agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size"))
    targets = source_targets(totals, share, weights, most)
    plan = stored(length_plan(counted.join(targets, _SOURCE)), "mix-plan")

    key = [*_SOURCE, "size"]
    planned = rows.join(plan, key).withColumn("_draw", F.xxhash64(F.lit(seed), "doc_id"))
    drawn = planned.where("extra > 0 and extra < n_rows").withColumn(
        "_group", F.pmod("_draw", F.ceil(F.col("n_rows") / RANKED_TOGETHER))
    )
    before = Window.partitionBy(*key).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        drawn.groupBy(*key, "_group")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*key, "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*key, "_group").orderBy("_draw", "doc_id")
    ranked = drawn.withColumn("_rank", F.row_number().over(inside)).join(offsets, [*key, "_group"])
    some = ranked.withColumn("_more", F.col("_before") + F.col("_rank") <= F.col("extra"))
    rest = planned.where("extra = 0 or extra >= n_rows").withColumn("_more", F.col("extra") > 0)
    columns = ["doc_id", "source", "size", "source_size", "target", (F.col("epochs") + F.col("_more").cast("long")).alias("times")]
    return some.select(*columns).unionByName(rest.select(*columns))


def op9_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``: words that it takes of each."""
    mix = mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times")
