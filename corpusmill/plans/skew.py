"""Joins that hold when one key has a third of the rows, or when the other side outgrows a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.plans.bloom import without_members
from corpusmill.session import cut_lineage

# A key is hot when it holds more than 1/HOT_SHARE of the counted rows, so there are fewer than
# HOT_SHARE hot keys whatever the data: the broadcast below has a proven bound.
HOT_SHARE = 1000


def join_on_counted_key(
    left: DataFrame, counted: DataFrame, key: str, spread: str | list[str], how: str = "inner"
) -> DataFrame:
    """``left`` joined with ``counted`` (one row per key and its row count ``n_rows``).

    Rows of a hot key are spread over as many salts as keep each below 1/HOT_SHARE of the rows;
    only the right rows of hot keys are repeated; without a hot key it is a plain join. ``spread`` are left
    columns that differ between rows of one key.
    """
    spread = [spread] if isinstance(spread, str) else spread
    stats = counted.agg(F.sum("n_rows").alias("total"), F.max("n_rows").alias("most")).first()
    if not stats["total"] or stats["most"] * HOT_SHARE <= stats["total"]:
        return left.join(counted, key, how)
    salts = F.ceil(F.col("n_rows") * HOT_SHARE / F.lit(stats["total"])).cast("int")
    right = counted.withColumn("_n_salts", F.greatest(salts, F.lit(1)))
    hot = right.where("_n_salts > 1").select(key, "_n_salts")
    salted_left = left.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread), F.coalesce("_n_salts", F.lit(1))).cast("int")
    ).drop("_n_salts")
    salted_right = right.withColumn("_salt", F.explode(F.expr("sequence(0, _n_salts - 1)"))).drop(
        "_n_salts"
    )
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")


# Ids of 8 bytes: a set of this size takes some hundred megabytes as a broadcast hash table.
MOST_BROADCAST_IDS = 5_000_000


def without_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is not among ``ids``.

    The ids are counted first. As long as they fit a broadcast they are sent as they are, beyond that as Bloom filters of a bounded
    size, so the rows, which may be as wide as whole documents, stay where they are. ``key`` is unique in ``rows``."""
    ids = cut_lineage(ids)
    n = ids.count()
    if n <= MOST_BROADCAST_IDS:
        return rows.join(F.broadcast(ids), key, "left_anti")
    return without_members(rows, ids, key, n, MOST_BROADCAST_IDS)
