"""Exact membership in a large set of keys without moving wide rows: a cascade of Bloom filters.

A filter of the members hits all of them and a few of the other keys. These few are a smaller set, for which a second filter is made; what it
hits among the members is a smaller set again, and so on, until a set is small enough to be sent as it is. As all keys of the
table are known, the answer is exact: the first filter that a key misses, or the last set, decides. Only keys are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.session import cut_lineage

BITS_PER_KEY, HASHES = 10, 5
# A filter is an array of longs that every task holds: 32 MB at most.
LEAST_LONGS, MOST_LONGS = 1 << 10, 1 << 22
# A level that leaves more than this share of the keys of the level two before it doesn't pay.
LEAST_GAIN = 0.5


@dataclass
class BloomFilter:
    """``bits``: one value, an array of longs."""

    bits: Column
    longs: int

    def hits(self, key: str) -> Column:
        def is_set(i: int) -> Column:
            place = _place(key, i, self.longs)
            word = F.get(self.bits, F.shiftright(place, 6).cast("int"))
            return F.call_function("getbit", word, place.bitwiseAND(F.lit(63)).cast("int")) == 1

        return reduce(lambda a, b: a & b, map(is_set, range(HASHES)))


def _place(key: str, i: int, longs: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(64 * longs))


def bloom_filter(keys: DataFrame, key: str, n: int) -> BloomFilter:
    """The filter of ``n`` keys. Tasks set bits in their own longs; at most ``MOST_LONGS`` rows come together."""
    longs = LEAST_LONGS
    while longs < MOST_LONGS and 64 * longs < BITS_PER_KEY * n:
        longs *= 2
    places = F.explode(F.array(*[_place(key, i, longs) for i in range(HASHES)])).alias("place")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    filled = (
        keys.select(places)
        .groupBy(F.shiftright("place", 6).alias("at"))
        .agg(F.bit_or(mask).alias("bits"))
    )
    every = keys.sparkSession.range(longs).withColumnRenamed("id", "at").join(filled, "at", "left")
    row = F.struct("at", F.coalesce("bits", F.lit(0)).alias("bits"))
    listed = cut_lineage(every.agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["bits"]).alias("bits")))
    return BloomFilter(listed.scalar(), longs)


def without_members(rows: DataFrame, members: DataFrame, key: str, n: int, most_sent: int) -> DataFrame:
    """``rows`` whose ``key`` is not among the ``n`` ``members``, null keys included. At most ``most_sent`` keys are sent as they are.

    Where a filter no longer tells the two sides apart, because it would have to be larger than ``MOST_LONGS``, the rows that no filter
    decides are joined by shuffle; the others stay where they are."""
    inside, n_inside = members, n
    outside = cut_lineage(rows.select(key).distinct().join(members, key, "left_anti"))
    n_outside = outside.count()
    filters: list[BloomFilter] = []
    while True:
        filters.append(bloom_filter(inside, key, n_inside))
        mistaken = cut_lineage(outside.where(filters[-1].hits(key)))
        n_mistaken = mistaken.count()
        if n_mistaken <= most_sent or n_mistaken > LEAST_GAIN * n_outside:
            break
        inside, outside, n_inside, n_outside = mistaken, inside, n_mistaken, n_inside
    # The keys of the first, third, ... filter are members. A key that a filter misses is of the other side.
    is_members = len(filters) % 2 == 1

    def kept(undecided: Column) -> Column:
        for i in range(len(filters), 0, -1):
            undecided = F.when(filters[i - 1].hits(key), undecided).otherwise(F.lit(i % 2 == 1))
        return F.col(key).isNull() | undecided

    if n_mistaken <= most_sent:
        marked = rows.join(F.broadcast(mistaken.withColumn("_mistaken", F.lit(True))), key, "left")
        found = F.col("_mistaken").isNotNull()
        return marked.where(kept(found if is_members else ~found)).drop("_mistaken").select(*rows.columns)
    every = F.col(key).isNotNull() & reduce(lambda a, b: a & b, [f.hits(key) for f in filters])
    return rows.where(kept(F.lit(False))).unionByName(rows.where(every).join(members, key, "left_anti").select(*rows.columns))
