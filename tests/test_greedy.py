"""Distributed greedy cuts against the single-task fold."""

import random

import pytest

from corpusmill.operators import shards
from corpusmill.plans import greedy
from corpusmill.operators.feed import pack_placement, pack_rows
from corpusmill.operators.shards import count_chunks, size_shards
from corpusmill.plans.ordinal import with_running


def fold_reached(sizes, limit):
    out, chunk, total = [], 0, 0
    for size in sizes:
        out.append(chunk)
        total += size
        if total >= limit:
            chunk, total = chunk + 1, 0
    return out


def fold_fit(sizes, limit):
    out, row, used = [], 0, 0
    for size in sizes:
        size = min(size, limit)
        if used + size > limit:
            row, used = row + 1, 0
        out.append((row, used))
        used += size
    return out


CASES = {
    "even": [3] * 500,
    "random": [random.Random(1).randint(1, 40) for _ in range(2000)],
    "zeros": [random.Random(2).choice([0, 0, 1, 7, 30]) for _ in range(800)],
    "huge": [1, 2, 5000, 1, 1, 0, 3, 900, 1, 1, 1, 20000, 2, 0],
    "one": [4],
    "exact": [10, 10, 5, 5, 0],
    "nothing": [0, 0, 0],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("limit,fanout", [(10, 2), (37, 3), (10, None)])
def test_size_shards(spark, name, limit, fanout):
    sizes = CASES[name]
    files = spark.createDataFrame(list(enumerate(sizes)), "ordinal_no long, size long").repartition(5)
    rows = size_shards(files, ["ordinal_no"], "size", limit, fanout).collect()
    got = [r.shard for r in sorted(rows, key=lambda r: r.ordinal_no)]
    assert got == fold_reached(sizes, limit)


def test_with_shard(spark, monkeypatch):
    files = spark.createDataFrame([(i * 3, i % 11) for i in range(300)], "k long, size long").repartition(5)
    plan = shards.size_shards(files, ["k"], "size", 25)
    for most in (shards.MOST_SENT_SHARDS, 1):
        monkeypatch.setattr(shards, "MOST_SENT_SHARDS", most)
        placed = shards.with_shard(files, plan, "k").select("k", "shard")
        assert placed.count() == 300 and placed.exceptAll(plan).isEmpty()


def test_size_shards_without_limit(spark):
    files = spark.createDataFrame([(0, 5), (1, 0), (2, 9)], "k long, size long")
    rows = size_shards(files, ["k"], "size", 0).collect()
    assert sorted((r.k, r.shard) for r in rows) == [(0, 0), (1, 1), (2, 2)]


@pytest.mark.parametrize("name", ["even", "random", "huge", "one"])
@pytest.mark.parametrize("limit,fanout", [(40, 2), (17, 3), (64, None)])
def test_pack_placement(spark, name, limit, fanout):
    sizes = [s for s in CASES[name] if s]
    rows = [(i, list(range(1, s + 1))) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "k long, target array<bigint>").repartition(3)
    got = pack_placement(df, ["k"], limit, fanout=fanout).collect()
    assert [(r.row_no, r.offset) for r in sorted(got, key=lambda r: r.k)] == fold_fit(sizes, limit)


def test_pack_rows(spark):
    df = spark.createDataFrame(
        [(0, [5, 6]), (1, [7]), (2, [8, 9, 10]), (3, list(range(20, 30))), (4, [1])],
        "k long, target array<bigint>",
    )
    rows = [tuple(r) for r in pack_rows(df, ["k"], 4).orderBy("row_no").collect()]
    assert rows == [
        (0, [5, 6, 7, 0], [1, 1, 2, 0], [0, 1, 0, 0]),
        (1, [8, 9, 10, 0], [1, 1, 1, 0], [0, 1, 2, 0]),
        (2, [20, 21, 22, 23], [1, 1, 1, 1], [0, 1, 2, 3]),
        (3, [1, 0, 0, 0], [1, 0, 0, 0], [0, 0, 0, 0]),
    ]


def test_running_totals(spark):
    rows = [(i * 7 % 1000, i % 13) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, size long").repartition(6)
    got = sorted(with_running(df, ["k"], "size").collect(), key=lambda r: r.k)
    total = 0
    for i, r in enumerate(got):
        assert (r._ordinal, r._start) == (i, total)
        total += r["size"]


def test_count_chunks(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    for n in (0, 3):
        got = {r.k: r.chunk for r in count_chunks(df, ["k"], n).collect()}
        assert got == {i: i // max(n, 1) for i in range(10)}


def test_rows_outside_the_plan_get_no_shard(spark, monkeypatch):
    plan = spark.createDataFrame([(k, (k - 3) // 2) for k in range(3, 7)], "k long, shard long")
    rows = spark.createDataFrame([(k,) for k in [*range(10), None]], "k long")
    for most in (1, 5_000_000):
        monkeypatch.setattr(shards, "MOST_SENT_SHARDS", most)
        assert sorted(map(tuple, shards.with_shard(rows, plan, "k").select("k", "shard").collect())) == [(3, 0), (4, 0), (5, 1), (6, 1)]


def test_null_sizes_count_as_nothing(spark):
    files = spark.createDataFrame([(0, 5), (1, None), (2, 5), (3, None), (4, 1)], "k long, n long")
    assert sorted(map(tuple, shards.size_shards(files, ["k"], "n", 10).collect())) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)]


@pytest.mark.parametrize("limit", [10, 37])
def test_many_empty_files_share_positions(spark, monkeypatch, limit):
    """Files without a byte at the beginning, in between and at the end go through no block, and land where a fold puts them."""
    sizes = [0] * 3000 + [4, 0, 0, 6] * 5 + [0] * 9000 + [7] * 8 + [3, 0, 10] + [0] * 3000
    seen = []
    assign = greedy._assign
    monkeypatch.setattr(greedy, "_assign", lambda items, *more: seen.append(items.count()) or assign(items, *more))
    for fanout in (None, 2):
        files = spark.createDataFrame(list(enumerate(sizes)), "k long, n long").repartition(5)
        got = {r.k: r.shard for r in shards.size_shards(files, ["k"], "n", limit, fanout).collect()}
        shard = held = 0
        for k, n in enumerate(sizes):
            assert got[k] == shard, (k, limit, fanout)
            held += n
            if held >= limit:
                shard, held = shard + 1, 0
    assert max(seen) <= 2 * sum(n > 0 for n in sizes) + 1
