"""Dedup, joins under skew, feed, synthetic data, evaluation against brute force."""

import hashlib
import json
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import sequences
from corpusmill.operators import dedup, evaluate, feed, shards, synth
from corpusmill.plans import bloom, skew
from corpusmill.session import scratch_path
from corpusmill.plans.skew import join_on_counted_key


@pytest.fixture(scope="module")
def copies(spark):
    """A third of the rows are copies of one text."""
    texts = ["hot" if i % 3 == 0 else f"text {i % 40}" if i % 5 == 0 else f"unique {i}" for i in range(900)]
    rows = [(i, f"/f/{i:04d}.txt", t) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, "ordinal long, path string, text string").repartition(6)


def test_dedup(copies):
    rows, df = copies
    prints = dedup.fingerprints(df)
    counts = Counter(t for _, _, t in rows)
    first = {}
    for _, path, text in rows:
        first.setdefault(text, path)
    assert {r.path for r in dedup.unique_index(prints).collect()} == set(first.values())
    assert {r.path for r in dedup.keep_first(df, "ordinal").collect()} == set(first.values())
    report = {bytes(r.hash): r.n_rows for r in dedup.duplicate_report(prints).collect()}
    assert report == {hashlib.sha256(t.encode()).digest(): n for t, n in counts.items() if n > 1}
    members = {(r.path, r.n_rows) for r in dedup.duplicate_members(prints).collect()}
    assert members == {(p, counts[t]) for _, p, t in rows if counts[t] > 1}
    listing = [(r.hash, r.path) for r in dedup.sorted_listing(prints).collect()]
    assert listing == sorted((hashlib.sha256(t.encode()).hexdigest(), p) for _, p, t in rows)
    assert tuple(dedup.hash_totals(prints).first()) == (900, 900)


def test_keep_first_beyond_the_broadcast(copies, monkeypatch):
    """Copies that are too many to send: no text is shuffled, and the same rows stay."""
    rows, df = copies
    want = {r.path for r in dedup.keep_first(df, "ordinal").collect()}
    monkeypatch.setattr(skew, "MOST_BROADCAST_IDS", 20)
    got = dedup.keep_first(df.sparkSession.createDataFrame(rows, "ordinal long, path string, text string"), "ordinal")
    assert {r.path for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange (hash|range|RoundRobin)", plan)


@pytest.mark.parametrize("most_sent, longs, levels", [(40, 16, 1), (3, 32, 2), (0, 64, 2), (0, 1, 1), (40, 1024, 1)])
def test_cascades_of_filters(spark, monkeypatch, most_sent, longs, levels):
    """Filters of all sizes, also ones that hit nearly everything."""
    monkeypatch.setattr(bloom, "LEAST_LONGS", 1)
    monkeypatch.setattr(bloom, "MOST_LONGS", longs)
    made = []
    of = bloom.bloom_filter
    monkeypatch.setattr(bloom, "bloom_filter", lambda keys, key, n: made.append(n) or of(keys, key, n))
    rows = spark.range(3000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), F.col("id").alias("v"))
    members = spark.range(3000).where("id % 11 = 0").select(F.col("id").alias("k"))
    got = bloom.without_members(rows, members, "k", members.count(), most_sent)
    assert sorted(r.v for r in got.collect()) == [i for i in range(3000) if i % 11]
    assert got.columns == rows.columns
    assert len(made) >= levels


def test_join_on_counted_key(spark):
    left = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17).alias("k"), "id")
    counted = left.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"), F.max("id").alias("m"))
    got = join_on_counted_key(left, counted, "k", "id")
    want = left.join(counted, "k")
    assert got.count() == 2000
    assert got.select("k", "id", "n_rows", "m").exceptAll(want.select("k", "id", "n_rows", "m")).isEmpty()
    assert join_on_counted_key(left, counted.where("k = 5"), "k", "id").count() == left.where("k = 5").count()


@pytest.fixture(scope="module")
def examples(spark):
    rows = [(i, list(range(i % 7 + 1))) for i in range(53)]
    return rows, spark.createDataFrame(rows, "k long, target array<bigint>").repartition(4)


def test_feed(spark, examples):
    rows, df = examples
    assert {r.k: r.target for r in feed.with_eos(df).collect()} == {k: t + [1] for k, t in rows}
    assert {r.k: r.target for r in feed.pad_rows(df, 4).collect()} == {k: (t + [0] * 4)[:4] for k, t in rows}
    assert feed.repeat(df, 3).count() == 159
    kept = feed.batches(df, ["k"], 8, ["target"]).collect()
    assert sorted((r.batch, [e.target for e in r.examples]) for r in kept) == [
        (b, [t for _, t in rows[b * 8 : b * 8 + 8]]) for b in range(7)
    ]
    assert feed.batches(df, ["k"], 8, ["target"], drop_remainder=True).count() == 6
    assert feed.batches(df, ["k"], 100, ["target"]).count() == 1
    assert feed.batches(df, ["k"], 100, ["target"], drop_remainder=True).count() == 0
    assert [r.k for r in feed.take(df, ["k"], 5).collect()] == [0, 1, 2, 3, 4]
    order = [r.k for r in feed.shuffled(df, 3, ["k"]).collect()]
    assert order == sorted(range(53), key=lambda k: hashlib.md5(f"3-{k}".encode()).hexdigest())


def test_packed_tokens_are_all_kept(examples):
    rows, df = examples
    packed = feed.pack_rows(feed.with_eos(df), ["k"], 16).collect()
    tokens = sum(1 for r in packed for s in r.segmentation if s)
    assert tokens == sum(len(t) + 1 for _, t in rows)
    assert all(len(r.targets) == len(r.segmentation) == len(r.position) == 16 for r in packed)


def test_sampling(spark):
    files = spark.range(10).withColumnRenamed("id", "f")
    draws = spark.range(200).withColumnRenamed("id", "draw")
    got = {r.draw: r.f for r in feed.sample_with_replacement(files, ["f"], draws, 9).collect()}
    assert got == {i: int(hashlib.md5(f"9-{i}".encode()).hexdigest()[:15], 16) % 10 for i in range(200)}


@pytest.mark.parametrize("n", [1, 4, 100, 6000])
def test_split(spark, n):
    problems = spark.range(n).withColumnRenamed("id", "idx")
    got = {r.idx for r in feed.split_test(problems, "idx", 1337).where("is_test").collect()}
    order = sorted(range(n), key=lambda i: (hashlib.md5(f"1337-{i}".encode()).hexdigest(), i))
    assert got == set(order[: min(int(n * 0.2), 1000)])


def test_interleave(spark):
    rows = [(f"f{i % 6 if i % 2 else 0}", i) for i in range(120)]
    df = spark.createDataFrame(rows, "file string, k long").repartition(5)
    got = [(r.file, r.k) for r in feed.interleaved(df, "file", ["k"], 2).collect()]
    by_file = {f: sorted(k for g, k in rows if g == f) for f in sorted({f for f, _ in rows})}
    names = list(by_file)
    want = []
    for c in range(0, len(names), 2):
        group = names[c : c + 2]
        for i in range(max(len(by_file[f]) for f in group)):
            want += [(f, by_file[f][i]) for f in group if i < len(by_file[f])]
    assert got == want


@pytest.mark.parametrize("cycle", [1, 2, 4, 9])
def test_interleave_with_freed_slots(spark, cycle):
    """Against a reader that visits its slots in turn."""
    sizes = {f"f{i:02d}": n for i, n in enumerate([5, 1, 30, 2, 2, 17, 1, 1, 3, 8])}
    rows = [(f, k) for f, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "file string, k long").repartition(5)
    got = [(r.file, r.k) for r in feed.interleaved_slots(df, "file", ["k"], cycle).collect()]
    names, slots, want, at = list(sizes), [None] * cycle, [], 0
    while names or any(slots):
        if slots[at] is None and names:
            slots[at] = (names.pop(0), 0)
        if slots[at] is not None:
            file, k = slots[at]
            slots[at] = (file, k + 1) if k < sizes[file] else None
            want += [(file, k)] if k < sizes[file] else []
        at = (at + 1) % cycle
    assert got == want


@pytest.mark.parametrize("buffer", [1, 7, 100, 5000])
def test_buffer_shuffle(spark, buffer):
    df = spark.range(900).withColumnRenamed("id", "k").repartition(7)
    got = {r.k: r.position for r in feed.buffer_shuffled(df, ["k"], buffer, 3).collect()}
    assert sorted(got.values()) == list(range(900)) == sorted(got)
    assert max(abs(k - p) for k, p in got.items()) < buffer
    assert buffer == 1 or sum(k != p for k, p in got.items()) > 600
    with pytest.raises(ValueError):
        feed.buffer_shuffled(df, ["k"], 0, 3)


def test_sum_one(spark):
    ids = spark.range(300).withColumnRenamed("id", "sample_id")
    for vocab in (9, 16):
        for r in synth.sum_one(ids, 8, vocab, 1337).collect():
            assert len(r.content) == len(r.target) == 8
            assert r.content[0] == r.target[0] == 2 and r.content[-2:] == r.target[-2:] == [1, 0]
            assert r.target[1:-2] == [x + 1 for x in r.content[1:-2]]
            assert all(4 <= x < vocab - 4 for x in r.content[1:-2])
    with pytest.raises(ValueError):
        synth.sum_one(ids, 8, 8, 1337)
    train, test = synth.sum_one(ids, 8, 16, 1), synth.sum_one(ids, 8, 16, 1, "test")
    assert train.join(test, ["sample_id", "content"]).count() < 300
    fresh = synth.new_samples_only(test, train)
    assert fresh.join(train.select("content"), "content").isEmpty()
    assert synth.new_samples_only(train, train).isEmpty()


def test_addition(spark):
    nd = 2
    rows = synth.addition_examples(synth.addition_problems(synth.every_problem(spark, nd), nd), nd)
    rows = rows.withColumn("equation", synth.humanize(F.col("render"), nd)).collect()
    assert len(rows) == 10000
    for r in rows:
        a, b = divmod(r.idx, 100)
        digits = [int(d) for d in f"{a:02d}{b:02d}{a + b:03d}"]
        assert r.render == "".join(map(str, digits)) and r.equation == f"{a} + {b} = {a + b}"
        assert r.x == digits[:-1] and r.y == [-100] * 3 + digits[4:]


def test_equations(spark):
    lines = ["1 + 2 = 3", "8 + 7 = 5", "9 + 1 = 0", "1 + 1 = 3", "words", ""]
    df = spark.createDataFrame([(t,) for t in lines], "text string")
    got = {r.text: (r.holds, r.holds_mod10) for r in synth.check_equations(df).collect()}
    assert got == {
        "1 + 2 = 3": (True, True), "8 + 7 = 5": (False, True), "9 + 1 = 0": (False, True),
        "1 + 1 = 3": (False, False), "words": (None, None), "": (None, None),
    }


def test_sequences(spark):
    df = spark.createDataFrame([("1 2 3", [0.1, 0.9, 0.9])], "q string, s array<double>")
    row = df.select(sequences.encode_query(F.col("q")), sequences.argmax(F.col("s"))).first()
    assert row[0] == [2, 4, 5, 6, 1, 0, 0, 0] and row[1] == 1
    scores = [[0.0] * 8 for _ in range(3)]
    scores[0][5], scores[1][3], scores[2][7] = 1.0, 1.0, 1.0
    df = spark.createDataFrame([(scores,)], "s array<array<double>>")
    assert df.select(sequences.decode_answer(F.col("s"))).first()[0] == "2 4"


def test_metrics_and_lengths(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, -100.0), (5.0, 5.0)], "prediction double, label double")
    got = {r.name: r.value for r in evaluate.metrics(df).collect()}
    assert got["mean_squared_error"] == pytest.approx((1 + 103**2) / 3)
    assert got["masked_mean_squared_error"] == pytest.approx(0.5)
    assert (got["mean_prediction"], got["masked_mean_prediction"]) == (3.0, 3.0)
    location = scratch_path(spark, "metrics")
    evaluate.write_metrics(evaluate.metrics(df), location)
    assert json.loads(spark.read.text(location).first().value) == got
    assert tuple(evaluate.length_check(spark.range(17), 2, 8).first()) == (2, 2, True)
    assert tuple(evaluate.length_check(spark.range(15), 2, 8).first()) == (2, 1, False)


def test_compression_and_totals(spark):
    kind = lambda *paths: shards.compression_of(spark.createDataFrame([(p,) for p in paths], "path string")).first()[0]
    assert kind("a.gz", "b.gz") == "GZIP" and kind("a", "b.lz") == "NONE" and kind("a.gz", "b") == "INVALID"
    with pytest.raises(Exception, match="some do not"):
        shards.require_one_compression(spark.createDataFrame([("a.gz",), ("b",)], "path string")).collect()
    rows = spark.createDataFrame([([1, 2], 0), ([3], 0), ([], 1)], "target array<bigint>, shard long")
    assert tuple(shards.encode_totals(rows).first()) == (3, 3, 2, 1.5)


def test_null_contents_and_examples(spark):
    docs = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "a"), (5, "")], "k long, text string")
    assert sorted(r.k for r in dedup.keep_first(docs, "k").collect()) == [1, 2, 5]
    examples = spark.createDataFrame([(1, [1, 2]), (2, None), (3, []), (4, [3])], "k long, target array<long>")
    placed = feed.pack_placement(examples, ["k"], 4).select("k", "row_no", "offset", "size").collect()
    assert sorted(map(tuple, placed)) == [(1, 0, 0, 2), (4, 0, 2, 1)]
