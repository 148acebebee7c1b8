"""Language filter in batch, by join and in streams, against plain Python."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import lang, lang_weights
from corpusmill.operators.synth import sum_one
from corpusmill.session import scratch_path
from corpusmill.streaming.lines import filter_stream, kept_lines, line_stream
from corpusmill.streaming.synth import sample_stream, sum_one_stream

LANGUAGES = ["de", "en"]
TRAINING = [
    (0, "de", "der Hund und die Katze sind nicht hier"), (1, "de", "ich habe das nicht gesehen, weißt du"),
    (2, "en", "the dog and the cat are not here"), (3, "en", "this is something that they have seen"),
]
PROBES = ["the cat that is here", "die Katze ist nicht da", "", "  ", "ab", "abc", "日本語のテキスト", "und the", " the dog \n", "🙂🙂🙂🙂"]


def python_scores(text):
    counts = {name: Counter() for name in LANGUAGES}
    for _, name, t in TRAINING:
        counts[name].update(t[i : i + 3] for i in range(len(t) - 2))
    grams = set().union(*counts.values())
    stripped = text.strip()
    sums = []
    for name in LANGUAGES:
        total = sum(counts[name].values()) + len(grams)
        sums.append(sum(
            round(math.log((counts[name][stripped[i : i + 3]] + 1) / total) * 1e6) for i in range(len(stripped) - 2)
        ))
    best = max(sums)
    return LANGUAGES[sums.index(best)], 1 / sum(math.exp((s - best) / 1e6) for s in sums)


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(TRAINING, "i int, lang string, text string")
    return lang.train_model(df, LANGUAGES).cache()


@pytest.mark.parametrize("scored_by", [lang.score, lang.score_by_join])
def test_scores(spark, model, scored_by):
    units = spark.createDataFrame(list(enumerate(PROBES)), "i int, text string")
    got = {r.i: r for r in scored_by(units, model, LANGUAGES, ["i"]).collect()}
    for i, text in enumerate(PROBES):
        name, probability = python_scores(text)
        assert got[i].lang == name, text
        assert got[i].score == pytest.approx(probability, abs=1e-9)


def test_many_small_files_give_the_same(spark, model, monkeypatch):
    """Files of a few trigrams, and tasks that remember next to none."""
    units = spark.createDataFrame(list(enumerate(PROBES)), "i int, text string")
    want = {r.i: (r.lang, r.score) for r in lang.score(units, model, LANGUAGES, ["i"]).collect()}
    monkeypatch.setattr(lang_weights, "GRAMS_PER_FILE", 7)
    weights = lang_weights.write_weights(model, len(LANGUAGES))
    assert len(weights.files) > 5
    table = {r.gram: list(r.weights) for r in model.collect()}
    grams = sorted({*table, "zzz", "   ", "日本語"} - {""})
    got = weights.of(lang_weights.gram_keys(grams)).tolist()
    assert got == [table.get(g, table[""]) for g in grams]
    small = lang_weights.Remembered(weights)
    monkeypatch.setattr(lang_weights, "REMEMBERED", 5)
    for _ in range(3):
        assert small.of(lang_weights.gram_keys(grams[::-1])).tolist() == got[::-1]
    assert {r.i: (r.lang, r.score) for r in lang.score(units, model, LANGUAGES, ["i"]).collect()} == want


def test_large_models_in_streams(spark, tmp_path):
    """Ten million weights: more than was ever sent to tasks."""
    alphabet = [chr(0x4E00 + i) for i in range(130)]
    letter = lambda e: F.get(F.array(*map(F.lit, alphabet)), (e % 130).cast("int"))
    i = F.col("id")
    gram = F.concat(letter(i), letter(F.floor(i / 130)), letter(F.floor(i / 16900)))
    weights = F.array(*[-(1_000_000 + (i * k) % 977_777) for k in (1, 2, 3, 5)]).cast("array<bigint>")
    model = spark.range(130**3).select(gram.alias("gram"), weights.alias("weights"))
    model = model.unionByName(spark.range(1).select(F.lit("").alias("gram"), F.array(*[F.lit(-9_000_000).cast("long")] * 4).alias("weights")))
    languages = ["a", "b", "c", "d"]
    texts = ["".join(alphabet[(k * j) % 130] for j in range(1, 40)) for k in range(1, 60)] + ["plain"]
    units = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    scored = {r.i: (r.lang, r.score) for r in lang.score(units, model, languages, ["i"]).collect()}
    joined = {r.i: (r.lang, r.score) for r in lang.score_by_join(units, model, languages, ["i"]).collect()}
    assert scored.keys() == joined.keys()
    assert all(scored[k][0] == joined[k][0] and abs(scored[k][1] - joined[k][1]) < 1e-9 for k in scored)
    folder, output = f"{tmp_path}/in", f"{tmp_path}/out"
    units.select("text").write.text(folder)
    filter_stream(line_stream(spark, folder), model, languages, ["a", "b"], output, f"{tmp_path}/at", 0.5).awaitTermination()
    want = sorted(texts[k] for k, (name, score) in scored.items() if name in "ab" and score > 0.5)
    assert sorted(r.text for r in kept_lines(spark, output).collect()) == want and want


def test_filter_is_strict_and_reverse_is_the_complement(spark, model):
    units = spark.createDataFrame(list(enumerate(PROBES)), "i int, text string")
    kept = {r.i for r in lang.filter_units(units, model, LANGUAGES, ["en"], 0.9).collect()}
    dropped = {r.i for r in lang.filter_units(units, model, LANGUAGES, ["en"], 0.9, reverse=True).collect()}
    want = {i for i, t in enumerate(PROBES) if python_scores(t)[0] == "en" and python_scores(t)[1] > 0.9}
    assert kept == want and dropped == set(range(len(PROBES))) - want
    # A score equal to the threshold is not above it.
    assert lang.filter_units(units, model, LANGUAGES, LANGUAGES, 1.0).isEmpty()


def test_stream_equals_batch(spark, model):
    folder = scratch_path(spark, "lines")
    output, checkpoint = scratch_path(spark, "kept"), scratch_path(spark, "offsets")
    lines = [t for t in PROBES if "\n" not in t] * 5
    spark.createDataFrame([(t,) for t in lines], "value string").repartition(4).write.text(folder)
    query = filter_stream(line_stream(spark, folder, 1), model, LANGUAGES, ["en"], output, checkpoint)
    query.awaitTermination()
    units = spark.createDataFrame([(t,) for t in lines], "text string")
    batch = lang.filter_units(units, model, LANGUAGES, ["en"])
    first = kept_lines(spark, output)
    assert first.exceptAll(batch).isEmpty() and batch.exceptAll(first).isEmpty() and not first.isEmpty()
    # Restarted with new input, only the new lines are added.
    spark.createDataFrame([("the dog and the cat",)], "value string").write.mode("append").text(folder)
    filter_stream(line_stream(spark, folder), model, LANGUAGES, ["en"], output, checkpoint).awaitTermination()
    assert kept_lines(spark, output).count() == batch.count() + 1


def test_endless_examples_equal_batch(spark):
    output = scratch_path(spark, "endless")
    stream = sum_one_stream(sample_stream(spark, 50, 2), 8, 16, 1337)
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "offsets"))
        .trigger(processingTime="100 milliseconds").start(output)
    )
    try:
        for _ in range(100):
            if (query.lastProgress or {}).get("batchId", -1) >= 2:
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    rows = spark.read.schema("sample_id long, content array<bigint>, target array<bigint>").parquet(output)
    n = rows.count()
    assert n >= 100 and n % 50 == 0
    assert rows.exceptAll(sum_one(spark.range(n).withColumnRenamed("id", "sample_id"), 8, 16, 1337)).isEmpty()


def test_joined_scores_move_each_trigram_of_a_block_once(spark, model, monkeypatch):
    """Units of many blocks, also empty ones; equal keys add up; the join sees few trigrams of many equal units."""
    want = {r.i: r for r in lang.score(spark.createDataFrame(list(enumerate(PROBES)), "i int, text string"), model, LANGUAGES, ["i"]).collect()}
    units = [(n * 1000 + i, text) for n in range(40) for i, text in enumerate(PROBES)] + [(-1, ""), (-2, None), (-3, "ab")]
    rows = spark.createDataFrame(units, "i int, text string").repartition(3)
    for size in (5, 8192):
        monkeypatch.setattr(lang, "UNITS_PER_BLOCK", size)
        scored = lang.score_by_join(rows, model, LANGUAGES, ["i"])
        got = {r.i: r for r in scored.collect()}
        assert set(got) == {i for i, _ in units}
        assert all(got[i].lang == want[i % 1000].lang and abs(got[i].score - want[i % 1000].score) < 1e-9 for i in got if i >= 0)
        assert all((got[i].lang, got[i].score) == (LANGUAGES[0], 1 / len(LANGUAGES)) for i in (-1, -2, -3))
    # The plan deals out distinct trigrams of blocks, not those of units.
    assert "_block" in scored._jdf.queryExecution().executedPlan().toString()
