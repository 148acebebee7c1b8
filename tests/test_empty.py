"""Operators on tables without rows, and on one row."""

import pytest

from corpusmill.operators import bpe_encode, bpe_train, dedup, feed, lang, shards
from corpusmill.operators.units import split_units


@pytest.fixture(scope="module", params=[0, 1])
def docs(spark, request):
    rows = [(7, "/a.txt", "some text\nin lines", [1, 2, 3], 5)][: request.param]
    schema = "ordinal long, path string, text string, target array<bigint>, size long"
    return request.param, spark.createDataFrame(rows, schema)


def test_empty(spark, docs):
    n, df = docs
    prints = dedup.fingerprints(df)
    for result in (
        dedup.keep_first(df, "ordinal"),
        dedup.unique_index(prints),
        shards.size_shards(df, ["ordinal"], "size", 10),
        shards.count_chunks(df, ["ordinal"], 3),
        feed.pack_rows(df, ["ordinal"], 8),
        feed.batches(df, ["ordinal"], 4, ["target"]),
        feed.interleaved(df, "path", ["ordinal"]),
        feed.split_test(df, "ordinal", 1),
    ):
        assert result.count() == n
    assert dedup.duplicate_members(prints).isEmpty()
    assert split_units(df, "line").count() == 2 * n
    assert feed.sample_with_replacement(df.select("ordinal"), ["ordinal"], spark.range(3).toDF("draw"), 1).count() == 3 * n


def test_empty_models(spark, docs):
    n, df = docs
    model = bpe_train.train(bpe_train.word_counts(df), 300)
    assert len(model.tokens) >= 258
    assert bpe_encode.encode_with_offsets(df, model).count() == n
    weights = lang.train_model(df.selectExpr("'en' AS lang", "text"), ["en", "de"])
    probes = spark.createDataFrame([(0, "some text"), (1, ""), (2, None)], "i int, text string")
    assert lang.score(probes, weights, ["en", "de"], ["i"]).count() == 3
    assert lang.score(df.select("ordinal", "text"), weights, ["en", "de"], ["ordinal"]).count() == n
