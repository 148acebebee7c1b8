"""Queries on whole texts over tables of their own."""

import hashlib
import itertools
from collections import Counter

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from __spark_entry__ import queries
from check import compare, connect
from corpusmill.catalog import texts, tokens, uncut


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Few documents, and a benchmark with more words than a vocabulary of 1010 tokens."""
    folder = str(tmp_path_factory.mktemp("tables"))
    words = ["wort" + "".join(x) for x in itertools.product("abcdefghijk", repeat=3)]
    docs = [(1, f"{words[0]} and {words[7]} and {words[0]}."), (2, "naïve text"), (3, ""), (4, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    items = [(i, " ".join(words[i : i + 100])) for i in range(0, len(words), 100)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert len(words) > uncut.VOCAB_SIZE
    return folder, words


def test_model_whatever_the_lexicon(spark, tables):
    decoded = {r.doc_id: r.decoded for r in uncut.decode_uncut(spark, tables[0]).collect()}
    assert decoded[2] == " naïve text" and decoded[3] == ""
    assert uncut.bpe_merges_uncut(spark, tables[0]).count() > 0
    probes = uncut.saved_tokenizer_probes(spark, tables[0]).first()
    assert probes.probes == probes.same > 10


def test_lexicon_larger_than_the_vocabulary(spark, tables):
    folder, words = tables
    assert {r.word: r.n for r in uncut.added_tokens_uncut(spark, folder).collect()} == {words[0]: 2, words[7]: 1}


def test_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """The driver never holds the list of the documents' files."""
    docs = [(i, None if i % 50 == 0 else f"text {i % 7}") for i in range(2500)]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(texts, "files_at", None)
    found = {r.hash: r.n for r in texts.dedup_files(spark, str(tmp_path)).collect()}
    kept = Counter(text or "" for _, text in docs)
    assert found == {hashlib.sha256(f"{text}\n".encode()).hexdigest(): n for text, n in kept.items()}


def test_totals_with_a_whole_vocabulary(spark, tmp_path):
    """Merges go on until the vocabulary is full or no pair is left: each word becomes one token here. SQL trains the same way."""
    long = ["".join(chr(97 + (i * k + i // 7) % 26) for i in range(60)) for k in (3, 5)]
    docs = [(1, f"{long[0]} {long[1]} {long[0]}"), (2, f"{long[1]} {long[0]} {long[1]}")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert tokens.totals(spark, str(tmp_path)).first().tokens == 6
    assert compare(spark, connect(str(tmp_path)), str(tmp_path), "encode_totals").startswith("ok")


@pytest.mark.parametrize("name", ["records_roundtrip", "records_roundtrip_plain", "encode_lines_to_records"])
def test_texts_move_to_the_record_files(spark, tmp_path, monkeypatch, name):
    """What is made of a text takes many times its room: it is made where it is written, without a shuffle in between."""
    docs = [(3, "c c\nlines"), (1, "a line\n\nand more"), (None, "no id"), (2, None), (1, "again")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    plans, save = [], DataFrameWriter.save

    def seen(self, *args, **options):
        plans.append(self._df._jdf.queryExecution().sparkPlan().toString())
        return save(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "save", seen)
    assert queries()[name](spark, str(tmp_path)).count() > 0
    (plan,) = [p for p in plans if "MapInArrow" in p]
    assert "Exchange" in plan and plan.index("MapInArrow") < plan.index("Exchange")
