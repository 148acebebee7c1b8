"""Units, cleaning and text expressions against plain Python."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import numbers
from corpusmill.functions.text import (
    collapse_non_ascii, fingerprint64, lines_of, passages_of, slices, strip, trigrams_of, words_of,
)
from corpusmill.operators import clean
from corpusmill.operators.units import check_supported, split_units

EDGES = [
    "", ".", "..", "a.b", "3.14.", "\n", "\n\n", "a\nb\n", "a\r\nb", "a\rb\r", "\r\n\r\n", "x\x0by\x0cz",
    "p\x1cq\x1dr\x1es", "t\x85u", "v w ", "🙂 astral\n🙂", "ﬁ Ｗｉｄｅ", "  lead and trail  ", " x　",
    "tab\tend", "naïve café — “quote”", "é", "no terminator",
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(99, None)]
    return spark.createDataFrame(rows, "i int, text string")


def column(df, expr):
    return {r.i: r.v for r in df.select("i", expr.alias("v")).collect()}


def test_expressions(edges):
    text = F.col("text")
    lines, passages = column(edges, lines_of(text)), column(edges, passages_of(text))
    ascii_only, stripped = column(edges, collapse_non_ascii(text)), column(edges, strip(text))
    grams, words = column(edges, trigrams_of(text)), column(edges, words_of(text))
    for i, t in enumerate(EDGES):
        assert lines[i] == t.splitlines(keepends=True), repr(t)
        assert passages[i] == t.split(".")
        assert ascii_only[i] == re.sub(r"[^\x00-\x7F]+", " ", t)
        assert stripped[i] == t.strip()
        assert grams[i] == [t[k : k + 3] for k in range(len(t) - 2)]
        assert "".join(words[i]) == t
    assert lines[99] is passages[99] is ascii_only[99] is None


def test_split_units(edges):
    got = split_units(edges, "line").collect()
    for i, t in enumerate(EDGES):
        rows = sorted((r.unit_no, r.text) for r in got if r.i == i)
        assert [x for _, x in rows] == t.splitlines(keepends=True)
        assert [n for n, _ in rows] == list(range(len(rows)))
    whole = {r.i: r.text for r in split_units(edges, "file").collect()}
    assert whole[0] == "" and len(whole) == len(EDGES) + 1


def test_unsupported_strategies():
    check_supported("line", [".txt", ".gz"])
    for by, extensions in [("passage", [".gz"]), ("file", [".zst"]), ("page", [])]:
        with pytest.raises(ValueError, match="what can be read is"):
            check_supported(by, extensions)


def test_clean_text(spark, edges):
    got = column(edges, clean.clean_text(F.col("text")))
    for i, t in enumerate(EDGES):
        plain = t.replace("\r\n", "\n").replace("\r", "\n").replace("“", '"').replace("”", '"')
        plain = re.sub("[  \x85]", "\n", unicodedata.normalize("NFKC", plain))
        plain = re.sub(r"[\x00-\x08\x0b\x0e-\x1f\x7f]", "", plain)
        assert got[i] == re.sub(r"[^\x00-\x7F]+", " ", plain), repr(t)
    assert got[99] is None
    cases = [
        ("fish &amp; chips", "fish & chips"), ("a < b &amp; c", "a < b &amp; c"), ("<p>\n&lt;", "<p>\n<"),
        ("it’s", "it's"), ("\x1b[31mred\x1b[0m", "red"), ("﻿bom", "bom"), ("日本", " "), ("&unknown;", "&unknown;"),
    ]
    df = spark.createDataFrame(cases, "text string, want string")
    for r in df.withColumn("got", clean.clean_text(F.col("text"))).collect():
        assert r.got == r.want


def test_files_and_guards(spark):
    files = spark.createDataFrame([("/a/x.txt", "é"), ("/b/x.txt", "b"), ("/c.TXT", "c"), ("d.txt", "d")], "path string, text string")
    assert {(r.path, r.text) for r in clean.clean_files(files).collect()} == {("/a/x.txt", " "), ("/b/x.txt", "b"), ("d.txt", "d")}
    assert tuple(clean.clean_totals(files).first()) == (3, 4)
    assert [r.path for r in clean.relative_paths(files).collect()] == ["d.txt"]
    with pytest.raises(Exception, match="must be absolute"):
        clean.require_absolute_paths(files).collect()
    assert clean.require_absolute_paths(files.where("path like '/%'")).count() == 3


def test_offsets_count_characters(spark):
    df = spark.createDataFrame([("a🙂bc", [0, 1, 2], [1, 2, 4])], "t string, s array<bigint>, e array<bigint>")
    assert df.select(slices(F.col("t"), F.col("s"), F.col("e"))).first()[0] == ["a", "🙂", "bc"]


def test_numbers(spark):
    import hashlib

    df = spark.createDataFrame([(0, 1234567, 1234.5), (128, 1, 0.0), (1010, -5000, 2.345)], "n long, i long, x double")
    rounded = [r[0] for r in df.select(numbers.round_vocab(F.col("n"))).collect()]
    assert rounded == [0, 128, 1024]
    types = {f.name: f.dataType for f in df.schema.fields}
    shown = df.select(numbers.human_number(F.col("i"), types["i"]), numbers.human_number(F.col("x"), types["x"])).collect()
    assert [tuple(r) for r in shown][:2] == [("1,234,567", "1,234.50"), ("1", "0.00")]
    key = df.select(numbers.seeded_int(7, "train", F.col("n"))).first()[0]
    assert key == int(hashlib.md5(b"7-train-0").hexdigest()[:8], 16)
    uid = df.limit(1).select(fingerprint64(F.lit("abc"))).first()[0]
    assert int(uid) == int(hashlib.sha256(b"abc").hexdigest()[:16], 16)
