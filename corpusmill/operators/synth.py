"""Deterministic synthetic sequence data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.numbers import seeded_int
from corpusmill.functions.sequences import (
    BOS,
    EOS,
    PAD,
    RESERVED_IDS,
    add_one,
    next_token_inputs,
    next_token_labels,
)
from corpusmill.plans.skew import join_on_counted_key


def sum_one(samples: DataFrame, length: int, vocab_size: int, seed: int, split: str = "train") -> DataFrame:
    """(sample_id, content, target): random sequences and the same ones plus one, framed by BOS, EOS
    and a PAD. Each id depends on seed, split, sample and place only, so any number of tasks (or a
    stream) generates the same rows.
    """
    if vocab_size < 9:
        raise ValueError("vocab_size must be at least 9")
    if length <= RESERVED_IDS:
        raise ValueError("length must exceed the three reserved ids")
    low, high = RESERVED_IDS + 1, vocab_size - RESERVED_IDS - 1
    place = F.sequence(F.lit(1), F.lit(length - RESERVED_IDS))
    drawn = F.transform(
        place,
        lambda i: low + F.pmod(seeded_int(seed, split, F.col("sample_id"), i), F.lit(high - low)),
    )
    bos, eos, pad = (F.array(F.lit(x).cast("bigint")) for x in (BOS, EOS, PAD))
    return samples.select("sample_id", drawn.alias("_ids")).select(
        "sample_id",
        F.concat(bos, "_ids", eos, pad).alias("content"),
        F.concat(bos, add_one(F.col("_ids")), eos, pad).alias("target"),
    )


def new_samples_only(test: DataFrame, train: DataFrame) -> DataFrame:
    """Test samples whose content does not occur in the training samples. Distinct contents are compared,
    so a content that many samples share meets the other side once."""
    contents = test.groupBy("content").agg(F.count(F.lit(1)).alias("n_rows"))
    fresh = contents.join(train.select("content").distinct(), "content", "left_anti")
    return join_on_counted_key(test, fresh, "content", "sample_id").select(*test.columns)


def addition_problems(indices: DataFrame, ndigits: int) -> DataFrame:
    """Problem index to ``a + b = c``: the index runs over all pairs of ``ndigits`` numbers."""
    base = 10**ndigits
    return (
        indices.withColumn("a", F.expr(f"idx div {base}"))
        .withColumn("b", F.expr(f"idx % {base}"))
        .withColumn("c", F.col("a") + F.col("b"))
    )


def every_problem(spark: SparkSession, ndigits: int) -> DataFrame:
    """The indices of all problems of ``ndigits`` numbers."""
    return spark.range(10 ** (2 * ndigits)).withColumnRenamed("id", "idx")


def render(a: Column, b: Column, c: Column, ndigits: int) -> Column:
    """Zero-padded digits of a, b and c (one digit more for the carry), without separators."""
    return F.concat(
        F.lpad(a.cast("string"), ndigits, "0"),
        F.lpad(b.cast("string"), ndigits, "0"),
        F.lpad(c.cast("string"), ndigits + 1, "0"),
    )


def humanize(rendered: Column, ndigits: int) -> Column:
    """The rendered digits back as ``a + b = c``."""
    part = lambda at, n: F.substring(rendered, at, n).cast("bigint")
    return F.format_string(
        "%d + %d = %d", part(1, ndigits), part(ndigits + 1, ndigits), part(2 * ndigits + 1, ndigits + 1)
    )


def addition_examples(problems: DataFrame, ndigits: int) -> DataFrame:
    """Adds ``render``, the inputs ``x`` and the next-token labels ``y``, masked up to the sum."""
    digits = F.transform(F.split("render", ""), lambda d: d.cast("int"))
    return (
        problems.withColumn("render", render(F.col("a"), F.col("b"), F.col("c"), ndigits))
        .withColumn("_digits", digits)
        .withColumn("x", next_token_inputs(F.col("_digits")))
        .withColumn("y", next_token_labels(F.col("_digits"), 2 * ndigits - 1))
        .drop("_digits")
    )


def check_equations(lines: DataFrame, text: str = "text") -> DataFrame:
    """Splits lines of the form ``a + b = c`` and says whether they hold, plainly and modulo 10.
    Lines of another form get NULLs."""
    # Fixed value: the form of an equation line.
    pattern = r"^\s*(\d+) \+ (\d+) = (\d+)\s*$"
    part = lambda i: F.nullif(
        F.regexp_extract(F.col(text), pattern, i), F.lit("")
    ).cast("bigint")
    return (
        lines.withColumns({"a": part(1), "b": part(2), "c": part(3)})
        .withColumn("holds", F.col("a") + F.col("b") == F.col("c"))
        .withColumn("holds_mod10", (F.col("a") + F.col("b")) % 10 == F.col("c"))
    )
