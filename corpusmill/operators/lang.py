"""Language filter: a character-trigram classifier.

The model is a table built by grouping: for each trigram and language the add-one smoothed log probability,
in millionths as integers, so that sums do not depend on any order. It is written as sorted files that tasks look trigrams up in
(``lang_weights``), whatever its size: scoring is a map-only step on batches of units, in batch and stream alike, and nothing as large
as the trigrams of a corpus is ever shuffled. ``score_by_join`` gives the same sums by a join.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from corpusmill.functions.text import strip, trigrams_of
from corpusmill.operators.lang_weights import Remembered, gram_keys, write_weights
from corpusmill.session import scratch_path

SCALE = 1_000_000
# Neighbouring units that ask for the weights of their trigrams together, and characters that are added up at a time.
UNITS_PER_BLOCK, _CHARACTERS_AT_A_TIME = 8192, 1 << 18


def train_model(labelled: DataFrame, languages: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    """(gram, weights): one weight per language in the order of ``languages``; the row with an empty gram
    holds the weights of trigrams never seen."""
    counts = (
        labelled.where(F.col(lang).isin(languages))
        .select(lang, F.explode(trigrams_of(strip(F.col(text)))).alias("gram"))
        .groupBy("gram")
        .agg(*[F.count_if(F.col(lang) == name).alias(f"n{i}") for i, name in enumerate(languages)])
    )
    totals = counts.agg(
        F.struct(
            F.count(F.lit(1)).alias("grams"),
            *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(languages))],
        ).alias("t")
    ).scalar()
    unseen = counts.sparkSession.range(1).select(
        F.lit("").alias("gram"), *[F.lit(0).cast("bigint").alias(f"n{i}") for i in range(len(languages))]
    )

    def weight(i: int) -> Column:
        # Without any training text every language is equally likely.
        share = (F.col(f"n{i}") + 1) / F.greatest(F.col("_t")[f"n{i}"] + F.col("_t")["grams"], F.lit(1))
        return F.round(F.log(share) * SCALE).cast("bigint")

    return (
        counts.unionByName(unseen)
        .withColumn("_t", totals)
        .select("gram", F.array(*[weight(i) for i in range(len(languages))]).alias("weights"))
    )


def scorer(model: DataFrame, languages: list[str]) -> Callable[[Column], Column]:
    """A column function: text to (lang, score), the most likely language and its probability. Equal
    languages go to the first one listed; a text without a trigram gets the first one at even odds."""
    weights = Remembered(write_weights(model, len(languages)))

    def score_batch(texts: pa.Array) -> pa.Array:
        sums = _weight_sums([(t or "").strip() for t in texts.to_pylist()], weights)
        best = sums.argmax(axis=1)
        odds = np.exp((sums - sums.max(axis=1, keepdims=True)) / SCALE).sum(axis=1)
        names = pa.array(languages).take(pa.array(best))
        return pa.StructArray.from_arrays([names, pa.array(1 / odds)], names=["lang", "score"])

    return F.arrow_udf(
        score_batch, StructType([StructField("lang", StringType()), StructField("score", DoubleType())])
    )


def _weight_sums(texts: list[str], weights: Remembered) -> np.ndarray:
    """One row of summed weights per text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    grams = codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]
    # Places whose next two characters reach into the following text are left out.
    inside = np.ones(len(grams), bool)
    over = (ends[:, None] - np.array([1, 2])).ravel()
    inside[over[(over >= 0) & (over < len(grams))]] = False
    counted = np.insert(np.cumsum(inside), 0, 0)
    summed = np.cumsum(weights.of(grams[inside]), axis=0, dtype=np.int64)
    running = np.concatenate([np.zeros((1, summed.shape[1]), np.int64), summed])
    return running[counted[np.minimum(ends, len(grams))]] - running[counted[np.minimum(ends - sizes, len(grams))]]


def score(
    units: DataFrame, model: DataFrame, languages: list[str], keys: list[str], text: str = "text"
) -> DataFrame:
    """(keys, lang, score) of every unit."""
    scored = units.select(*keys, scorer(model, languages)(F.col(text)).alias("_s"))
    return scored.select(*keys, "_s.lang", "_s.score")


def score_by_join(
    units: DataFrame, model: DataFrame, languages: list[str], keys: list[str], text: str = "text"
) -> DataFrame:
    """``score`` by shuffles, whatever the size of the model: units are taken in blocks of neighbouring ones, the different trigrams
    of each block meet their weights in a join, and go back to the units of their block, which add them up. A block repeats
    its trigrams so often that these rows are few beside the trigrams of all units. ``keys`` must be unique together."""
    k = range(len(languages))
    path = scratch_path(units.sparkSession, "lang-units")
    # Written, so that both readings see the same blocks.
    block = F.expr(f"monotonically_increasing_id() div {UNITS_PER_BLOCK}")
    placed = units.select(*keys, strip(F.col(text)).alias("_text")).withColumn("_block", block)
    placed.write.parquet(path)
    placed = units.sparkSession.read.schema(placed.schema).parquet(path)
    unseen = model.where("gram = ''").select("weights").scalar()
    asked = placed.select("_block", F.explode(trigrams_of(F.col("_text"))).alias("gram")).distinct()
    weights = asked.join(model, "gram", "left").select(F.col("_block").alias("_asking"), "gram", F.coalesce("weights", unseen).alias("weights"))
    fields = [placed.schema[key] for key in keys] + [StructField(f"s{i}", LongType()) for i in k]

    def add(rows: pa.Table, looked_up: pa.Table) -> pa.Table:
        known = _OfBlock(looked_up, len(languages))
        texts = [t or "" for t in rows["_text"].to_pylist()]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        sums, a = [np.zeros((0, len(languages)), np.int64)], 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _CHARACTERS_AT_A_TIME, "right")))
            sums.append(_weight_sums(texts[a:b], known))
            a = b
        total = np.concatenate(sums)
        return pa.table({**{key: rows[key] for key in keys}, **{f"s{i}": total[:, i] for i in k}})

    parts = placed.groupBy("_block").cogroup(weights.groupBy("_asking")).applyInArrow(add, StructType(fields))
    summed = parts.groupBy(*keys).agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in k])
    best = F.array_max(F.array(*[F.col(f"s{i}") for i in k]))
    odds = sum((F.exp((F.col(f"s{i}") - F.col("_best")) / SCALE) for i in k), F.lit(0.0))
    label = F.coalesce(*[F.when(F.col(f"s{i}") == F.col("_best"), F.lit(languages[i])) for i in k])
    return summed.withColumn("_best", best).select(*keys, label.alias("lang"), (1 / odds).alias("score"))


class _OfBlock:
    """The weights of all trigrams of a block, from (gram, weights)."""

    def __init__(self, rows: pa.Table, languages: int):
        keys = gram_keys(rows["gram"].to_pylist())
        order = np.argsort(keys)
        weights = rows["weights"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.keys, self.weights = keys[order], weights.reshape(-1, languages)[order]

    def of(self, grams: np.ndarray) -> np.ndarray:
        return self.weights[np.searchsorted(self.keys, grams)]


def passes(lang: Column, score: Column, langs: list[str], threshold: float = 0.9, reverse: bool = False) -> Column:
    """Whether a scored unit is kept: wanted language and a score above the threshold, or not that."""
    kept = lang.isin(langs) & (score > threshold)
    return ~kept if reverse else kept


def filter_units(
    units: DataFrame, model: DataFrame, languages: list[str], langs: list[str], threshold: float = 0.9,
    reverse: bool = False, text: str = "text",
) -> DataFrame:
    """The units the filter keeps, unchanged; batch or stream. One pass over the units, no shuffle."""
    scored = units.withColumn("_s", scorer(model, languages)(F.col(text)))
    return scored.where(passes(F.col("_s.lang"), F.col("_s.score"), langs, threshold, reverse)).drop("_s")
