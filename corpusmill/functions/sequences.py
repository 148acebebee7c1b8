"""Column expressions on id sequences: end marks, padding, labels, query encoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reserved ids and the label that the loss ignores.
PAD, EOS, BOS = 0, 1, 2
RESERVED_IDS = 3
IGNORED_LABEL = -100


def append_eos(ids: Column) -> Column:
    return F.concat(ids, F.array(F.lit(EOS).cast("bigint")))


def trim_and_pad(ids: Column, length: int) -> Column:
    """Exactly ``length`` ids: longer sequences are cut, shorter ones padded with PAD."""
    padding = F.array_repeat(F.lit(PAD).cast("bigint"), length)
    return F.slice(F.concat(ids, padding), 1, length)


def add_one(ids: Column) -> Column:
    return F.transform(ids, lambda x: x + 1)


def next_token_labels(ids: Column, ignored: Column | int) -> Column:
    """The sequence shifted by one; the first ``ignored`` labels are masked."""
    n = F.lit(ignored) if isinstance(ignored, int) else ignored
    return F.transform(
        F.slice(ids, F.lit(2), F.size(ids) - 1),
        lambda x, i: F.when(i < n, F.lit(IGNORED_LABEL)).otherwise(x),
    )


def next_token_inputs(ids: Column) -> Column:
    return F.slice(ids, F.lit(1), F.size(ids) - 1)


def encode_query(text: Column, length: int = 8) -> Column:
    """BOS, the space-separated numbers shifted past the reserved ids, EOS, padding to ``length``."""
    shifted = F.transform(F.split(text, " "), lambda v: v.cast("int") + RESERVED_IDS)
    whole = F.concat(
        F.array(F.lit(BOS)), shifted, F.array(F.lit(EOS)), F.array_repeat(F.lit(PAD), length)
    )
    return F.slice(whole, 1, length)


def argmax(scores: Column) -> Column:
    """0-based position of the first largest score."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def decode_answer(scores: Column) -> Column:
    """Best id per position shifted back past the reserved ids; ids that are not positive drop out."""
    best = F.transform(scores, lambda row: argmax(row) - RESERVED_IDS)
    return F.array_join(F.transform(F.filter(best, lambda x: x > 0), lambda x: x.cast("string")), " ")


def has_length(ids: Column, length: int) -> Column:
    return F.size(ids) == F.lit(length)
