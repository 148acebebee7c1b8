"""Column expressions on numbers: number format, vocabulary rounding, seeded keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType

# Fixed value: vocabulary sizes are rounded up to a multiple of this.
VOCAB_MULTIPLE = 128


def human_number(value: Column, dtype: DataType, digits: int = 2) -> Column:
    """Thousands separators; integers without decimals, other numbers with ``digits``."""
    whole = isinstance(dtype, (ByteType, ShortType, IntegerType, LongType))
    return F.format_number(value, 0 if whole else digits)


def round_vocab(n: Column) -> Column:
    return n + F.pmod(-n, F.lit(VOCAB_MULTIPLE))


def seeded_key(seed: int, *parts: Column | str) -> Column:
    """Reproducible random sort key: MD5 of the seed and the parts."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[_text(p) for p in parts]))


def seeded_int(seed: int, *parts: Column | str) -> Column:
    """Reproducible random integer in [0, 2**32): the first 8 hex digits of the seeded key."""
    return F.conv(F.substring(seeded_key(seed, *parts), 1, 8), 16, 10).cast("bigint")


def seeded_draw(seed: int, *parts: Column | str) -> Column:
    """Reproducible random integer in [0, 2**60), for draws from more than a few rows: 15 hex digits of the seeded key."""
    return F.conv(F.substring(seeded_key(seed, *parts), 1, 15), 16, 10).cast("bigint")


def _text(part: Column | str) -> Column:
    return F.lit(part) if isinstance(part, str) else part.cast("string")
