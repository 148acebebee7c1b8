"""Text repair and ASCII clean-up."""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusmill.functions.text import collapse_non_ascii, has_txt_extension

# Curly quotes, line breaks, invisible control characters, terminal escapes.
CURLY_SINGLE = "ʼ‘’‚‛"
CURLY_DOUBLE = "“”„‟"
NEWLINES = r"\r\n|\r"
OTHER_BREAKS = r"[\u2028\u2029\x85]"
CONTROLS = r"[\x00-\x08\x0b\x0e-\x1f\x7f\u206a-\u206f\ufeff\ufff9-\ufffc]"
TERMINAL_ESCAPES = r"\x1b\[[0-9;]*[a-zA-Z]"
_ENTITY = re.compile(r"&#?[0-9A-Za-z]{1,24};")


@F.arrow_udf(StringType())
def _entities_and_nfkc(texts: pa.Array) -> pa.Array:
    """The two steps Spark has no expression for; plain ASCII without entities passes untouched."""
    return pa.array(
        [t if t is None or (t.isascii() and "&" not in t) else _repair(t) for t in texts.to_pylist()],
        pa.string(),
    )


@F.arrow_udf(StringType())
def nfkc(texts: pa.Array) -> pa.Array:
    """Unicode normalisation form KC."""
    return pa.array(
        [t if t is None or t.isascii() else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()],
        pa.string(),
    )


def _repair(text: str) -> str:
    lines = [
        line if "<" in line else _ENTITY.sub(lambda m: html.unescape(m.group()), line)
        for line in text.split("\n")
    ]
    return unicodedata.normalize("NFKC", "\n".join(lines))


def repair_text(text: Column) -> Column:
    """Unescaped, straight-quoted, line-break and control-character cleaned, NFKC-normalised text.

    The reordering of wrongly decoded bytes is not part of it (see README)."""
    quotes = CURLY_SINGLE + CURLY_DOUBLE
    straight = "'" * len(CURLY_SINGLE) + '"' * len(CURLY_DOUBLE)
    t = F.regexp_replace(F.regexp_replace(text, NEWLINES, "\n"), TERMINAL_ESCAPES, "")
    t = F.translate(_entities_and_nfkc(t), quotes, straight)
    t = F.regexp_replace(t, OTHER_BREAKS, "\n")
    return F.regexp_replace(t, CONTROLS, "")


def clean_text(text: Column) -> Column:
    return collapse_non_ascii(repair_text(text))


def clean_files(files: DataFrame, content: str = "text") -> DataFrame:
    """Cleaned content of the ``.txt`` files; the others are left out (and counted by the totals)."""
    return files.where(has_txt_extension(F.col("path"))).withColumn(content, clean_text(F.col(content)))


def clean_totals(files: DataFrame) -> DataFrame:
    """Files that can be cleaned, of all files listed."""
    return files.agg(
        F.count_if(has_txt_extension(F.col("path"))).alias("good_files"),
        F.count(F.lit(1)).alias("total_files"),
    )


def relative_paths(files: DataFrame) -> DataFrame:
    """Paths that break the absolute-path rule; must be empty."""
    return files.where(~F.col("path").startswith("/"))


def require_absolute_paths(files: DataFrame) -> DataFrame:
    """Passes the files on, failing the job at the first relative path."""
    message = F.concat(F.lit("file paths must be absolute: "), F.col("path"))
    return files.withColumn(
        "path",
        F.when(F.col("path").startswith("/"), F.col("path")).otherwise(
            F.raise_error(message).cast("string")
        ),
    )
