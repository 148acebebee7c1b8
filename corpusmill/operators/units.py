"""Documents to text units: whole file, passages or lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import lines_of, passages_of

# File extensions each strategy reads.
PLAIN = (".csv", ".tsv", ".txt")
GZIPPED = (".gz", ".gzip")
SUPPORTED = {"file": PLAIN + GZIPPED, "passage": PLAIN, "line": PLAIN + GZIPPED}


def check_supported(by: str, extensions: list[str]) -> None:
    bad = [ext for ext in extensions if ext not in SUPPORTED.get(by, ())]
    if by not in SUPPORTED or bad:
        pairs = ", ".join(f"{s}:{e}" for s, exts in SUPPORTED.items() for e in exts)
        raise ValueError(f"nothing reads {', '.join(bad) or 'texts'} by {by}; what can be read is {pairs}")


def pieces(text: Column, by: str) -> Column:
    """The units of one text as an array column."""
    check_supported(by, [])
    return {"file": F.array, "passage": passages_of, "line": lines_of}[by](text)


def split_units(docs: DataFrame, by: str, text: str = "text") -> DataFrame:
    """One row per unit, numbered from 0 within its document; a map-only step."""
    keep = [c for c in docs.columns if c != text]
    return docs.select(*keep, F.posexplode(pieces(F.col(text), by)).alias("unit_no", text))
