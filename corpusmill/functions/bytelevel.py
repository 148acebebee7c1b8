"""Byte-level alphabet: how bytes, token ids and the symbols used while training relate.

A word in training is a string with one character per token id, so one merge is a plain ``replace``:
left to right, without overlaps, inside generated code, and a word of any length costs linear time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Special tokens and their ids, and the bytes that stand for themselves in the published
# byte-level alphabet. The other bytes follow these in id order.
SPECIAL_TOKENS = ("[PAD]", "[EOS]")
PRINTABLE_RANGES = ((33, 126), (161, 172), (174, 255))

PRINTABLE = [b for low, high in PRINTABLE_RANGES for b in range(low, high + 1)]
ID_TO_BYTE = PRINTABLE + [b for b in range(256) if b not in set(PRINTABLE)]
BYTE_TO_ID = {b: i + len(SPECIAL_TOKENS) for i, b in enumerate(ID_TO_BYTE)}
FIRST_MERGE_ID = len(SPECIAL_TOKENS) + 256

# Ids become code points from here on, past ASCII (regular expressions) and around the surrogates.
_FIRST_CODE_POINT = 0x100
_SURROGATES, _N_SURROGATES = 0xD800, 0x800


def symbol(token_id: int) -> str:
    code = token_id + _FIRST_CODE_POINT
    return chr(code if code < _SURROGATES else code + _N_SURROGATES)


def symbol_id(char: str) -> int:
    code = ord(char)
    return (code if code < _SURROGATES else code - _N_SURROGATES) - _FIRST_CODE_POINT


def symbols_of(word: Column) -> Column:
    """The UTF-8 bytes of a word as a string of symbols."""
    one_char_per_byte = F.decode(word.cast("binary"), "ISO-8859-1")
    return F.translate(
        one_char_per_byte,
        "".join(chr(b) for b in range(256)),
        "".join(symbol(BYTE_TO_ID[b]) for b in range(256)),
    )


# Java reads a lone second half of a surrogate pair as a character; no match may begin on one.
ANY = r"[^\uDC00-\uDFFF]"


def adjacent_pairs(symbols: Column) -> Column:
    """All neighbouring symbols as two-character strings, overlaps included."""
    return F.regexp_extract_all(symbols, F.lit(f"(?s)(?=({ANY}{ANY}))"), F.lit(1))
