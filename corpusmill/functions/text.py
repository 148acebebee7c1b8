"""Column expressions on text: unit splitting, cleaning, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters after which a line ends ("\r\n" counts as one end).
LINE_ENDS = r"\n\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
_AFTER_LINE_END = rf"(?<=[{LINE_ENDS}]|\r(?!\n))"

# Fixed value: the published pre-tokenisation pattern of byte-level BPE. (?U) gives the Unicode
# meaning of \s that the pattern was written for.
PRETOKEN_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Fixed value: the characters that stripping removes at both ends.
WHITE_SPACE = "".join(
    map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def trigrams_of(text: Column) -> Column:
    """All character trigrams, overlaps included, in linear time; shorter texts give none."""
    return F.regexp_extract_all(text, F.lit(r"(?s)(?=([^\uDC00-\uDFFF]..))"), F.lit(1))


def lines_of(text: Column) -> Column:
    """Lines with their terminators kept; no empty piece after a final terminator."""
    return F.filter(F.split(text, _AFTER_LINE_END, -1), lambda line: line != F.lit(""))


def passages_of(text: Column) -> Column:
    """Pieces between full stops; the stop is dropped, empty pieces are kept."""
    return F.split(text, r"\.", -1)


def collapse_non_ascii(text: Column) -> Column:
    """Each maximal run of non-ASCII characters becomes one space."""
    return F.regexp_replace(text, r"[^\x00-\x7F]+", " ")


def words_of(text: Column) -> Column:
    """Pre-tokens in order; concatenated they give the text back."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), F.lit(0))


def with_prefix_space(text: Column) -> Column:
    """The text with one space in front unless it is empty or already starts with one."""
    return F.when(lacks_prefix_space(text), F.concat(F.lit(" "), text)).otherwise(text)


def lacks_prefix_space(text: Column) -> Column:
    return (text != F.lit("")) & ~text.startswith(" ")


def content_hash(content: Column) -> Column:
    """32-byte key for grouping equal content (half the shuffle bytes of its hex form)."""
    return F.unhex(F.sha2(content, 256))


def fingerprint64(content: Column) -> Column:
    """Unsigned 64-bit example id: the first 16 hex digits of the SHA-256 digest."""
    head = F.substring(F.sha2(content, 256), 1, 16)
    return F.conv(head, 16, 10).cast("decimal(20,0)")


def has_txt_extension(path: Column) -> Column:
    return path.rlike(r"\.txt$")


def slices(text: Column, starts: Column, ends: Column) -> Column:
    """``text[start:end]`` for every pair of character offsets."""
    return F.zip_with(
        starts, ends, lambda s, e: F.substring(text, (s + 1).cast("int"), (e - s).cast("int"))
    )
