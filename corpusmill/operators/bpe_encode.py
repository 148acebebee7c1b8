"""Byte-level BPE encoding and decoding.

Encoding is a map-only step: a corpus has orders of magnitude more word occurrences than a shuffle should
carry, while the model is no larger than the vocabulary and travels with the tasks. Spark cuts the text
into words; a task replays the merges once per distinct word of a piece of a batch and spreads the result over the
occurrences with array arithmetic. Ids take many times the room of the texts, so a task works on pieces of ``_PIECE_BYTES`` and
gives their rows away one piece at a time.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from corpusmill.functions.bytelevel import BYTE_TO_ID
from corpusmill.functions.text import fingerprint64, lacks_prefix_space, with_prefix_space, words_of
from corpusmill.operators.bpe_train import Model
from corpusmill.operators.clean import nfkc
from corpusmill.operators.lexicon import Lexicon, cut_at_words

_IDS = ArrayType(LongType())
_SPANS = StructType([StructField(n, _IDS) for n in ("target", "offset_start", "offset_end")])
_CUT = StructType([StructField("stretches", ArrayType(StringType())), StructField("words", _IDS)])
# Words that a task remembers, of some 700 bytes each, and their greatest length.
_MEMO_WORDS, _MEMO_LENGTH = 100_000, 64
# Bytes of text that a task works on at a time.
_PIECE_BYTES = 1 << 20


def encode(texts: DataFrame, model: Model, text: str = "text", ids: str = "target", normalize: bool = True) -> DataFrame:
    """Adds the token ids of ``text``; a null text has none. Pass ``normalize=False`` for ASCII text."""
    column = nfkc(F.col(text)) if normalize else F.col(text)
    cut = texts.withColumn("_cut", _cut(column, model, normalize)).withColumn("_pretokens", _pretokens("_cut.stretches"))
    lists = _id_lists(model)

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        return [lists(piece.column("_pretokens"), piece.column("_words"))]

    encoded = _in_pieces(cut.withColumn("_words", F.col("_cut.words")).drop("_cut"), ["_pretokens", "_words"], [ids], work)
    return encoded.select(*texts.columns, *([] if ids in texts.columns else [ids]))


def encode_with_offsets(units: DataFrame, model: Model, text: str = "text", normalize: bool = True) -> DataFrame:
    """Adds ``id`` (fingerprint of the unit), ``target`` (token ids) and ``offset_start`` and
    ``offset_end``: the characters of the original unit that each token covers, without the leading
    spaces. A token that is only a space covers nothing. Text after an added token gets a prefix space of its own, which counts
    as the first character after the token, and is left out like any other."""
    column = nfkc(F.col(text)) if normalize else F.col(text)
    cut = units.withColumn("_cut", _cut(column, model, normalize)).withColumn("_pretokens", _pretokens("_cut.stretches"))
    prefixed = F.transform("_cut.stretches", lacks_prefix_space)
    read = {"_words": F.col("_cut.words"), "_prefixed": prefixed, "_raw": F.coalesce(F.col(text), F.lit(""))}
    cut = cut.withColumns(read).withColumn("id", fingerprint64(F.col(text))).drop("_cut")
    spans = _span_lists(model, normalize)
    names = ["_pretokens", *read]

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        return spans(*map(piece.column, names)).flatten()

    return _in_pieces(cut, names, _SPANS.names, work)


def decode(examples: DataFrame, vocab: DataFrame, ids: str = "target", text: str = "decoded") -> DataFrame:
    """Adds the text of ``ids``. The vocabulary enters as one array value (its size is bounded by the
    vocabulary size), so each id is an array access and nothing is shuffled. An id without a token is an error."""
    tokens = vocab.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("id", F.hex("token").alias("token")))), lambda v: v["token"]
        ).alias("tokens")
    ).scalar()


    def token(i: Column) -> Column:
        unknown = F.raise_error(F.concat(F.lit("no token has the id "), i.cast("string")))
        return F.coalesce(F.get("_tokens", i.cast("int")), unknown.cast("string"))

    bytes_hex = F.array_join(F.transform(ids, token), "")
    return (
        examples.withColumn("_tokens", tokens)
        .withColumn(text, F.make_valid_utf8(F.unhex(bytes_hex).cast("string")))
        .drop("_tokens")
    )


@F.arrow_udf(ArrayType(StringType()))
def _slices(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    rows = zip(texts.to_pylist(), starts.to_pylist(), ends.to_pylist())
    return pa.array([None if t is None else [t[a:b] for a, b in zip(s, e)] for t, s, e in rows], pa.list_(pa.string()))


def token_slices(examples: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``slices``: what each token of ``offset_start`` and ``offset_end`` covers of the text. A cut by characters
    begins at the text's start, so a text is handed to a task as one string and cut there."""
    return examples.withColumn("slices", _slices(F.col(text), F.col("offset_start"), F.col("offset_end")))


def expected_decoding(text: Column, normalize: bool = True) -> Column:
    """What decoding an encoded text gives: the normalised text with the prefix space."""
    return with_prefix_space(nfkc(text) if normalize else text)


def roundtrip_mismatches(examples: DataFrame, vocab: DataFrame, text: str = "text", normalize: bool = True) -> DataFrame:
    """How many examples there are and how many do not decode to their text."""
    decoded = decode(examples, vocab)
    return decoded.agg(
        F.count(F.lit(1)).alias("examples"),
        F.count_if(F.col("decoded") != expected_decoding(F.col(text), normalize)).alias("mismatches"),
    )


def added_token_coverage(texts: DataFrame, words: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): how often each lexicon word occurs as a whole pre-token, with or without the space in
    front. The occurrences are pre-aggregated; only distinct words meet the lexicon."""
    found = texts.select(F.explode(words_of(with_prefix_space(F.col(text)))).alias("token"))
    counts = found.groupBy(F.ltrim("token").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return words.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def _cut(text: Column, model: Model, normalize: bool) -> Column:
    """The stretches of a text between added tokens, and the tokens' numbers; without added tokens the whole text is one."""
    text = F.coalesce(text, F.lit(""))
    if not model.added:
        none = F.array().cast(_IDS)
        return F.struct(F.array(text).alias("stretches"), none.alias("words"))
    lexicon = Lexicon(_added_words(model, normalize))

    def cut(texts: pa.Array) -> pa.Array:
        bounds = _piece_bounds(pc.binary_length(texts).to_numpy())
        return pa.concat_arrays([cut_at_words(lexicon, texts.slice(a, b - a).to_pylist()) for a, b in bounds])

    return F.arrow_udf(cut, _CUT)(text)


def _piece_bounds(sizes: np.ndarray) -> list[tuple[int, int]]:
    """The rows of pieces of a batch, of one row at least and otherwise up to ``_PIECE_BYTES``; an empty batch is one piece."""
    ends = np.cumsum(sizes, dtype=np.int64)
    bounds, a = [], 0
    while a < len(ends) or not bounds:
        held = ends[a - 1] if a else 0
        b = max(int(np.searchsorted(ends, held + _PIECE_BYTES, "right")), a + 1)
        bounds.append((a, min(b, len(ends))))
        a = b
    return bounds


def _in_pieces(
    cut: DataFrame, used: list[str], made: list[str], work: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """``cut`` without the columns ``used`` and with the id lists ``made``, which ``work`` gives for a piece of a batch."""
    kept = [c for c in cut.columns if c not in (*used, *made)]
    names = [*kept, *made]
    fields = [f for f in cut.schema.fields if f.name in kept] + [StructField(name, _IDS) for name in made]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pretokens = batch.column("_pretokens")
            stretches = pretokens.flatten()
            ends = np.insert(np.cumsum(pc.binary_length(stretches.flatten()).to_numpy(), dtype=np.int64), 0, 0)
            sizes = np.diff(ends[_offsets(stretches)[_offsets(pretokens)]])
            for a, b in _piece_bounds(sizes):
                piece = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*map(piece.column, kept), *work(piece)], names=names)

    return cut.mapInArrow(run, StructType(fields))


def _added_words(model: Model, normalize: bool) -> list[str]:
    """The added tokens as they stand in texts."""
    return [unicodedata.normalize("NFKC", w) for w in model.added] if normalize else model.added


def _pretokens(stretches: str) -> Column:
    return F.transform(stretches, lambda s: words_of(with_prefix_space(s)))


def _replayer(model: Model):
    """word -> token ids, remembered across the batches of a task.

    The symbols of a word are a linked list, and its mergeable pairs a heap by rank, then place. A merge unlinks one symbol
    and adds at most two pairs, so a word of n bytes takes O(n log n), whatever its length."""
    ranks = {(left, right): rank for rank, (left, right, _) in enumerate(model.merges)}
    merges = model.merges
    byte_ids = [BYTE_TO_ID[b] for b in range(256)]
    rank_of = ranks.get
    memo: dict[str, list[int]] = {}

    def replay(word: str) -> list[int]:
        ids = memo.get(word)
        if ids is not None:
            return ids
        ids = [byte_ids[b] for b in word.encode()]
        heap = [(rank, i) for i, pair in enumerate(zip(ids, ids[1:])) if (rank := rank_of(pair)) is not None]
        if heap:
            heapify(heap)
            n = len(ids)
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            while heap:
                rank, i = heappop(heap)
                left, right, new = merges[rank]
                j = after[i]
                # A pair that an earlier merge took apart; a symbol that is gone is -1.
                if ids[i] != left or j == n or ids[j] != right:
                    continue
                ids[i], ids[j] = new, -1
                after[i] = k = after[j]
                if k < n:
                    before[k] = i
                    if (rank := rank_of((new, ids[k]))) is not None:
                        heappush(heap, (rank, i))
                h = before[i]
                if h >= 0 and (rank := rank_of((ids[h], new))) is not None:
                    heappush(heap, (rank, h))
            ids = [i for i in ids if i >= 0]
        if len(word) <= _MEMO_LENGTH:
            if len(memo) >= _MEMO_WORDS:
                memo.clear()
            memo[word] = ids
        return ids

    return replay


class _Items:
    """The pre-tokens and added tokens of a batch in order, as numbers of distinct ones.

    ``pretokens`` has one list of words per stretch and row; between two stretches of a row stands an added token."""

    def __init__(self, pretokens: pa.Array, added: pa.Array):
        rows = _offsets(pretokens)
        stretches = pretokens.flatten()
        self.first_word = _offsets(stretches)
        distinct = stretches.flatten().dictionary_encode()
        self.words = distinct.dictionary.to_pylist()
        self.added, added_codes = np.unique(added.flatten().to_numpy(), return_inverse=True)
        n_stretches = np.diff(rows)
        self.row = np.repeat(np.arange(len(n_stretches)), n_stretches)
        # Added tokens before the words of a stretch, in the whole batch.
        self.added_before = np.arange(len(self.row)) - self.row
        self.opens = np.zeros(len(self.row), bool)
        self.opens[rows[:-1]] = True
        self.codes = np.empty(int(self.first_word[-1]) + len(added_codes), np.int64)
        in_stretch = np.repeat(np.arange(len(self.row)), np.diff(self.first_word))
        self.codes[np.arange(len(in_stretch)) + self.added_before[in_stretch]] = distinct.indices.to_numpy()
        self.codes[(self.first_word[:-1] + self.added_before - 1)[~self.opens]] = len(self.words) + added_codes
        # Where the items of rows, and of the words of stretches, begin.
        self.row_items = self.first_word[rows] + rows - np.arange(len(rows))
        self.stretch_items = self.first_word[:-1] + self.added_before


def _offsets(lists: pa.Array) -> np.ndarray:
    offsets = lists.offsets.to_numpy()
    return (offsets - offsets[0]).astype(np.int64)


def _spread(lists: list[list[int]], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of the distinct words laid out per occurrence, and how many items each one got."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
    per_occurrence = sizes[codes]
    ends = np.cumsum(per_occurrence)
    first = (np.cumsum(sizes) - sizes)[codes]
    index = np.repeat(first - (ends - per_occurrence), per_occurrence) + np.arange(ends[-1] if len(ends) else 0)
    return flat[index], per_occurrence


def _id_lists(model: Model):
    replay = _replayer(model)
    first_added = len(model.tokens)

    def ids(pretokens: pa.Array, added: pa.Array) -> pa.Array:
        items = _Items(pretokens, added)
        lists = [replay(w) for w in items.words] + [[first_added + i] for i in items.added.tolist()]
        tokens, per_item = _spread(lists, items.codes)
        before = np.insert(np.cumsum(per_item), 0, 0)
        return pa.ListArray.from_arrays(before[items.row_items].astype(np.int32), pa.array(tokens, pa.int64()))

    return ids


def _span_lists(model: Model, normalize: bool):
    added_words = _added_words(model, normalize)
    replay = _replayer(model)
    lengths = [len(t) for t in model.tokens]
    spaces = [len(t) - len(t.lstrip(b" ")) for t in model.tokens]
    spans_memo: dict[str, tuple[list[int], list[int], list[int]]] = {}

    def spans_in_word(word: str) -> tuple[list[int], list[int], list[int]]:
        """Ids, first and last+1 character of each token; leading spaces are left out."""
        known = spans_memo.get(word)
        if known is not None:
            return known
        ids, raw = replay(word), word.encode()
        # Character each byte belongs to: continuation bytes do not start one.
        char = range(len(raw)) if len(raw) == len(word) else list(accumulate((b & 0xC0) != 0x80 for b in raw))
        base = char[0]
        first, last, at = [], [], 0
        for i in ids:
            to = at + lengths[i]
            end = char[to - 1] - base + 1
            first.append(min(char[at] - base + spaces[i], end))
            last.append(end)
            at = to
        if len(word) <= _MEMO_LENGTH:
            if len(spans_memo) >= _MEMO_WORDS:
                spans_memo.clear()
            spans_memo[word] = ids, first, last
        return ids, first, last

    def span_of_added(i: int) -> tuple[list[int], list[int], list[int]]:
        word = added_words[i]
        return [len(model.tokens) + i], [len(word) - len(word.lstrip())], [len(word.rstrip()) or len(word)]

    def spans(pretokens: pa.Array, added: pa.Array, prefixed: pa.Array, texts: pa.Array) -> pa.Array:
        items = _Items(pretokens, added)
        parts = [spans_in_word(w) for w in items.words] + [span_of_added(i) for i in items.added.tolist()]
        ids, per_item = _spread([p[0] for p in parts], items.codes)
        first, _ = _spread([p[1] for p in parts], items.codes)
        last, _ = _spread([p[2] for p in parts], items.codes)
        before = np.insert(np.cumsum(per_item), 0, 0)
        offsets = before[items.row_items].astype(np.int32)

        # A prefix space takes no place in the text: characters are counted without those that were put in before.
        sizes = np.array([len(w) for w in items.words] + [len(added_words[i]) for i in items.added.tolist()], np.int64)
        put_in = prefixed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        size = sizes[items.codes] if len(items.codes) else np.zeros(0, np.int64)
        starts = np.cumsum(size) - size
        space = np.zeros(len(size) + 1, np.int64)
        np.add.at(space, items.stretch_items, put_in)
        starts = starts - np.cumsum(space)[:-1]
        row_start = np.insert(np.cumsum(size), 0, 0)[items.row_items[:-1]]
        spaces_before = np.insert(np.cumsum(put_in), 0, 0)[np.flatnonzero(items.opens)]
        of_row = np.repeat(row_start - spaces_before, np.diff(items.row_items))
        shift = np.repeat(starts - of_row, per_item)
        first, last = np.maximum(first + shift, 0), np.maximum(last + shift, 0)
        # A single space that opens the text stays with its token, like a prefix space would.
        opening = offsets[:-1][(np.diff(offsets) > 0) & (put_in[items.opens] == 0)]
        opening = opening[first[opening] == 1]
        first[opening], last[opening] = 0, np.where(last[opening] == 1, 0, last[opening])
        # Further on, a prefix space stands for the character after it and is left out.
        inner = before[items.stretch_items[(put_in == 1) & ~items.opens]]
        last[inner] = np.maximum(last[inner], first[inner] + 1)
        first[inner] += 1
        for row, text in enumerate(texts.to_pylist()):
            if not text.isascii() and unicodedata.normalize("NFKC", text) != text:
                part = slice(offsets[row], offsets[row + 1])
                at, to = _origins(text)
                empty = first[part] == last[part]
                first[part] = np.where(empty, np.append(at, len(text))[first[part]], at[np.minimum(first[part], len(at) - 1)])
                last[part] = np.where(empty, first[part], to[np.maximum(last[part] - 1, 0)])
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (ids, first, last)]
        return pa.StructArray.from_arrays(lists, names=["target", "offset_start", "offset_end"])

    return spans


def _origins(text: str) -> tuple[np.ndarray, np.ndarray]:
    """For every character of the NFKC form the span of the original characters it comes from.

    A base character and the marks that follow it normalise independently of their surroundings unless
    what follows composes with them, so the text is cut before each character that starts anew. Within
    such a piece characters correspond in order; what is composed counts as its first character, what a
    character expands to counts as that character."""
    at, begin = [], 0
    for i in range(1, len(text) + 1):
        if i < len(text) and (unicodedata.combining(text[i]) or not _stable(text[begin:i], text[i])):
            continue
        n = len(unicodedata.normalize("NFKC", text[begin:i]))
        at += [begin + min(k, i - begin - 1) for k in range(n)]
        begin = i
    return np.array(at, np.int64), np.array(at, np.int64) + 1


def _stable(left: str, right: str) -> bool:
    """Whether the two pieces normalise the same together as apart."""
    norm = unicodedata.normalize
    return norm("NFKC", left + right) == norm("NFKC", left) + norm("NFKC", right)
