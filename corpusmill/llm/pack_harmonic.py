"""Harmonic packing of token sequences.

With capacity C, class k holds pieces of C // k tokens and a bin takes k of them (as many as fit). A document
is cut into pieces of such quotas, the largest first: a remainder of r tokens gives the largest quota up to
r. Every class fills its own bin, in the order of arrival, and every worker has its own bins, so nothing is
shuffled and a worker holds one open bin per class, which is less than 100 bins whatever it reads. When its
input ends, the worker lays the open bins end to end and cuts them into full sequences; the last, partial
one is cut into sequences of a power of two tokens, which need no padding.

Defined cases: a null text is empty and gives its end token alone; rows with the same id are packed each;
an empty table gives no rows; texts longer than the capacity give full sequences first; other columns are
not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.words import rows_of

# Words whose ids a worker keeps.
CACHED_WORDS = 300_000
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def public_encoder(json_path: str, ranks_path: str, pattern: str) -> Callable[[str], bytes]:
    """Text to little-endian 32-bit ids, equal to the ids of the tokenizer file at ``json_path``.

    ``ranks_path`` holds the same vocabulary. Where white space comes in single characters the pieces that
    the tokenizer cuts never reach over a space, so a word with its space always has the same ids, and they are
    kept. Other texts are encoded whole, and those that spell a special token by the tokenizer itself."""
    import tiktoken
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(json_path)
    special = [t.content for t in own.get_added_tokens_decoder().values()]
    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encoded(text: str) -> bytes:
        return np.array(encoding.encode_ordinary(text), "<u4").tobytes()

    class Kept(dict):
        """Ids of words after ``before``; a full one still encodes, but keeps no more."""

        def __init__(self, before: str):
            self.before = before

        def __missing__(self, word: str) -> bytes:
            ids = encoded(self.before + word)
            if len(self) < CACHED_WORDS:
                self[word] = ids
            return ids

    first, after_space = Kept(""), Kept(" ")
    with_space = after_space.__getitem__
    irregular = re.compile(r"\s\s|\A\s|\s\Z").search
    newline = encoded("\n")

    def encode(text: str) -> bytes:
        if any(token in text for token in special):
            return np.array(own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if irregular(text):
            return encoded(text)
        lines = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            lines.append((first[head] if head else b"") + b"".join(map(with_space, rest)))
        return newline.join(lines)

    return encode


class _Worker:
    """The open bins of one worker. ``sequence_id`` counts from the worker's own base."""

    def __init__(self, capacity: int, base: int):
        self.capacity, self.next_id = capacity, base
        self.open: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.done.append((*piece, self.next_id, offset))
            offset += piece[2]
        self.next_id += 1

    def add(self, doc_id: int | None, n_tokens: int, ids: bytes) -> None:
        start = 0
        while start < n_tokens:
            left = n_tokens - start
            quota = self.capacity // -(-self.capacity // left)
            piece = (doc_id, start, quota, n_tokens, ids[4 * start : 4 * (start + quota)])
            pieces = self.open.setdefault(quota, [])
            pieces.append(piece)
            if len(pieces) == self.capacity // quota:
                self._sequence(self.open.pop(quota))
            start += quota

    def finish(self) -> None:
        rest = [p for quota in sorted(self.open, reverse=True) for p in self.open[quota]]
        left = sum(p[2] for p in rest)
        bins, room, current = [], 0, []
        for doc_id, start, length, n_tokens, ids in rest:
            at = 0
            while at < length:
                if room == 0:
                    room = self.capacity if left >= self.capacity else 1 << left.bit_length() - 1
                    current = []
                    bins.append(current)
                n = min(room, length - at)
                current.append((doc_id, start + at, n, n_tokens, ids[4 * at : 4 * (at + n)]))
                at, room, left = at + n, room - n, left - n
        for pieces in bins:
            self._sequence(pieces)
        self.open = {}

    def batch(self, with_ids: bool) -> pa.RecordBatch:
        columns = list(zip(*self.done)) if self.done else [()] * 7
        self.done = []
        doc_id, start, length, n_tokens, ids, sequence_id, offset = columns
        arrays = [doc_id, start, length, [zlib.crc32(x) for x in ids], n_tokens, sequence_id, offset]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(a, pa.int64()) for a in arrays), pa.array(ids if with_ids else [None] * len(ids), pa.binary())],
            names=[c.split()[0] for c in PIECES.split(", ")],
        )


def packed(
    docs: DataFrame,
    make_encoder: Callable[[], Callable[[str], bytes]],
    end_id: int,
    capacity: int = 2048,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids): one row per piece.

    ``ids`` are the little-endian 32-bit ids of the piece, null unless asked for."""
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder()
        worker = _Worker(capacity, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(body.as_py() or "") + end
                worker.add(doc_id, len(ids) // 4, ids)
                if len(worker.done) >= 5000:
                    yield worker.batch(with_ids)
        worker.finish()
        yield worker.batch(with_ids)

    rows = rows_of(docs, id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(pack, PIECES)


def packed_with_public_ids(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """Sequences of 2048 ids of the public byte-level vocabulary; documents end with id 1."""
    import public_tokenizers as public

    paths = public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN
    return packed(docs, lambda: public_encoder(*map(str, paths)), end_id=1, with_ids=with_ids)


def op3_harmonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 2048 tokens."""
    return packed_with_public_ids(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("ids")
