"""Tokenizer files in the published layout: ``vocab.json`` (token to id) and ``merges.txt`` (one pair per
line, most frequent first), with bytes written as printable stand-in characters."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from corpusmill.functions.bytelevel import ID_TO_BYTE, PRINTABLE, SPECIAL_TOKENS
from corpusmill.operators.bpe_train import Model

# Bytes that print stand for themselves, the others for the characters from 256 on.
BYTE_TO_CHAR = {b: chr(b if i < len(PRINTABLE) else 256 + i - len(PRINTABLE)) for i, b in enumerate(ID_TO_BYTE)}
CHAR_TO_BYTE = {c: b for b, c in BYTE_TO_CHAR.items()}


def _shown(token: bytes, special: bool) -> str:
    return token.decode() if special else "".join(BYTE_TO_CHAR[b] for b in token)


def _bytes_of(token: str) -> bytes:
    return token.encode() if token in SPECIAL_TOKENS else bytes(CHAR_TO_BYTE[c] for c in token)


def write_vocabulary(spark: SparkSession, model: Model, location: str) -> None:
    """Two text tables as small as the vocabulary, one part file each."""
    shown = [_shown(t, i < len(SPECIAL_TOKENS)) for i, t in enumerate(model.tokens)]
    vocab = json.dumps({t: i for i, t in enumerate(shown)}, ensure_ascii=False)
    merges = "\n".join(["#version: 0.2", *(f"{shown[left]} {shown[right]}" for left, right, _ in model.merges)])
    for name, text in (("vocab.json", vocab), ("merges.txt", merges)):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{location}/{name}")


def read_vocabulary(spark: SparkSession, location: str, special: tuple[str, ...] = ()) -> Model:
    """The model of a folder with ``vocab.json`` and ``merges.txt`` (files, or written as above). Ids must
    begin with the special tokens and the byte alphabet in their usual order. ``special`` tokens that the
    vocabulary lacks are added as whole words."""

    def whole(name: str) -> str:
        return spark.read.text(f"{location}/{name}", wholetext=True).first().value

    try:
        vocab, lines = json.loads(whole("vocab.json")), whole("merges.txt").split("\n")
    except Exception as error:
        raise ValueError(f"invalid tokenizer location {location}") from error
    tokens = [_bytes_of(t) for t in sorted(vocab, key=vocab.get)]
    if tokens[: len(SPECIAL_TOKENS) + 256] != [t.encode() for t in SPECIAL_TOKENS] + [bytes([b]) for b in ID_TO_BYTE]:
        raise ValueError("the vocabulary must begin with the special tokens and the byte alphabet")
    pairs = [line.split(" ") for line in lines if line and not line.startswith("#version")]
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    return Model(merges, tokens, [t for t in special if t not in vocab])
