"""The weights of a language model as sorted files in the shared folder, looked up by tasks.

The trigrams are cut into ranges. A range is a file of sorted 8-byte keys and one of their weights, row by row. A task maps these files
into memory, so a binary search touches a few pages of them and the model may be larger than any memory; file systems that
cannot be mapped are read in blocks. Trigrams a task has met stay in a small table of its own, which answers most look-ups.

Only the list of files, one for some million trigrams, is sent. It works the same way for a model of any size, in batch and stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import scratch_path
from corpusmill.sources.filesystem import filesystem_of

GRAMS_PER_FILE = 1_000_000
# Trigrams that a task remembers, and files of an unmapped file system that it holds.
REMEMBERED, HELD_FILES = 200_000, 4
_FILES = "first long, rows long, path string"


def gram_keys(grams: list[str]) -> np.ndarray:
    """Numbers of trigrams, in the order of the trigrams."""
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, 3)
    return codes[:, 0] << 42 | codes[:, 1] << 21 | codes[:, 2]


def write_weights(model: DataFrame, n_languages: int) -> SortedWeights:
    """Writes (gram, weights). A repeated task writes files of other names; only those of the rows that count are read."""
    spark = model.sparkSession
    folder = scratch_path(spark, "weights")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = filesystem_of(folder)
        filesystem.create_dir(inner)
        name, first, rows = uuid.uuid4().hex, None, 0
        with filesystem.open_output_stream(f"{inner}/{name}.keys") as keys, filesystem.open_output_stream(f"{inner}/{name}.weights") as weights:
            for batch in batches:
                if batch.num_rows:
                    numbers = gram_keys(batch["gram"].to_pylist())
                    first = int(numbers[0]) if first is None else first
                    rows += len(numbers)
                    keys.write(numbers.astype("<i8").tobytes())
                    weights.write(batch["weights"].flatten().to_numpy().astype("<i8").tobytes())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([rows]), pa.array([f"{folder}/{name}"])], names=["first", "rows", "path"])

    grams = model.where("gram <> ''").select("gram", "weights")
    n = -(-grams.count() // GRAMS_PER_FILE)
    files = []
    if n:
        files = sorted(tuple(r) for r in grams.repartitionByRange(n, "gram").sortWithinPartitions("gram").mapInArrow(write, _FILES).collect())
    unseen = model.where("gram = ''").first().weights
    return SortedWeights(files, list(unseen), n_languages)


@dataclass
class SortedWeights:
    """``files`` (first key, rows, path) in order; ``unseen`` are the weights of any other trigram."""

    files: list[tuple[int, int, str]]
    unseen: list[int]
    n_languages: int
    held: dict = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"held": {}}

    def _file(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.held:
            _, rows, path = self.files[i]
            filesystem, inner = filesystem_of(path)
            shapes = {"keys": (rows,), "weights": (rows, self.n_languages)}
            if isinstance(filesystem, fs.LocalFileSystem):
                arrays = [np.memmap(f"{inner}.{kind}", "<i8", "r", shape=shape) for kind, shape in shapes.items()]
            else:
                if len(self.held) >= HELD_FILES:
                    self.held.pop(next(iter(self.held)))
                arrays = []
                for kind, shape in shapes.items():
                    with filesystem.open_input_file(f"{inner}.{kind}") as file:
                        arrays.append(np.frombuffer(file.read(), "<i8").reshape(shape))
            self.held[i] = tuple(arrays)
        return self.held[i]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The weights of sorted, different keys, one row each."""
        out = np.tile(np.array(self.unseen, np.int64), (len(keys), 1))
        if not self.files or not len(keys):
            return out
        owner = np.searchsorted(np.array([f[0] for f in self.files], np.int64), keys, "right") - 1
        for i in np.unique(owner[owner >= 0]).tolist():
            mine = np.flatnonzero(owner == i)
            known, weights = self._file(i)
            at = np.minimum(np.searchsorted(known, keys[mine]), len(known) - 1)
            found = known[at] == keys[mine]
            out[mine[found]] = weights[at[found]]
        return out


class Remembered:
    """``SortedWeights`` behind a table of the trigrams met so far."""

    def __init__(self, weights: SortedWeights):
        self.weights = weights
        self._forget()

    def _forget(self) -> None:
        self.keys = np.array([np.iinfo(np.int64).max])
        self.rows = np.zeros((1, self.weights.n_languages), np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The weights of keys in any order."""
        wanted, number = np.unique(keys, return_inverse=True)
        new = wanted[self.keys[np.searchsorted(self.keys, wanted)] != wanted]
        if len(new):
            if len(self.keys) + len(new) > REMEMBERED:
                self._forget()
                new = wanted
            all_keys = np.concatenate([self.keys, new])
            order = np.argsort(all_keys, kind="stable")
            self.keys, self.rows = all_keys[order], np.concatenate([self.rows, self.weights.of(new)])[order]
        return self.rows[np.searchsorted(self.keys, wanted)][number]
