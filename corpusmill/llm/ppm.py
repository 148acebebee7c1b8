"""Language-model scores by prediction by partial matching.

The model is a trie of byte contexts with the counts of the bytes that follow. A byte is coded in the longest
context of the trie that ends before it. With T occurrences of the context and D different bytes seen behind
it, an unseen byte is announced by an escape of probability D / (T + D) and coded in the next shorter context, where the bytes
that the longer one had seen are excluded from T and D. Below the empty context all 256 symbols not yet
excluded are equally likely. Symbol 255, which UTF-8 never has, ends a text and stands before its beginning.

Training counts the (order + 1)-grams of every training text: tasks send one row per distinct gram, Spark adds
them up. The trie has every context of the training texts, also those that occur once. It stays in the shared folder, as sorted
files of grams and counts for each length, which tasks map into memory and search: only the list of files is sent, and the model may be
larger than any memory. What a byte costs depends on it and the ``order`` bytes before it, so a task looks the different grams of
a slice of its texts up, in order, and the few that the training lacks once more with each shorter context.

The base score is a unigram model of words. Words that hold at least 1 / ``WORD_SHARE`` of the training tokens
are sent to the tasks (at most WORD_SHARE of them), all others are joined by shuffle, so the vocabulary may
have any size.

Adaptive scores code a document with a trie that starts empty and learns from the document itself.

Defined cases: a null text is empty, which is its end alone; rows with one id are scored each on their own as long as
they are in the table given (see ``scored``); an empty table gives an empty result, a table without training rows an
untrained model (all symbols equally likely); other columns are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.words import rows_of, stored
from corpusmill.session import scratch_path
from corpusmill.sources.filesystem import filesystem_of

ORDER = 6
# A context belongs to the trie if it holds at least this part of the training bytes: each one does.
SHARE = 1 << 62
WORD_SHARE = 1 << 18
END = 255
SYMBOLS = 256
# Bytes that a task works on at a time, and grams that it looks up with shorter contexts at a time.
_SLICE, _UNSEEN = 2 << 20, 1 << 15
# Grams of a file of counts, and files of an unmapped file system that a task holds.
GRAMS_PER_FILE, HELD_FILES = 1_000_000, 32


def streams(texts: Iterator[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(symbols, starts) of slices of texts: each text stands behind ``order`` end symbols and is followed
    by one. ``starts`` are the positions of the texts. A slice holds at least one text."""
    pad = bytes([END]) * order
    parts, starts, at = [], [], 0
    for text in texts:
        starts.append(at + order)
        parts += [pad, text, pad[:1]]
        at += order + len(text) + 1
        if at >= _SLICE:
            yield np.frombuffer(b"".join(parts), np.uint8), np.array(starts)
            parts, starts, at = [], [], 0
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), np.array(starts)


def _coded(stream: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """Which positions are coded: all but the end symbols before each text."""
    flags = np.ones(len(stream), bool)
    flags[(starts[:, None] - 1 - np.arange(order)).reshape(-1)] = False
    return flags


def grams(stream: np.ndarray, starts: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """Keys of the (order + 1)-grams that end at coded positions, by pieces of a slice."""
    flags = _coded(stream, starts, order)
    for at in range(order, len(stream), _SLICE):
        end = min(len(stream), at + _SLICE)
        key = np.zeros(end - at, np.int64)
        for back in range(order, -1, -1):
            key = (key << 8) | stream[at - back : end - back]
        yield key[flags[at:end]]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column("text").cast(pa.binary()):
        yield (value.as_py() or b"").lower()


def corpus_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, word, n): counts of byte grams (word null) and words (gram null; the empty word ends a text)."""
    schema = pa.schema([("gram", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        keys, counts, held = [], [], 0

        def word_rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(words), pa.int64()), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())],
                schema=schema,
            )

        for batch in batches:
            texts = list(_texts(batch))
            words[b""] += len(texts)
            for text in texts:
                words.update(text.split())
                if len(words) > 500_000:
                    yield word_rows()
                    words.clear()
            for stream, starts in streams(iter(texts), order):
                for key in grams(stream, starts, order):
                    key.sort()
                    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
                    keys.append(key[first])
                    counts.append(np.diff(first, append=len(key)))
                    held += len(first)
                    if held > 3_000_000:
                        key, n = _added(keys, counts)
                        keys, counts, held = [key], [n], len(key)
                        if held > 1_500_000:
                            yield pa.RecordBatch.from_arrays([pa.array(key), pa.nulls(held, pa.binary()), pa.array(n)], schema=schema)
                            keys, counts, held = [], [], 0
        if words:
            yield word_rows()
        if keys:
            key, n = _added(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.nulls(len(key), pa.binary()), pa.array(n)], schema=schema)

    counted = rows.select("text").mapInArrow(count, "gram long, word binary, n long")
    return counted.groupBy("gram", "word").agg(F.sum("n").alias("n"))


def trie_edges(counts: DataFrame, order: int = ORDER, share: int = SHARE) -> DataFrame:
    """(length, context, symbol, n): the bytes seen behind every context, or with a lower ``share`` behind every one that holds
    1 / ``share`` of the training bytes.

    ``context`` packs its bytes, the last one lowest."""
    columns = ["length", "context", "symbol", "n"]

    def shorter(edges: DataFrame, lengths: Column) -> DataFrame:
        """Edges of the shorter contexts."""
        each = edges.select(F.explode(lengths).alias("length"), "context", "symbol", "n")
        cut = each.withColumn("context", F.expr("context & (shiftleft(1L, 8 * length) - 1)"))
        return cut.groupBy(*columns[:3]).agg(F.sum("n").alias("n"))

    grams = counts.where("gram IS NOT NULL")
    longest = grams.select(F.lit(order).alias("length"), F.expr("shiftright(gram, 8)").alias("context"), F.expr("gram & 255L").alias("symbol"), "n")
    edges = longest
    if order:
        # Each length is summed from a longer one, which has fewer rows than there are grams.
        second = shorter(longest, F.array(F.lit(order - 1)))
        edges = edges.unionByName(second)
        if order > 1:
            edges = edges.unionByName(shorter(second, F.sequence(F.lit(0), F.lit(order - 2))))
    edges = stored(edges, "trie-edges")
    total = edges.where("length = 0").agg(F.sum("n")).first()[0] or 0
    if share >= total:
        return edges
    frequent = edges.groupBy("length", "context").agg(F.sum("n").alias("_t")).where(F.col("_t") * share >= total)
    # At most SHARE contexts of each length.
    return edges.join(F.broadcast(frequent.drop("_t")), ["length", "context"])


class Trie:
    """Code lengths and transitions of a small trie as tables over (context, class of the byte)."""

    def __init__(self, edges: pa.Table, order: int = ORDER):
        length, context, symbol, n = (edges[c].to_numpy().astype(np.int64) for c in ("length", "context", "symbol", "n"))
        seen = np.unique(symbol)
        # Bytes that the training never saw share the last class.
        self.classes = np.full(256, len(seen), np.int64)
        self.classes[seen] = np.arange(len(seen))
        self.order, width = order, len(seen) + 1
        ids: dict[tuple[int, int], int] = {(0, 0): 0}
        for key in sorted(set(zip(length.tolist(), context.tolist()))):
            ids.setdefault(key, len(ids))
        counts = np.zeros((len(ids), width), np.float64)
        rows = np.array([ids[k] for k in zip(length.tolist(), context.tolist())], np.int64)
        counts[rows, self.classes[symbol]] = n
        total, kinds = counts.sum(1), (counts > 0).sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            # _below[s]: probability of a symbol after an escape from s.
            below = np.full((len(ids), width), 1.0 / max(1, SYMBOLS - len(seen)), np.float32)
            cost = np.zeros((len(ids), width), np.float32)
            nxt = np.zeros((len(ids), width), np.int32)
            for (size, packed), s in ids.items():
                if size:
                    u = ids[size - 1, packed & ((1 << 8 * (size - 1)) - 1)]
                    known = counts[s] > 0
                    left = total[u] - counts[u][known].sum()
                    new = kinds[u] - kinds[s]
                    if new > 0:
                        below[s] = np.where(counts[u] > 0, counts[u], new * below[u]) / (left + new)
                    else:
                        below[s] = below[u]
                    nxt[s] = nxt[u]
                if total[s]:
                    p = np.where(counts[s] > 0, counts[s], kinds[s] * below[s].astype(np.float64)) / (total[s] + kinds[s])
                    cost[s] = np.log10(p)
                else:
                    cost[s] = -np.log10(SYMBOLS)
                if size < order:
                    for symbol_ in seen[counts[s, :-1] > 0].tolist():
                        to = ids.get((size + 1, packed << 8 | symbol_))
                        if to is not None:
                            nxt[s, self.classes[symbol_]] = to
            self.cost, self.next = cost, nxt


def write_counts(edges: DataFrame, order: int = ORDER) -> GramCounts:
    """Writes the edges of a trie. A repeated task writes files of other names; only those of the rows that count are read."""
    folder = scratch_path(edges.sparkSession, "trie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = filesystem_of(folder)
        filesystem.create_dir(inner)
        held, files = None, []
        for batch in batches:
            length, context, symbol, n, space = (batch.column(c).to_numpy() for c in ("length", "context", "symbol", "n", "space"))
            cuts = [0, *(np.flatnonzero(np.diff(length)) + 1).tolist(), len(length)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held != length[a]:
                    for file in files[-1][4:] if files else ():
                        file.close()
                    held, name = length[a], f"{inner}/{uuid.uuid4().hex}"
                    out = [filesystem.open_output_stream(f"{name}.{kind}") for kind in ("grams", "sums", "costs")]
                    files.append([int(held), int(context[a]), 0, f"{folder}/{name.rpartition('/')[2]}", *out])
                    out[1].write(np.zeros(1, "<i8").tobytes())
                    total = 0
                sums = total + np.cumsum(n[a:b])
                total = int(sums[-1])
                out[0].write((context[a:b] << 8 | symbol[a:b]).astype("<i8").tobytes())
                out[1].write(sums.astype("<i8").tobytes())
                out[2].write(np.log10(n[a:b] / space[a:b]).astype("<f8").tobytes())
                files[-1][2] += b - a
        if files:
            for file in files[-1][4:]:
                file.close()
            columns = list(zip(*files))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3])], names=names)

    names = ["length", "first", "rows", "path"]
    n = 1 + edges.count() // GRAMS_PER_FILE
    # The bytes behind one context are in one file.
    dealt = edges.repartitionByRange(n, "length", "context").sortWithinPartitions("length", "context", "symbol")
    behind = Window.partitionBy("length", "context")
    dealt = dealt.withColumn("space", F.sum("n").over(behind) + F.count(F.lit(1)).over(behind))
    files = sorted(tuple(r) for r in dealt.mapInArrow(write, "length long, first long, rows long, path string").collect())
    return GramCounts([[f[1:] for f in files if f[0] == length] for length in range(order + 1)])


@dataclass
class GramCounts:
    """``files`` (first context, rows, path) in order, for each length of a context."""

    files: list[list[tuple[int, int, str]]]
    held: dict = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"held": {}}

    def _file(self, length: int, i: int) -> tuple[np.ndarray, ...]:
        """The grams of a file, the sums of their counts, before the first one, behind the first one, and so on, and what each costs
        in its longest context."""
        if (length, i) not in self.held:
            _, rows, path = self.files[length][i]
            filesystem, inner = filesystem_of(path)
            shapes = {"grams": ("<i8", rows), "sums": ("<i8", rows + 1), "costs": ("<f8", rows)}
            if isinstance(filesystem, fs.LocalFileSystem):
                arrays = [np.memmap(f"{inner}.{kind}", dtype, "r", shape=n) for kind, (dtype, n) in shapes.items()]
                arrays = [np.asarray(x) for x in arrays]
            else:
                if len(self.held) >= HELD_FILES:
                    self.held.pop(next(iter(self.held)))
                arrays = []
                for kind, (dtype, _) in shapes.items():
                    with filesystem.open_input_file(f"{inner}.{kind}") as file:
                        arrays.append(np.frombuffer(file.read(), dtype))
            self.held[length, i] = tuple(arrays)
        return self.held[length, i]

    def _by_file(self, length: int, contexts: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """The places of sorted contexts that a file may hold, and the file."""
        bounds = np.searchsorted(contexts, np.array([f[0] for f in self.files[length]], np.int64)).tolist()
        for i, (a, b) in enumerate(zip(bounds, [*bounds[1:], len(contexts)])):
            if a < b:
                yield slice(a, b), *self._file(length, i)

    def counts(self, length: int, grams: np.ndarray) -> np.ndarray:
        """How often sorted grams occur."""
        out = np.zeros(len(grams), np.int64)
        for part, known, sums, _ in self._by_file(length, grams >> 8):
            at = np.minimum(np.searchsorted(known, grams[part]), len(known) - 1)
            out[part] = np.where(known[at] == grams[part], sums[at + 1] - sums[at], 0)
        return out

    def contexts(self, length: int, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often sorted contexts occur, and how many different bytes stand behind each."""
        out = np.zeros((2, len(contexts)), np.int64)
        for part, known, sums, _ in self._by_file(length, contexts):
            low, high = (np.searchsorted(known, (contexts[part] + i) << 8) for i in (0, 1))
            out[0, part], out[1, part] = sums[high] - sums[low], high - low
        return out[0], out[1]

    def excluded(self, length: int, contexts: np.ndarray) -> np.ndarray:
        """Of sorted contexts: how often the bytes that stand behind one occur behind the context that is a byte shorter."""
        out = np.zeros(len(contexts), np.int64)
        for part, known, _, _ in self._by_file(length, contexts):
            low, high = (np.searchsorted(known, (contexts[part] + i) << 8) for i in (0, 1))
            n = high - low
            owner = np.repeat(np.arange(len(n)), n)
            symbols = known[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(len(owner))] & 255
            shorter = contexts[part] & ((1 << 8 * (length - 1)) - 1)
            wanted, number = np.unique(shorter[owner] << 8 | symbols, return_inverse=True)
            out[part] = np.bincount(owner, self.counts(length - 1, wanted)[number], len(n)).astype(np.int64)
        return out

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of sorted grams of the longest length."""
        out = np.ones(len(grams))
        for part, known, _, costs in self._by_file(len(self.files) - 1, grams >> 8):
            at = np.minimum(np.searchsorted(known, grams[part]), len(known) - 1)
            out[part] = np.where(known[at] == grams[part], costs[at], 1.0)
        unseen = np.flatnonzero(out > 0)
        for a in range(0, len(unseen), _UNSEEN):
            some = unseen[a : a + _UNSEEN]
            out[some] = self._escaped(grams[some])
        return out

    def _escaped(self, grams: np.ndarray) -> np.ndarray:
        """The same, context by context."""
        order = len(self.files) - 1
        out = np.zeros(len(grams))
        # Whether a longer context has been seen, how many bytes stand behind it, and how often these do behind the present one.
        open_, entered = np.arange(len(grams)), np.zeros(len(grams), bool)
        left_out, longer_kinds = (np.zeros(len(grams), np.int64) for _ in range(2))
        for length in range(order, -1, -1):
            if not len(open_):
                return out
            wanted, number = np.unique(grams[open_] & ((1 << 8 * (length + 1)) - 1), return_inverse=True)
            n = self.counts(length, wanted)[number]
            contexts, of_gram = _runs(wanted >> 8)
            total, kinds = (x[of_gram][number] for x in self.contexts(length, contexts))
            new = kinds - longer_kinds
            space = total - left_out + np.where(entered, new, kinds)
            said = np.where(n > 0, n, np.where(entered, new, kinds))
            # Nothing is said where the context has not been seen, or no byte that the longer one lacks.
            some = space > 0
            out[open_[some]] += np.log10(said[some] / space[some])
            if length:
                left_out = self.excluded(length, contexts)[of_gram][number]
            going = n == 0
            entered = (entered | (total > 0))[going]
            open_, left_out, longer_kinds = open_[going], left_out[going], kinds[going]
        # ``longer_kinds`` are all bytes that the training has.
        out[open_] -= np.log10(SYMBOLS - longer_kinds)
        return out


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of sorted values, and the number of each value's."""
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return values[first], np.cumsum(first) - 1


def slice_scores(model: GramCounts, stream: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """log10 probability of every text of a slice."""
    order = len(model.files) - 1
    # What is coded of a text follows what is coded of the one before.
    lengths = np.diff(starts, append=len(stream) + order) - order
    owner = np.repeat(np.arange(len(starts), dtype=np.int32), lengths)
    out, at = np.zeros(len(starts)), 0
    for key in grams(stream, starts, order):
        by_gram = np.argsort(key)
        different, number = _runs(key[by_gram])
        out += np.bincount(owner[at : at + len(key)][by_gram], model.costs(different)[number], len(starts))
        at += len(key)
    return out


def held_out(id: Column) -> Column:
    """Whether a document takes no part in training."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")), F.lit(0)) % 5 == 1


def scored(docs: DataFrame, id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows are told apart by id and text; equal rows give one result each with equal values."""
    rows = rows_of(docs, id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    counts = stored(corpus_counts(rows.where("NOT held_out"), order), "corpus-counts")
    tokens = counts.where("word IS NOT NULL").select("word", "n")
    totals = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_train, n_words = int(totals[0]), int(totals[1])
    base = np.log10(n_train + 0.5 * (n_words + 1))
    # At most WORD_SHARE words.
    frequent = tokens.where(F.col("n") * WORD_SHARE >= n_train).toArrow()
    common = {word: i for i, word in enumerate(frequent["word"].to_pylist())}
    common_logs = np.log10(frequent["n"].to_numpy().astype(np.float64) + 0.5)
    model = write_counts(trie_edges(counts, order), order)
    sent = rows.sparkSession.sparkContext.broadcast((common, common_logs, model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, logs, model = sent.value
        find = common.get
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"]
        for batch in batches:
            at = 0
            for stream, starts in streams(_texts(batch), order):
                ends = np.append(starts[1:] - order - 1, len(stream) - 1)
                raw = stream.tobytes()
                totals, known, sums, rares = [], [], [], []
                for start, end in zip(starts.tolist(), ends.tolist()):
                    words = raw[start:end].split()
                    found = [find(w, -1) for w in words]
                    ids = np.array([*found, find(b"", -1)], np.int64)
                    rare = [w for w, i in zip(words, found) if i < 0] if -1 in found else []
                    if ids[-1] < 0:
                        rare.append(b"")
                    ids = ids[ids >= 0]
                    totals.append(len(words) + 1)
                    known.append(len(ids))
                    sums.append(float(logs[ids].sum()))
                    rares.append(rare)
                part = batch.slice(at, len(starts))
                at += len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(totals, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(sums, pa.float64()),
                        pa.array(slice_scores(model, stream, starts)),
                        pa.array(rares, pa.list_(pa.binary())),
                    ],
                    names=names,
                )

    parts = rows.select("doc_id", "held_out", "text").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<binary>"
    )
    # Written once: both the rare words and the rows they belong to are read from it.
    parts = stored(parts.withColumn("row", F.monotonically_increasing_id()), "scored-parts")
    rare = parts.select("row", F.explode("rare").alias("word")).join(tokens, "word", "left")
    rare = rare.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("_base"), F.count("n").alias("_known")
    )
    return parts.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(base))).alias("base_score"),
        "score",
    )


def adaptive_score(text: bytes, order: int = ORDER) -> float:
    """log10 probability of a text and its end, coded with a trie that learns from it symbol by symbol."""
    trie: dict[bytes, Counter] = {}
    history, total = bytes([END]) * order, 0.0
    for symbol in [*text.lower(), END]:
        excluded: set[int] = set()
        contexts = [history[len(history) - k :] for k in range(order, -1, -1)]
        for context in contexts:
            seen = {s: n for s, n in trie.get(context, {}).items() if s not in excluded}
            if not seen:
                continue
            space = sum(seen.values()) + len(seen)
            if symbol in seen:
                total += np.log10(seen[symbol] / space)
                break
            total += np.log10(len(seen) / space)
            excluded |= seen.keys()
        else:
            total -= np.log10(SYMBOLS - len(excluded))
        for context in contexts:
            trie.setdefault(context, Counter())[symbol] += 1
        history = (history + bytes([symbol]))[1:]
    return float(total)


def adaptive_scores(docs: DataFrame, order: int = ORDER, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score): every text coded on its own; memory grows with the longest text."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [adaptive_score(t, order) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"])

    rows = rows_of(docs, id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(score, "doc_id long, score double")


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents`` by a model of four fifths of them."""
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"))

