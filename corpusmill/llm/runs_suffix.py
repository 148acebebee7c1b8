"""Periodic runs of words by suffix trees: longest common extensions of Lyndon roots in both directions.

A run is a maximal stretch of words with a smallest period q, at least ``LEAST_WORDS`` words and ``LEAST_PERIODS`` * q long.

1. Ukkonen's algorithm builds the suffix trees of a sequence of words and of its reversal. The lowest common ancestor of two leaves,
   in constant time by a range minimum over the Euler tour, gives how far two suffixes, or two prefixes, agree.
2. The tour of the first tree is also the order of the suffixes. The longest Lyndon word at a place ends before the next smaller suffix;
   under the reversed order of words, before the next larger one. Every run has a Lyndon root that is such a word in one of the orders.
3. Each of these two candidates per place is extended to both sides. Long enough stretches are the runs, each once.

Trees are built where runs can be. A run of period q contains, at every word, a window of ``_window`` words that occurs again q
words further on or back. So words outside of repeated windows, and windows whose nearest equal is further away than a
``LEAST_PERIODS``-th of the unbroken stretch around them, are in no run, and the stretches in between are independent of each other. This
is exact: it only compares hashes, and equal windows have equal hashes.

A task reads some texts at a time; a text is one sequence, whatever its length, and costs memory in proportion to it.

Defined cases: null, empty and blank texts have no words and no runs; rows with the same id are taken one by one; a null id is an id; an
empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.words import rows_of, words

LEAST_WORDS, LEAST_PERIODS = 6, 4
# Bytes of text that a task looks at together.
TOGETHER = 4 << 20
_BLOCK = 16
_FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_tree(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ukkonen's tree of ``symbols`` (positive), ended by a symbol 0 that is smaller than all.

    Returns the Euler tour as string depths, where each suffix stands in it, and for each suffix the place after the last
    leaf below its parent if the suffix ends at the parent's own string, and otherwise -1."""
    text = [*symbols, 0]
    n, base = len(text), max(text) + 1
    start, stop, link, suffix = [0], [0], [0], [-1]
    edges: dict[int, int] = {}
    active = at = length = left = 0
    for i, symbol in enumerate(text):
        last = 0
        left += 1
        while left:
            if not length:
                at = i
            key = active * base + text[at]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                suffix.append(i - left + 1)
                if last:
                    link[last] = active
                    last = 0
            else:
                span = stop[child] - start[child]
                if length >= span:
                    active = child
                    at += span
                    length -= span
                    continue
                if text[start[child] + length] == symbol:
                    length += 1
                    if last:
                        link[last] = active
                    break
                split = len(start)
                edges[key] = split
                edges[split * base + symbol] = split + 1
                start += (start[child], i)
                start[child] += length
                stop += (start[child], n)
                link += (0, 0)
                suffix += (-1, i - left + 1)
                edges[split * base + text[start[child]]] = child
                if last:
                    link[last] = split
                last = split
            left -= 1
            if not active and length:
                length -= 1
                at = i - left + 1
            else:
                active = link[active]
    return _tour(edges, base, n, np.array(stop) - np.array(start), np.array(suffix))


def _tour(edges: dict[int, int], base: int, n: int, spans: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = np.fromiter(edges, np.int64, len(edges))
    order = np.argsort(keys)
    children = np.fromiter(edges.values(), np.int64, len(edges))[order]
    parents, first = np.unique(keys[order] // base, return_index=True)
    below: list = [()] * len(spans)
    bounds = [*first.tolist(), len(children)]
    listed = children.tolist()
    for p, a, b in zip(parents.tolist(), bounds, bounds[1:]):
        below[p] = listed[a:b]
    depth = [0] * len(spans)
    span = spans.tolist()
    visits: list[int] = []
    stack = [0]
    # A node is met again after each of its children; ~node stands for these visits.
    while stack:
        node = stack.pop()
        if node < 0:
            visits.append(~node)
            continue
        visits.append(node)
        here = depth[node]
        for child in reversed(below[node]):
            depth[child] = here + span[child]
            stack += (~node, child)
    tour = np.array(visits)
    depths = np.array(depth)
    leaf = suffix >= 0
    at = np.empty(len(spans), np.int64)
    at[tour[::-1]] = np.arange(len(tour) - 1, -1, -1)
    last = np.empty(len(spans), np.int64)
    last[tour] = np.arange(len(tour))
    parent = np.zeros(len(spans), np.int64)
    parent[children] = keys[order] // base
    place, ends = np.empty(n, np.int64), np.full(n, -1, np.int64)
    place[suffix[leaf]] = at[leaf]
    at_end = leaf & (spans == 1) & (depths + suffix == n)
    at_end[leaf] &= depths[parent[leaf]] == n - 1 - suffix[leaf]
    ends[suffix[at_end]] = last[parent[at_end]]
    return depths[tour], place, ends


class RangeMinimum:
    """Least value between two places, in constant time: whole blocks by a sparse table, their ends by running minima."""

    def __init__(self, values: np.ndarray):
        blocks = -(-len(values) // _BLOCK)
        padded = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(values)] = values
        by_block = padded.reshape(blocks, _BLOCK)
        self.values = padded
        self.before = np.minimum.accumulate(by_block, axis=1).ravel()
        self.after = np.minimum.accumulate(by_block[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [by_block.min(axis=1)]
        while 2 << (len(self.table) - 1) <= blocks:
            step = 1 << (len(self.table) - 1)
            self.table.append(np.minimum(self.table[-1][:-step], self.table[-1][step:]))

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high = np.minimum(a, b), np.maximum(a, b)
        first, last = low // _BLOCK, high // _BLOCK
        out = np.minimum(self.after[low], self.before[high])
        between = np.flatnonzero(last - first > 1)
        count = last[between] - first[between] - 1
        level = np.frexp(count)[1] - 1
        for k in np.unique(level):
            some = between[level == k]
            table = self.table[k]
            out[some] = np.minimum(out[some], np.minimum(table[first[some] + 1], table[last[some] - (1 << k)]))
        inside = np.flatnonzero(first == last)
        if len(inside):
            steps = np.minimum(low[inside, None] + np.arange(_BLOCK), high[inside, None])
            out[inside] = self.values[steps].min(axis=1)
        return out


class Extensions:
    """How far suffixes of a sequence agree, and their order."""

    def __init__(self, symbols: list[int]):
        depths, self.place, self.ends = suffix_tree(symbols)
        self.minimum = RangeMinimum(depths)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self.minimum.least(self.place[i], self.place[j])

    def ranks(self) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the suffixes where the end is smaller than every word, and where it is larger."""
        moved = np.where(self.ends >= 0, self.ends, self.place)
        # Of suffixes that end at nested nodes closing together, the longer one belongs to the inner node.
        order = np.lexsort((np.arange(len(moved)), moved))
        larger = np.empty(len(moved), np.int64)
        larger[order] = np.arange(len(moved))
        return self.place, larger


def _next_smaller(ranks: list[int]) -> np.ndarray:
    """For all but the last place, which holds the least rank: the next place of a smaller rank."""
    out = [0] * (len(ranks) - 1)
    at = len(ranks) - 1
    for i in range(len(ranks) - 2, -1, -1):
        at, rank = i + 1, ranks[i]
        while ranks[at] > rank:
            at = out[at]
        out[i] = at
    return np.array(out, np.int64)


def runs_of(symbols: list[int], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> np.ndarray:
    """(start, length, period) of the runs of a sequence of positive numbers, by start, then period."""
    n = len(symbols)
    if n < max(least, 2):
        return np.zeros((0, 3), np.int64)
    onward, back = Extensions(symbols), Extensions(symbols[::-1])
    smaller, larger = onward.ranks()
    found = []
    i = np.arange(n)
    for ranks in (smaller, -larger):
        j = _next_smaller(ranks.tolist())
        end = j + onward.common(i, j)
        start = i - back.common(n - i, n - j)
        long = end - start >= np.maximum(least, periods * (j - i))
        found.append(np.stack([start[long], (end - start)[long], (j - i)[long]], axis=1))
    every = np.unique(np.concatenate(found), axis=0)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _window(least: int, periods: int) -> int:
    """Words that any run has equal to the words a period further on, in one piece."""
    return min(max(least, periods * q) - q for q in range(1, least + 1))


def likely_stretches(ids: np.ndarray, doc: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> np.ndarray:
    """(start, end) of the stretches of the sequences ``ids``, told apart by ``doc``, that all runs lie in."""
    width, n = _window(least, periods), len(ids)
    if n < least:
        return np.zeros((0, 2), np.int64)
    hashes = np.zeros(n - width + 1, np.uint64)
    numbers = ids.astype(np.uint64) + np.uint64(1)
    for k in range(width):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + numbers[k : n - width + 1 + k] * np.uint64(0xC2B2AE3D27D4EB4F)
        hashes ^= hashes >> np.uint64(29)
    at = np.flatnonzero(doc[: n - width + 1] == doc[width - 1 :])
    hashes = hashes[at] + doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(hashes, kind="stable")
    hashes, at = hashes[order], at[order]
    far = np.iinfo(np.int64).max
    gap = np.where(hashes[1:] == hashes[:-1], at[1:] - at[:-1], far)
    near = np.minimum(np.append(gap, far), np.insert(gap, 0, far))
    order = np.argsort(at, kind="stable")
    at, near = at[order], near[order]
    at, near = at[near < far], near[near < far]
    while True:
        # Words covered by a window, cut where a gap or another document begins.
        if not len(at):
            return np.zeros((0, 2), np.int64)
        begins = np.insert((at[1:] > at[:-1] + width) | (doc[at[1:]] != doc[at[:-1]]), 0, True)
        first = np.flatnonzero(begins)
        start, end = at[first], at[np.append(first[1:], len(at)) - 1] + width
        length = (end - start)[np.cumsum(begins) - 1]
        stays = (length >= least) & (near <= length // periods)
        if stays.all():
            return np.stack([start, end], axis=1)
        at, near = at[stays], near[stays]


def _runs_of_texts(texts: list[list[bytes]], least: int, periods: int) -> list[np.ndarray]:
    sizes = np.array([len(t) for t in texts], np.int64)
    number: dict[bytes, int] = {}
    for t in texts:
        number.update(dict.fromkeys(t))
    number = dict(zip(number, range(len(number))))
    ids = np.fromiter((number[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    before = np.cumsum(sizes) - sizes
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for start, end in likely_stretches(ids, doc, least, periods):
        _, symbols = np.unique(ids[start:end], return_inverse=True)
        runs = runs_of((symbols + 1).tolist(), least, periods)
        of = doc[start]
        found[of].append(runs + np.array([start - before[of], 0, 0]))
    return [np.concatenate(f) if f else np.zeros((0, 3), np.int64) for f in found]


def _collapsed(text: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(text)
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([text[i] for i in kept])


def _finder(least: int, periods: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
            ends = np.insert(np.cumsum(sizes, dtype=np.int64), 0, 0)
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + TOGETHER, "right")) - 1)
                part = batch.slice(at, to - at)
                at = to
                texts = [(t or b"").split() for t in part["text"].to_pylist()]
                runs = _runs_of_texts(texts, least, periods)
                flat = np.concatenate(runs)
                fields = [pa.array(flat[:, c]) for c in range(3)]
                offsets = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names=["start", "length", "period"])),
                        pa.array([_collapsed(t, r) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return find


def periodic_runs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of every text by start, then period, and the text without the words
    that a run has after its first period, its words joined by one space."""
    if least < 2 or periods < 2:
        raise ValueError("runs have two words and two periods at least")
    rows = rows_of(docs, id, text=F.col(f"`{text}`").cast("binary")).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_finder(least, periods), _FOUND)


def with_planted_periods(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): in a tenth of the documents, told by the checksum of the id, the words from some place on repeat
    with some period."""
    checksum = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    rows = rows_of(docs, id, text=text).withColumn("_h", checksum)
    chosen = F.when(F.col("_h") % 10 == 0, words(F.col("text")))
    rows = rows.withColumn("_w", chosen).withColumn("_n", F.size("_w")).withColumn("_g", F.floor(F.col("_h") / 10))
    rows = rows.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    rows = rows.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    tail = F.slice("_w", F.col("_a") + 1, F.col("_p"))
    repeated = F.flatten(F.array_repeat(tail, F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int")))
    whole = F.slice(F.concat(F.slice("_w", F.lit(1), F.col("_a")), repeated), F.lit(1), F.col("_n"))
    return rows.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def _most_periods(runs: str) -> Column:
    """The run of greatest length by period, compared exactly; the first of equal ones."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, better)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of all documents, after periods were planted, and what is left without them."""
    found = periodic_runs(with_planted_periods(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("_best", _most_periods("runs")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "_best.start",
        "_best.length",
        "_best.period",
        F.floor(F.col("_best.length") * 1000 / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.encode(listed, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode(F.col("collapsed"), "UTF-8"), 256).alias("collapsed_sha256"),
    )
