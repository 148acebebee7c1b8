"""Pair counts of a distributed word table, kept up to date by signed changes.

An index leads from a pair of neighbouring symbols to the words that hold it. A round looks up the words that hold one of its
pairs, replays the merges so far on these words only, goes on with the round's merges, and writes

* how each merge changes the count of each pair, pre-aggregated in the task, and
* the words again under the pairs that the round gave them.

The index only grows between two clean-ups, so a word may stand below a pair it has lost. That costs a look at the word and
changes nothing, because its symbols come from the replay. All tables are written to the shared folder, so a lost task repeats its
part of one round; tables that nothing will read again are deleted.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.bytelevel import BYTE_TO_ID
from corpusmill.session import delete_path, scratch_path

Merge = tuple[int, int, int]

# Pairs whose exact counts the driver holds, of some 100 bytes each.
MOST_PAIRS = 4096
# Most frequent words, and words drawn from all others, that the driver forecasts merges from.
FREQUENT_WORDS, DRAWN_WORDS = 25_000, 25_000
# Rounds between two clean-ups, and sorted tables that are merged into one.
ROUNDS_TO_SETTLE, MOST_SORTED = 16, 4
# (merge, pair) counts that a task holds.
HELD = 200_000
_BITS = 32
_ROUND = "step int, pair long, n long, word string, known boolean"


def pair_of(left: int, right: int) -> int:
    """A number that sorts like (left, right)."""
    return left << _BITS | right


def symbols_of_pair(pair: int) -> tuple[int, int]:
    return pair >> _BITS, pair & ((1 << _BITS) - 1)


def first_symbols(word: str) -> list[int]:
    return [BYTE_TO_ID[b] for b in word.encode()]


class Replay:
    """Merges, applied to words one after the other: all occurrences of the first from left to right, then of the second."""

    def __init__(self, merges: list[Merge]):
        self.merges = merges
        self.ranks: dict[int, list[int]] = {}
        for rank, (left, right, _) in enumerate(merges):
            self.ranks.setdefault(pair_of(left, right), []).append(rank)

    def _next(self, left: int, right: int, rank: int) -> int | None:
        """The next merge after ``rank`` that joins the pair; it is a second one only if the pair came back."""
        ranks = self.ranks.get(left << _BITS | right)
        if ranks is None or ranks[-1] <= rank:
            return None
        return ranks[bisect_right(ranks, rank)]

    def changes(self, ids: list[int], done: int) -> list[tuple[int, int, int]]:
        """(step, pair, -1 or 1): what each merge after the first ``done`` changes in a word of these first symbols."""
        heap = [(rank, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (rank := self._next(a, b, -1)) is not None]
        found: list[tuple[int, int, int]] = []
        heapify(heap)
        n, note = len(ids), found.append
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, i = heappop(heap)
            left, right, new = self.merges[rank]
            j = after[i]
            if ids[i] != left or j == n or ids[j] != right:
                continue
            h, k = before[i], after[j]
            if rank >= done:
                step = rank - done
                note((step, left << _BITS | right, -1))
                if h >= 0:
                    note((step, ids[h] << _BITS | left, -1))
                    note((step, ids[h] << _BITS | new, 1))
                if k < n:
                    note((step, right << _BITS | ids[k], -1))
                    note((step, new << _BITS | ids[k], 1))
            ids[i], ids[j] = new, -1
            after[i] = k
            if k < n:
                before[k] = i
                if (more := self._next(new, ids[k], rank)) is not None:
                    heappush(heap, (more, i))
            if h >= 0 and (more := self._next(ids[h], new, rank)) is not None:
                heappush(heap, (more, h))
        return found


def _rows(steps: list, pairs: list, counts: list, words: list, known: list) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
    columns = [pa.array(c, t) for c, t in zip((steps, pairs, counts, words, known), types)]
    return pa.RecordBatch.from_arrays(columns, names=["step", "pair", "n", "word", "known"])


def _round(changes_of: Callable[[str], Iterable[tuple[int, int, int]]], is_known: Callable[[int], bool]):
    """(word, n) in; changes of counts (without word) and words below their new pairs (without step) out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], int] = {}

        def counts() -> pa.RecordBatch:
            some = [(step, pair, n, is_known(pair)) for (step, pair), n in held.items() if n]
            held.clear()
            steps, pairs, numbers, known = zip(*some) if some else ((), (), (), ())
            return _rows(steps, pairs, numbers, [None] * len(some), known)

        for batch in batches:
            pairs, numbers, words = [], [], []
            for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist()):
                gained = set()
                for step, pair, sign in changes_of(word):
                    held[step, pair] = held.get((step, pair), 0) + sign * n
                    if sign > 0:
                        gained.add(pair)
                pairs += gained
                numbers += [n] * len(gained)
                words += [word] * len(gained)
                if len(held) > HELD:
                    yield counts()
            nothing = [None] * len(pairs)
            yield _rows(nothing, pairs, numbers, words, nothing)
        yield counts()

    return run


class PairIndex:
    """The words, their pairs and the pairs' counts after the merges that were accepted."""

    def __init__(self, words: DataFrame):
        """``words`` (word, n) is read once."""
        self.spark = words.sparkSession
        self.tasks = max(self.spark.sparkContext.defaultParallelism, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        kept = self._written(words.where("octet_length(word) > 1").select("word", F.col("n").cast("long")), "bpe-words")
        self.sample = self._sampled(self._read(kept))

        def all_pairs(word: str) -> list[tuple[int, int, int]]:
            ids = first_symbols(word)
            return [(0, pair_of(a, b), 1) for a, b in zip(ids, ids[1:])]

        self.sorted: list[str] = []
        self.rounds = [(self._run(self._read(kept).repartition(self.tasks), all_pairs), 1)]
        self.counts: str | None = None
        delete_path(self.spark, kept)

    def _sampled(self, words: DataFrame) -> list[tuple[str, float]]:
        """The most frequent words, and a draw of the others that stands for all of them."""
        frequent = words.orderBy(F.col("n").desc(), "word").limit(FREQUENT_WORDS).collect()
        sample = [(r.word, float(r.n)) for r in frequent]
        if len(sample) == FREQUENT_WORDS:
            n, word = frequent[-1].n, frequent[-1].word
            rest = words.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word)))
            drawn = rest.orderBy(F.xxhash64("word")).limit(DRAWN_WORDS).collect()
            share = sum(r.n for r in drawn) / max(rest.agg(F.sum("n")).first()[0] or 1, 1)
            sample += [(r.word, r.n / share) for r in drawn]
        return sample

    def _read(self, *paths: str) -> DataFrame:
        return self.spark.read.parquet(*paths)

    def _written(self, df: DataFrame, name: str) -> str:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return path

    def _run(self, words: DataFrame, changes_of, is_known=lambda pair: False) -> str:
        return self._written(words.mapInArrow(_round(changes_of, is_known), _ROUND), "bpe-round")

    def _postings(self) -> DataFrame:
        fresh = [path for path, _ in self.rounds]
        parts = [self._read(*paths).where("word IS NOT NULL").select("pair", "word", "n") for paths in (self.sorted, fresh) if paths]
        return reduce(DataFrame.unionByName, parts)

    def _changed(self) -> DataFrame:
        """(pair, n): the counts at the last clean-up, and all changes that were accepted since."""
        changed = [self._read(path).where(F.col("word").isNull() & (F.col("step") < steps)) for path, steps in self.rounds]
        if self.counts is not None:
            changed.append(self._read(self.counts))
        every = reduce(DataFrame.unionByName, [c.select("pair", "n") for c in changed])
        return every.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0")

    def _clean_up(self) -> None:
        """One table of counts, and the words of all rounds in one table sorted by pair."""
        counts = self._written(self._changed(), "bpe-counts")
        fresh = self._read(*[path for path, _ in self.rounds]).where("word IS NOT NULL").select("pair", "word", "n")
        merged = self.sorted if len(self.sorted) >= MOST_SORTED else []
        if merged:
            fresh = fresh.unionByName(self._read(*merged))
        index = self._written(fresh.repartitionByRange("pair", "word").sortWithinPartitions("pair"), "bpe-index")
        gone = [*merged, *[path for path, _ in self.rounds], *([self.counts] if self.counts else [])]
        self.sorted = [p for p in self.sorted if p not in merged] + [index]
        self.rounds, self.counts = [], counts
        for path in gone:
            delete_path(self.spark, path)

    def top(self) -> list[tuple[int, int]]:
        """(pair, n) of the ``MOST_PAIRS`` most frequent pairs, the smaller pair first among equals."""
        if not self.settled:
            self._clean_up()
        best = self._changed().orderBy(F.col("n").desc(), "pair").limit(MOST_PAIRS).collect()
        return [(r.pair, r.n) for r in best]

    def changes(self, merges: list[Merge], batch: list[Merge], known: Iterable[int], least: int) -> list[dict[int, int]]:
        """For each merge of ``batch``, which follows ``merges``: the change of the count of each pair that is among ``known``
        or that one merge makes ``least`` times or more. Those are all pairs that ever reach ``least``, for a pair
        is made by the merge that makes the later of its symbols and only gets rarer afterwards."""
        made = {new for _, _, new in batch}
        old = [pair_of(a, b) for a, b, _ in batch if a not in made and b not in made]
        touched = self._postings().where(F.col("pair").isin(old)).select("word", "n")
        words = touched.repartition(self.tasks, "word").groupBy("word").agg(F.max("n").alias("n"))
        sent = self.spark.sparkContext.broadcast((Replay([*merges, *batch]), frozenset(known)))
        done = len(merges)
        path = self._run(
            words, lambda word: sent.value[0].changes(first_symbols(word), done), lambda pair: pair in sent.value[1]
        )
        self.rounds.append((path, 0))
        # Tasks have added up what they saw; one shuffle serves both groupings.
        changed = self._read(path).where("word IS NULL").repartition("pair").groupBy("pair", "step")
        by_step = changed.agg(F.sum("n").alias("n"), F.max("known").alias("known"))
        by_pair = by_step.groupBy("pair").agg(
            F.collect_list("step").alias("steps"), F.collect_list("n").alias("n"), F.max("n").alias("most"), F.max("known").alias("known")
        )
        rows = by_pair.where((F.col("most") >= least) | F.col("known")).select("pair", "steps", "n").toArrow()
        sent.destroy()
        found: list[dict[int, int]] = [{} for _ in batch]
        for pair, steps, changes in zip(*(rows[c].to_pylist() for c in ("pair", "steps", "n"))):
            for step, n in zip(steps, changes):
                found[step][pair] = n
        return found

    def accept(self, steps: int) -> None:
        """The first ``steps`` merges of the last round hold."""
        self.rounds[-1] = (self.rounds[-1][0], steps)

    @property
    def settled(self) -> bool:
        return len(self.rounds) < ROUNDS_TO_SETTLE

    def close(self) -> None:
        for path in [*self.sorted, *[p for p, _ in self.rounds], *([self.counts] if self.counts else [])]:
            delete_path(self.spark, path)


class Ranking:
    """The most frequent pair of counts that change."""

    def __init__(self, counts: dict[int, float]):
        self.counts = dict(counts)
        self.heap = [(-n, pair) for pair, n in counts.items()]
        heapify(self.heap)

    def add(self, pair: int, n: float) -> None:
        self.counts[pair] = n = self.counts.get(pair, 0) + n
        if n > 0:
            heappush(self.heap, (-n, pair))

    def best(self) -> tuple[float, int] | None:
        """(-n, pair), the smallest pair of the most frequent."""
        while self.heap and self.counts[self.heap[0][1]] != -self.heap[0][0]:
            heappop(self.heap)
        return self.heap[0] if self.heap else None


class Forecast:
    """What a sample of words says about the next merges. A forecast only decides what a round looks at; what is merged is
    decided by the counts of all words.

    The words stand one after the other in one array, -1 between them, with the weight of its word beside each symbol."""

    def __init__(self, sample: list[tuple[str, float]]):
        words = [first_symbols(word) for word, _ in sample]
        self.ids = np.array([i for ids in words for i in (*ids, -1)] or [-1], np.int64)
        weights = np.array([n for _, n in sample], np.float64)
        self.weights = np.repeat(weights, [len(ids) + 1 for ids in words]) if words else np.zeros(1)
        self.start, self.merged = (self.ids, self.weights), []

    def merge(self, left: int, right: int, new: int) -> dict[int, float]:
        """Merges a pair in all words; the changes of counts."""
        self.merged.append((left, right, new))
        ids, weights = self.ids, self.weights
        at = np.flatnonzero((ids[:-1] == left) & (ids[1:] == right))
        if left == right and len(at):
            # Of a stretch of equal symbols every second one begins a pair.
            first = np.insert(np.diff(at) != 1, 0, True)
            at = at[(at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0]
        if not len(at):
            return {}
        lost = _weighed(ids, weights, np.unique(np.concatenate([at - 1, at, at + 1])), -1)
        stays = np.ones(len(ids), bool)
        stays[at + 1] = False
        ids = ids.copy()
        ids[at] = new
        self.ids, self.weights = ids[stays], weights[stays]
        at = at - np.arange(len(at))
        change = _weighed(self.ids, self.weights, np.unique(np.concatenate([at - 1, at])), 1)
        for pair, n in lost.items():
            change[pair] = change.get(pair, 0) + n
        return change

    def settle(self, steps: int) -> None:
        """Takes all but the first ``steps`` merges since the last call back."""
        if steps < len(self.merged):
            held = self.merged[:steps]
            self.ids, self.weights = self.start
            for merge in held:
                self.merge(*merge)
        self.start, self.merged = (self.ids, self.weights), []


def _weighed(ids: np.ndarray, weights: np.ndarray, at: np.ndarray, sign: int) -> dict[int, float]:
    """How often the pairs that begin at ``at`` stand there."""
    at = at[(at >= 0) & (at < len(ids) - 1)]
    at = at[(ids[at] >= 0) & (ids[at + 1] >= 0)]
    pairs, number = np.unique(ids[at] << _BITS | ids[at + 1], return_inverse=True)
    return dict(zip(pairs.tolist(), (sign * np.bincount(number, weights[at], len(pairs))).tolist()))
