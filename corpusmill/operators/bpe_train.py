"""Byte-level BPE training from distributed pair counts.

The distinct words and their counts stay in Spark, below an index from pairs to words (``bpe_index``). The driver holds the
exact counts of the most frequent pairs. In a round it forecasts the next merges from the most frequent words; a job replays them
on the words that hold one of their pairs and returns how each merge changes the counts that matter. The driver then follows the
exact counts, merge by merge, and accepts the forecast as far as every merge is the most frequent pair. The first one
always is, so a poor forecast costs rounds and never changes the result, which is that of merging one pair at a time.

What the driver holds is bounded by constants and the vocabulary size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.bytelevel import FIRST_MERGE_ID, ID_TO_BYTE, SPECIAL_TOKENS, adjacent_pairs, symbols_of
from corpusmill.functions.text import with_prefix_space, words_of
from corpusmill.operators.bpe_index import MOST_PAIRS, Forecast, Merge, PairIndex, Ranking, pair_of, symbols_of_pair
from corpusmill.operators.clean import nfkc

# Fixed value: pairs rarer than this are not merged.
MIN_FREQUENCY = 2
# Merges that the first round looks at, and a later one at least and at most.
FIRST_ROUND, LEAST_ROUND, MOST_MERGES_PER_ROUND = 128, 48, 512


@dataclass
class Model:
    """Merges (left id, right id, new id) by rank, token bytes by id, added whole-word tokens."""

    merges: list[tuple[int, int, int]] = field(default_factory=list)
    tokens: list[bytes] = field(default_factory=list)
    added: list[str] = field(default_factory=list)

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = [(rank, *merge) for rank, merge in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left int, right int, new_id int")

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, bytearray(t), False) for i, t in enumerate(self.tokens)]
        rows += [
            (len(self.tokens) + i, bytearray(w.encode()), True) for i, w in enumerate(self.added)
        ]
        return spark.createDataFrame(rows, "id int, token binary, added boolean")

    def save(self, spark: SparkSession, location: str, mode: str = "errorifexists") -> None:
        self.merges_table(spark).coalesce(1).write.mode(mode).parquet(f"{location}/merges")
        self.vocab_table(spark).coalesce(1).write.mode(mode).parquet(f"{location}/vocab")


def load_model(spark: SparkSession, location: str) -> Model:
    """The model saved in a folder; its tables are as small as the vocabulary."""
    try:
        merges = spark.read.parquet(f"{location}/merges").orderBy("rank").collect()
        vocab = spark.read.parquet(f"{location}/vocab").orderBy("id").collect()
    except Exception as error:
        raise ValueError(f"invalid tokenizer location {location}") from error
    return Model(
        [(m.left, m.right, m.new_id) for m in merges],
        [bytes(v.token) for v in vocab if not v.added],
        [bytes(v.token).decode() for v in vocab if v.added],
    )


def word_counts(texts: DataFrame, text: str = "text", normalize: bool = True) -> DataFrame:
    """(word, n) of the pre-tokenised texts. ASCII texts need no normalisation."""
    col = nfkc(F.col(text)) if normalize else F.col(text)
    return (
        texts.select(F.explode(words_of(with_prefix_space(col))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def pair_counts(symbols: DataFrame) -> DataFrame:
    """(pair, n) of neighbouring symbols of (symbols, n)."""
    return (
        symbols.select(F.explode(adjacent_pairs(F.col("symbols"))).alias("pair"), "n")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )


def initial_symbols(words: DataFrame) -> DataFrame:
    """(symbols, n) of the words that have something to merge."""
    return words.select(symbols_of(F.col("word")).alias("symbols"), "n").where(F.length("symbols") > 1)


def train(
    words: DataFrame,
    vocab_size: int,
    added: list[str] | None = None,
    merges_per_round: int = MOST_MERGES_PER_ROUND,
) -> Model:
    """Learns merges from (word, n) until the vocabulary has ``vocab_size`` tokens or every pair is
    rare. Equal counts go to the smaller (left id, right id)."""
    added = added or []
    if vocab_size < len(added):
        raise ValueError(f"vocab_size {vocab_size} is less than the {len(added)} added tokens")
    tokens = [t.encode() for t in SPECIAL_TOKENS] + [bytes([b]) for b in ID_TO_BYTE]
    known = {t: i for i, t in enumerate(tokens)}
    merges: list[Merge] = []
    if len(tokens) >= vocab_size:
        return Model(merges, tokens, added)
    index = PairIndex(words)
    forecast = Forecast(index.sample)
    counts, last = _most_frequent(index)
    ahead = min(FIRST_ROUND, merges_per_round)
    while len(tokens) < vocab_size:
        best = Ranking(counts).best()
        if best is None or best > last:
            if last[0] == -MIN_FREQUENCY and last[1] == NO_PAIR:
                break
            counts, last = _most_frequent(index)
            if not counts:
                break
            continue
        batch = _forecast(forecast, counts, last, tokens, known, min(ahead, vocab_size - len(tokens)))
        changes = index.changes(merges, batch, counts, -last[0])
        ranking, held = Ranking(counts), 0
        for (left, right, new), change in zip(batch, changes):
            best = ranking.best()
            if best is None or best > last or best[1] != pair_of(left, right):
                break
            merges.append((left, right, new))
            if new == len(tokens):
                known[tokens[left] + tokens[right]] = new
                tokens.append(tokens[left] + tokens[right])
            for pair, n in change.items():
                ranking.add(pair, n)
            held += 1
        index.accept(held)
        forecast.settle(held)
        counts = {pair: n for pair, n in ranking.counts.items() if n >= -last[0]}
        ahead = min(2 * ahead, merges_per_round) if held == len(batch) else min(max(2 * held, LEAST_ROUND), merges_per_round)
        # Occurrences of a known token that a merge makes count with its old ones, also in pairs that were not held.
        again = held and batch[held - 1][2] != len(tokens) - 1
        if (again or not index.settled) and len(tokens) < vocab_size:
            counts, last = _most_frequent(index)
    index.close()
    return Model(merges, tokens, added)


def read_added(lexicon: DataFrame, vocab_size: int) -> list[str]:
    """The distinct words of a lexicon (word) in its alphabetical order. More words than the vocabulary has tokens are an
    error before they are read."""
    words = lexicon.select("word").distinct()
    if words.count() > vocab_size:
        raise ValueError(f"vocab_size {vocab_size} is less than the number of added tokens")
    return [r.word for r in words.orderBy("word").collect()]


# Comes after every pair.
NO_PAIR = 1 << 62


def _most_frequent(index: PairIndex) -> tuple[dict[int, int], tuple[int, int]]:
    """The counts that the driver holds, and (-n, pair) such that all pairs it does not hold come after it."""
    top = index.top()
    last = (-top[-1][1], top[-1][0]) if len(top) == MOST_PAIRS else (-MIN_FREQUENCY, NO_PAIR)
    last = min(last, (-MIN_FREQUENCY, NO_PAIR))
    return {pair: n for pair, n in top if (-n, pair) <= last}, last


def _forecast(
    forecast: Forecast, counts: dict[int, int], last: tuple[int, int], tokens: list[bytes], known: dict[bytes, int], most: int
) -> list[Merge]:
    """Up to ``most`` merges, the first one certain. A merge that makes a known token is the last one."""
    ranking, batch = Ranking(counts), []
    made, names = dict(known), list(tokens)
    while len(batch) < most:
        best = ranking.best()
        if best is None or best > last:
            break
        left, right = symbols_of_pair(best[1])
        token = names[left] + names[right]
        new = made.setdefault(token, len(names))
        batch.append((left, right, new))

        for pair, n in forecast.merge(left, right, new).items():
            if pair in ranking.counts or new in symbols_of_pair(pair):
                ranking.add(pair, n)
        if new < len(names):
            break
        names.append(token)
        # The sample may lack occurrences: what was merged is gone.
        ranking.counts[best[1]] = 0
    return batch
