"""Ranked lexical search: dense tiles of item weights times tiles of document impacts.

Terms are runs of digits, letters and characters beyond ASCII; A-Z count as lower case. A document's impact for a term is a whole
number below 10^6 / 1000 times ``SCALE``, an item's weight for it is the term's weight times its occurrences in the item,
and a score is the sum of their products: a matrix product, computed by BLAS in doubles and still exact.

1. The items are read in blocks of at most ``BLOCK_CHARACTERS`` characters, whatever their number; one block is all that the driver
   and the tasks hold of them. Its distinct terms are the block's vocabulary.
2. One pass over the texts counts vocabulary terms: (document, number of all its terms, term numbers, occurrences) is written.
   Document and term counts come from that table.
3. Items go into tiles of ``TILE_ITEMS``, each with its own compact vocabulary, cut into tiles of at most ``TILE_TERMS`` terms and so
   that no item's sum of products within a tile can reach 2^53: every partial sum BLAS makes, in any order, is then a
   whole number that a double holds. Weights too large for that are taken apart into digits of ``DIGIT_BITS`` bits. Tiles are
   summed up in 64-bit integers.
4. A tile of documents is reduced to the candidates that reach an item's k-th best score so far, ties included, and these by
   (score, id), so neither tile borders nor task borders decide a tie. A task hands on k rows per item.

Defined cases: null texts and texts without a term are in no count and in no result; equal scores go to the smaller document id,
none last; rows with the same id are ranked one by one; an item without terms has no rows; items of the same id (or none) are
ranked one by one; empty tables give an empty result; columns other than ids and texts are not read. Ids are longs.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.words import rows_of, stored

# Fixed values of the ranking: impacts are (SCALE * tf) div (1000 * tf + 8 * m), m = 25 + (75 * n * N) div L.
SCALE, SATURATION, LENGTH_PART = 1_000_000_000, 8, 75
MOST_IMPACT = SCALE // 1000
EXACT = 1 << 53
DIGIT_BITS = 32
TILE_ITEMS, TILE_TERMS, TILE_DOCS = 256, 1024, 1024
BLOCK_CHARACTERS = 8_000_000
# Candidates a task holds before it reduces them to k per item.
HELD = 200_000

# Fixed value: the bytes between terms. All bytes of characters beyond ASCII belong to terms.
_BETWEEN = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TO_TERMS = bytes(0x20 if b in set(_BETWEEN) else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_COUNTED = "doc_id long, n long, terms array<int>, times array<int>"
_SCORED = "item_no int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_TO_TERMS).split()


@dataclass
class ItemBlock:
    """Items held together: their ids, terms with occurrences, and the numbers of the distinct terms."""

    ids: list
    counts: list[Counter]
    numbers: dict[bytes, int]


def item_blocks(items: DataFrame, id: str, text: str) -> Iterator[ItemBlock]:
    """All items in blocks of about ``BLOCK_CHARACTERS``, the size of each being checked before it is read; a single longer
    text is a block of its own."""
    rows = stored(
        rows_of(items, id, text=text)
        .withColumn("key", F.monotonically_increasing_id())
        .withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")),
        "items",
    )
    total, n = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    blocks = max(1, -(-(total or 0) // BLOCK_CHARACTERS))
    while True:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
        largest = dealt.groupBy("block").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        if not largest.where(f"size > {BLOCK_CHARACTERS} AND n > 1").count():
            break
        blocks *= 2
    for block in range(blocks):
        held = dealt.where(F.col("block") == block).select("doc_id", F.col("text").cast("binary").alias("text"), "key").toArrow()
        held = held.sort_by("key")
        counts = [Counter(terms_of(t or b"")) for t in held["text"].to_pylist()]
        numbers: dict[bytes, int] = {}
        for c in counts:
            for term in c:
                numbers.setdefault(term, len(numbers))
        if numbers:
            yield ItemBlock(held["doc_id"].to_pylist(), counts, numbers)


def counted_terms(docs: DataFrame, numbers: dict[bytes, int], id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, times): the documents with a term, and how often each has those of the vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(numbers)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        for batch in batches:
            rows, sizes, terms, times = [], [], [], []
            for at, value in enumerate(batch["text"]):
                found = terms_of(value.as_buffer().to_pybytes()) if value.is_valid else ()
                if not found:
                    continue
                known = Counter(map(get, found))
                known.pop(None, None)
                rows.append(at)
                sizes.append(len(found))
                terms.append(list(known))
                times.append(list(known.values()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), *(pa.array(x, pa.list_(pa.int32())) for x in (terms, times))],
                names=["doc_id", "n", "terms", "times"],
            )

    rows = rows_of(docs, id, text=F.col(f"`{text}`").cast("binary")).withColumn("doc_id", F.col("doc_id").cast("long"))
    return stored(rows.mapInArrow(count, _COUNTED), "term-counts")


@dataclass
class Tile:
    """Weights of some items for some terms: ``digits`` times 2^``shift`` at (term, item)."""

    terms: np.ndarray
    shift: int
    rows: np.ndarray
    columns: np.ndarray
    digits: np.ndarray

    def dense(self, n_items: int) -> np.ndarray:
        out = np.zeros((len(self.terms), n_items))
        out[self.rows, self.columns] = self.digits
        return out


def weight_tiles(weights: list[dict[int, int]], tile_terms: int = TILE_TERMS) -> list[Tile]:
    """The tiles of a few items, given the weight of each of their terms."""
    entries = [(term, item, w) for item, of in enumerate(weights) for term, w in of.items() if w]
    tiles: list[Tile] = []
    shift = 0
    while entries:
        digit = [(t, i, d) for t, i, w in entries if (d := (w >> shift) & ((1 << DIGIT_BITS) - 1))]
        by_term: dict[int, list[tuple[int, int]]] = {}
        for t, i, d in digit:
            by_term.setdefault(t, []).append((i, d))
        sums, held = np.zeros(len(weights)), []

        def cut() -> None:
            terms = np.array(held, np.int64)
            rows, columns, digits = zip(*((r, i, d) for r, t in enumerate(held) for i, d in by_term[t]))
            tiles.append(Tile(terms, shift, np.array(rows), np.array(columns), np.array(digits, np.float64)))

        for t in sorted(by_term):
            more = np.zeros(len(weights))
            for i, d in by_term[t]:
                more[i] = d * MOST_IMPACT
            if held and (len(held) == tile_terms or (sums + more >= EXACT).any()):
                cut()
                sums[:], held = 0, []
            sums += more
            held.append(t)
        if held:
            cut()
        shift += DIGIT_BITS
        entries = [e for e in entries if e[2] >> shift]
    return tiles


def best_of(items: np.ndarray, nulls: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k best of each item, by score, then by id."""
    order = np.lexsort((ids, nulls, -scores, items))
    first = np.searchsorted(items[order], items[order])
    return order[np.arange(len(order)) - first < k]


def _scorer(tiles_sent, n_docs: int, n_terms: int, k: int):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = [(first, n, [(t, t.dense(n)) for t in tiles]) for first, n, tiles in tiles_sent.value]
        n_items = sum(n for _, n, _ in groups)
        reached = np.ones(n_items, np.int64)
        held = [np.zeros(0, np.int64) for _ in range(4)]

        def reduced(parts: list[np.ndarray]) -> list[np.ndarray]:
            best = best_of(parts[0], parts[1], parts[2], parts[3], k)
            parts = [p[best] for p in parts]
            counts = np.bincount(parts[0], minlength=n_items)
            full = np.flatnonzero(counts >= k)
            least = np.full(n_items, np.iinfo(np.int64).max)
            np.minimum.at(least, parts[0], parts[3])
            reached[full] = np.maximum(reached[full], least[full])
            return parts

        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                null = part["doc_id"].is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = part["doc_id"].fill_null(0).to_numpy()
                sizes = part["n"].to_numpy()
                lists = part["terms"]
                row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                term = lists.flatten().to_numpy()
                times = part["times"].flatten().to_numpy().astype(np.int64)
                m = 100 - LENGTH_PART + (LENGTH_PART * sizes * n_docs) // n_terms
                impact = ((SCALE * times) // (1000 * times + SATURATION * m[row])).astype(np.float64)
                by_term = np.argsort(term, kind="stable")
                row, term, impact = row[by_term], term[by_term], impact[by_term]
                for first, n, tiles in groups:
                    scores = np.zeros((part.num_rows, n), np.int64)
                    for tile, weights in tiles:
                        low, high = np.searchsorted(term, (tile.terms[0], tile.terms[-1] + 1))
                        place = np.searchsorted(tile.terms, term[low:high])
                        of_tile = tile.terms[place] == term[low:high]
                        dense = np.zeros((part.num_rows, len(tile.terms)))
                        dense[row[low:high][of_tile], place[of_tile]] = impact[low:high][of_tile]
                        scores += (dense @ weights).astype(np.int64) << tile.shift
                    least = reached[first : first + n]
                    if part.num_rows > k:
                        kth = np.partition(scores, part.num_rows - k, axis=0)[part.num_rows - k]
                        least = np.maximum(least, kth)
                    docs, columns = np.nonzero(scores >= least)
                    more = [columns + first, null[docs], ids[docs], scores[docs, columns]]
                    held = [np.concatenate(p) for p in zip(held, more)]
                    if len(held[0]) > HELD:
                        held = reduced(held)
                held = reduced(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held[0].astype(np.int32)), pa.array(held[2], pa.int64(), mask=held[1].astype(bool)), pa.array(held[3])],
            names=["item_no", "doc_id", "score"],
        )

    return score


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, those of score 0 left out."""
    spark = docs.sparkSession
    # The item's own row number tells items of the same id apart.
    best = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = None
    for block in item_blocks(items, item_id, item_text):
        counted = counted_terms(docs, block.numbers, id, text)
        n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        in_docs = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        # One row per term of the block at most.
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in in_docs.collect()}
        of_items = [{block.numbers[t]: c * weight.get(block.numbers[t], 0) for t, c in of.items()} for of in block.counts]
        tiles = []
        for first in range(0, len(of_items), TILE_ITEMS):
            some = of_items[first : first + TILE_ITEMS]
            tiles.append((first, len(some), weight_tiles(some)))
        sent = spark.sparkContext.broadcast(tiles)
        scored = counted.where("size(terms) > 0").mapInArrow(_scorer(sent, n_docs, n_terms or 1, k), _SCORED)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item_no int, item_id {items.schema[item_id].dataType.simpleString()}")
        ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).join(names, "item_no")
        ranked = stored(ranked.select("item_id", "rank", "doc_id", "score"), "ranked")
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        none = items.select(F.col(f"`{item_id}`").alias("item_id")).limit(0)
        found = none.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return found


def op11_blas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of all for each benchmark item."""
    return top_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
OP11_SQL = f"""
    WITH d AS MATERIALIZED (
        SELECT doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM (SELECT doc_id, {_TERMS_SQL} AS ts FROM documents) WHERE len(ts) > 0),
    s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
    q AS MATERIALIZED (
        SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL),
    tf AS MATERIALIZED (
        SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM d)
        WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    w AS (
        SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
        FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
    i AS (
        SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)) AS impact FROM tf, s),
    scores AS (
        SELECT item_id, doc_id, CAST(sum(times * w * impact) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN i USING (term) GROUP BY ALL)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
    WHERE rank <= 10
"""
