"""Largest inner products through a forest of random-projection trees.

Vectors get one more component that gives all of them the length of the longest, so that the largest inner product with a query
is the nearest neighbour in angle. The trees are fitted on a sample of at most ``SAMPLE`` vectors: a node
splits at the median of a random projection. Every vector is put in one leaf of each tree. A query pops nodes of all trees
from one shared priority queue, nearest boundary first, until it has a share of all leaves; the vectors in them are
scored as they were given and the best win.

Queries are sent to the tasks with their leaves, ``QUERIES`` at a time. A task reads its part of the vectors in pieces of
``PIECE`` rows, scores each leaf of a piece for the queries that chose it, and keeps one running list of the best for each
query. So vectors are neither copied nor gathered by leaf, and what leaves a task is ``k + 1`` rows for each query.

Of equal vectors only the ``k + 1`` with the smallest ids can be among the nearest, so no more are indexed, and
equal queries are searched once; a leaf cannot fill up with copies.

The share of leaves is constant, so recall does not fall as the table grows. Vectors without structure (isotropic noise in
64 dimensions) need a large share; clustered ones need far less (``share``).

Defined cases: vectors that are null, zero, of another length than most of the sample, or hold null or non-finite components
take no part, nor do rows without id; fewer candidates than ``k`` are all returned; ties go to the smaller id; a table without queries gives an empty
result; other columns are not read. Rows with one id are candidates each; none of them is a candidate of its own id.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.words import rows_of, stored

SAMPLE = 20_000
TREES = 4
# Rows of a leaf, as far as the sample allows trees of this depth.
LEAF, LEAST_DEPTH = 64, 2
SHARE = 0.25
# A query reads on until its leaves hold this many rows per result, so a small table is searched as thoroughly as a large one.
ROWS_PER_RESULT = 32
SEED = 11
# Queries sent together: with 64 components and 1,024 leaves each, some 80 MB.
QUERIES = 16_384
# Vectors that a task holds, and that it reads in all: with fewer tasks there are fewer lists to merge.
PIECE, PER_TASK, LEAST_TASKS = 1 << 15, 1 << 17, 8
# Candidates that a task holds before it reduces them to the best of each query.
HELD = 1 << 19


def usable(vectors: DataFrame, id: str, embedding: str) -> DataFrame:
    """(doc_id, v): rows that take part, components as doubles."""
    v = F.transform(F.col(f"`{embedding}`"), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows_of(vectors, id, v=v).where(F.col("doc_id").isNotNull() & finite & F.exists("v", lambda x: x != 0))


class Forest:
    """Directions and thresholds of complete binary trees of one depth, nodes in level order."""

    def __init__(self, sample: np.ndarray, depth: int, n_trees: int = TREES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.depth, self.n_trees, inner = depth, n_trees, (1 << depth) - 1
        self.directions = rng.standard_normal((n_trees, inner, sample.shape[1]))
        self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True)
        self.thresholds = np.zeros((n_trees, inner))
        for t in range(n_trees):
            at = np.zeros(len(sample), np.int64)
            for level in range(depth):
                for node in range((1 << level) - 1, (2 << level) - 1):
                    inside = at == node
                    p = sample[inside] @ self.directions[t, node]
                    self.thresholds[t, node] = np.median(p) if len(p) else 0.0
                    at[inside] = 2 * node + 1 + (p > self.thresholds[t, node])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(trees, rows): the leaf of every row."""
        out = np.empty((self.n_trees, len(x)), np.int64)
        for t in range(self.n_trees):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", x, self.directions[t, at]) > self.thresholds[t, at]
                at = 2 * at + 1 + right
            out[t] = at
        return out

    def probes(self, q: np.ndarray, n: int, sizes: np.ndarray, rows: int) -> list[tuple[int, int]]:
        """The first leaves (tree, leaf) of a query, in the order of a queue that all trees share: at least ``n``, and so many
        that their ``sizes`` (trees, nodes) add up to ``rows``.

        A node's priority is the squared distance to the boundaries crossed on the way to it."""
        margins = self.directions @ q - self.thresholds
        inner = margins.shape[1]
        queue = [(0.0, t, 0) for t in range(self.n_trees)]
        out: list[tuple[int, int]] = []
        while queue and (len(out) < n or rows > 0):
            cost, t, node = heapq.heappop(queue)
            while node < inner:
                m = margins[t, node]
                right = m > 0
                heapq.heappush(queue, (cost + m * m, t, 2 * node + 1 + (not right)))
                node = 2 * node + 1 + right
            out.append((t, node))
            rows -= sizes[t, node]
        return out


class Best:
    """The ``k`` best rows of each query so far."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.least = np.full(len(queries), -np.inf)
        # Queries, ids, scores, and numbers of rows, which tell rows with one id apart.
        self.held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        self.size = self.rows_before = 0
        self.parts: list[list[np.ndarray]] = []

    def add(self, some: np.ndarray, x: np.ndarray, rows: np.ndarray) -> None:
        """Scores ``rows`` of ``x`` for ``some`` queries and holds those that may be among the best."""
        for at in range(0, len(some), 256):
            q = some[at : at + 256]
            rough = self.queries[q] @ x[rows].T
            # The product may differ from the score in its last digits.
            slack = 1e-9 * np.abs(rough).max(axis=1)
            if len(rows) > self.k:
                kth = np.partition(rough, len(rows) - self.k, axis=1)[:, len(rows) - self.k] - slack
                self.least[q] = np.maximum(self.least[q], kth - slack)
            of, row = np.nonzero(rough >= (self.least[q] - slack)[:, None])
            self.parts.append([q[of], rows[row]])
            self.size += len(of)

    def settle(self, x: np.ndarray, ids: np.ndarray, ended: bool) -> None:
        """Reduces what is held of the piece ``x``; a row that several trees offered counts once."""
        if self.parts:
            query, row = (np.concatenate(c) for c in zip(*self.parts))
            pair = np.unique(query * len(x) + row)
            query, row = pair // len(x), pair % len(x)
            score = np.empty(len(query))
            # One sum per pair, whatever stands beside it: equal vectors score equally.
            for at in range(0, len(query), 1 << 16):
                part = slice(at, at + (1 << 16))
                score[part] = (x[row[part]] * self.queries[query[part]]).sum(axis=1)
            held = [np.concatenate(c) for c in zip(self.held, [query, ids[row], score, row + self.rows_before])]
            order = np.lexsort((held[3], held[1], -held[2], held[0]))
            same = (np.diff(held[0][order]) == 0) & (np.diff(held[3][order]) == 0)
            order = order[np.insert(~same, 0, True)]
            rank = np.arange(len(order)) - np.searchsorted(held[0][order], held[0][order])
            self.held = [c[order[rank < self.k]] for c in held]
            last = order[rank == self.k - 1]
            self.least[held[0][last]] = np.maximum(self.least[held[0][last]], held[2][last])
        self.parts, self.size = [], 0
        self.rows_before += len(x) if ended else 0


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``PIECE``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= PIECE:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _blocks(queries: DataFrame) -> Iterator[DataFrame]:
    """The queries in blocks of at most ``QUERIES`` rows, whose sizes are checked before they are read."""
    blocks = -(-queries.count() // QUERIES) or 1
    while True:
        dealt = queries.withColumn("_block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
        if blocks == 1 or not dealt.groupBy("_block").count().where(f"count > {QUERIES}").count():
            break
        blocks += 1 + blocks // 8
    for block in range(blocks):
        yield dealt.where(F.col("_block") == block).drop("_block")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    share: float = SHARE,
    id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): ``is_query`` is an expression on ``doc_id``, the row's id."""
    rows = stored(usable(vectors, id, embedding), "usable-vectors")
    sample = (
        rows.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(SAMPLE).select("v").toArrow()["v"].to_pylist()
    )
    lengths = Counter(len(v) for v in sample)
    length = min(lengths, key=lambda n: (-lengths[n], n)) if sample else 1
    rows = rows.where(F.size("v") == length)
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    stats = rows.agg(F.max(norm).alias("m"), F.count(F.lit(1)).alias("n")).first()
    longest, n_rows = float(np.sqrt(stats["m"] or 1.0)), stats["n"]
    depth = int(np.clip(np.ceil(np.log2(max(1, n_rows) / LEAF)), LEAST_DEPTH, np.log2(SAMPLE / 16)))

    def extended(x: np.ndarray) -> np.ndarray:
        x = x / longest
        return np.column_stack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))])

    fitted = np.array([v for v in sample if len(v) == length], float).reshape(-1, length)
    forest = Forest(extended(fitted), depth)
    n_probes = int(np.ceil(share * TREES * (1 << depth)))
    sent = rows.sparkSession.sparkContext.broadcast((forest.directions, forest.thresholds))

    def received() -> Forest:
        out = Forest.__new__(Forest)
        out.directions, out.thresholds = sent.value
        out.n_trees, out.depth = TREES, depth
        return out

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = received()
        for batch in batches:
            x = matrix(batch.column("v"))
            leaves = trees.leaves(extended(x)).T if len(x) else np.zeros((0, TREES), np.int64)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * TREES, pa.array(leaves.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("v"), lists], names=["doc_id", "v", "leaves"])

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = received()
        for batch in batches:
            chosen = [
                [t * n_nodes + leaf for t, leaf in trees.probes(np.append(q / np.linalg.norm(q), 0.0), n_probes, sizes, least_rows)]
                for q in matrix(batch.column("v"))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("v"), pa.array(chosen, pa.list_(pa.int64()))], names=["doc_id", "v", "leaves"]
            )

    def searcher(some):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, q, chosen, sizes = some.value
            asked = np.repeat(np.arange(len(q)), sizes)
            order = np.argsort(chosen, kind="stable")
            asked, chosen = asked[order], chosen[order]
            found = Best(q, k + 1)
            for piece in _pieces(batches):
                x, ids = matrix(piece.column("v")), piece.column("doc_id").to_numpy()
                leaves = piece.column("leaves").flatten().to_numpy().reshape(-1, TREES)
                for t in range(TREES):
                    by_leaf = np.argsort(leaves[:, t], kind="stable")
                    numbers, starts = np.unique(leaves[by_leaf, t], return_index=True)
                    for leaf, rows in zip(numbers.tolist(), np.split(by_leaf, starts[1:])):
                        low, high = np.searchsorted(chosen, (t * n_nodes + leaf, t * n_nodes + leaf + 1))
                        if high > low:
                            found.add(asked[low:high], x, rows)
                            if found.size > HELD:
                                found.settle(x, ids, False)
                found.settle(x, ids, True)
            query, ids, score, _ = found.held
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[query]), pa.array(ids), pa.array(score)], names=["query", "vec_id", "score"])

        return search

    n_nodes = 2 << depth
    schema = "doc_id long, v array<double>, leaves array<long>"
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    copies = F.row_number().over(Window.partitionBy("v").orderBy("doc_id"))
    index = rows.withColumn("_copy", copies).where(F.col("_copy") <= k + 1).select("doc_id", "v")
    index = stored(index.mapInArrow(indexed, schema), "forest-leaves")
    # One row for each leaf.
    filled = index.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect()
    sizes = np.zeros((TREES, n_nodes), np.int64)
    for t, leaf, n in filled:
        sizes[t, leaf] = n
    least_rows = TREES * ROWS_PER_RESULT * (k + 1)
    asked = rows.where(is_query).select("doc_id", "v")
    # Equal queries are searched as the one with the smallest id.
    queries = stored(asked.groupBy("v").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "v").mapInArrow(probed, schema), "forest-queries")
    n_tasks = max(LEAST_TASKS, -(-n_rows // PER_TASK))
    found = None
    for block in _blocks(queries):
        held = block.toArrow().combine_chunks()
        chosen = held["leaves"].combine_chunks()
        q = matrix(held["v"].combine_chunks()) if held.num_rows else np.zeros((0, length))
        some = rows.sparkSession.sparkContext.broadcast(
            (held["doc_id"].to_numpy(), q, chosen.flatten().to_numpy(), chosen.value_lengths().to_numpy())
        )
        best = index.repartition(n_tasks).mapInArrow(searcher(some), "query long, vec_id long, score double")
        found = best if found is None else found.unionByName(best)
    each = queries.join(asked.withColumnRenamed("doc_id", "query_id"), "v").select("query_id", F.col("doc_id").alias("query"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k + 1)
    # At most k + 1 rows for each query.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("_at"))
    return (
        top.join(each.distinct(), "query")
        .where("vec_id <> query_id")
        .select("query_id", rank.alias("rank"), "vec_id", "score")
        .where(F.col("rank") <= k)
    )


def op6_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth row of ``embeddings``."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("doc_id") % 20 == 0)
