"""Jaccard join of shingle sets with signature trees.

1. A task reduces every text to its set of word-shingle hashes. Texts with equal sets are one class.
2. Classes that may be similar are brought together by banded minima of the set's hashes, with as many bands
   of ``BAND_ROWS`` minima as make two sets at the threshold share none with a probability below ``MISS``.
   So this splits the tree's root without losing links in practice. Classes of a band are linked to the
   smallest one of them, never pair by pair, and connected bands form a family.
3. Each family gets a signature tree: its leaves are sets, ordered by size, with a bitmap of their tokens; a node
   holds the OR of its children's bitmaps and their range of sizes. The tree is traversed against itself
   from the root: a pair of nodes is dropped when the largest overlap that any two of their sets can have is
   too small for the threshold, or when everything below it is linked already. Remaining pairs of leaves
   are compared exactly. A family too large for one task is cut into tiles, and pairs of tiles are traversed.
4. Linked classes are joined to components.

Components need no list of all links: within a family only links that join two parts are kept, at most one
less than there are sets.

Defined cases: null and empty texts have an empty set, are linked with nothing and are components of their own;
a text with fewer words than a shingle is one shingle; rows with one id are nodes of their own that share their id;
a null id never becomes a component id unless a component has no other (then it is null); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.components import components, groups_of
from corpusmill.llm.words import rows_of, stored

BAND_ROWS = 3
MISS = 2e-8
# A tile of a family holds about this many shingles.
TILE_SHINGLES = 4_000_000
# (id, class) rows of 40 bytes: up to this many are sent to the tasks, more are joined by shuffle.
MOST_SENT_CLASSES = 1_000_000
FANOUT = 8
_U64 = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15
_SETS = "doc_id long, n_shingles long, node long, bands array<long>"


class WordHashes(dict):
    """64-bit hashes of words; begins anew when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased text's shingles of ``size`` words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, _U64)
    h = np.fromiter(map(hashes.__getitem__, words), _U64, len(words))
    n = max(1, len(h) - size + 1)
    mixed = np.full(n, min(size, len(h)), _U64)
    for i in range(min(size, len(h))):
        mixed = (mixed ^ h[i : i + n]) * _U64(_GOLDEN)
        mixed ^= mixed >> _U64(29)
    mixed.sort()
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def set_node(tokens: np.ndarray) -> int:
    """The class of a set: 64 bits of its content."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def band_count(percent: int) -> int:
    """Bands with which two sets of similarity ``percent`` share none with a probability of MISS at most."""
    return 1 if percent >= 100 else math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** BAND_ROWS))


def band_keys(sets: list[np.ndarray], n_bands: int) -> np.ndarray:
    """(sets, bands) keys of non-empty sets. An odd factor permutes the hashes."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    odd = np.random.default_rng(1234).integers(0, 1 << 63, n_bands * BAND_ROWS, dtype=np.uint64) * _U64(2) + _U64(1)
    out = np.empty((len(sets), n_bands), _U64)
    for band in range(n_bands):
        key = np.full(len(sets), band + 1, _U64)
        for row in range(BAND_ROWS):
            least = np.minimum.reduceat(joined * odd[band * BAND_ROWS + row], starts)
            key = (key ^ least) * _U64(0xC2B2AE3D27D4EB4F)
            key ^= key >> _U64(31)
        out[:, band] = key
    return out.view(np.int64)


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def document_sets(docs: DataFrame, size: int, n_bands: int, id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, node, bands): node and bands are null for an empty set."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, held, at, room = batch.column(0), [], 0, 0
            for i, text in enumerate(_texts(batch.column(1)), 1):
                held.append(shingle_set(text, hashes, size))
                room += len(held[-1])
                if room >= 500_000 or i == batch.num_rows:
                    yield rows(ids.slice(at, i - at), held)
                    held, at, room = [], i, 0

    def rows(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        full = [s for s in sets if len(s)]
        keys = iter(band_keys(full, n_bands).tolist() if full else [])
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_node(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "node", "bands"],
        )

    rows_in = rows_of(docs, id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows_in.mapInArrow(reduce, _SETS)


class SignatureTree:
    """Levels of nodes over sets in the order given: OR of bitmaps, range of sizes, most tokens that share bits."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], np.int64)
        bits = 1 << int(np.clip(np.ceil(np.log2(32 * max(1.0, float(np.median(sizes))))), 8, 16))
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for i, tokens in enumerate(sets):
            flags = np.zeros(bits, np.uint8)
            flags[(tokens & _U64(bits - 1)).astype(np.int64)] = 1
            maps[i] = np.packbits(flags).view(np.uint64)
        shared = sizes - np.bitwise_count(maps).sum(1, dtype=np.int64)
        self.levels = [(maps, sizes, sizes, shared)]
        while len(self.levels[-1][1]) > FANOUT:
            maps, low, high, shared = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(shared, at),
                )
            )

    def possible(self, level: int, u: np.ndarray, v: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs of nodes may hold two sets that link.

        Tokens that two sets share lie in bits that both nodes have; a set has at most ``shared`` more
        tokens than bits."""
        maps, low, high, shared = self.levels[level]
        fits = (100 * high[u] >= percent * low[v]) & (100 * high[v] >= percent * low[u])
        common = np.zeros(len(u), np.int64)
        step = max(1, (1 << 21) // maps.shape[1])
        for at in range(0, len(u), step):
            part = slice(at, at + step)
            common[part] = np.bitwise_count(maps[u[part]] & maps[v[part]]).sum(1, dtype=np.int64)
        overlap = np.minimum(np.minimum(high[u], high[v]), common + np.minimum(shared[u], shared[v]))
        return fits & ((100 + percent) * overlap >= percent * (low[u] + low[v]))

    def children(self, level: int, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of nodes one level below, each pair once."""
        n = len(self.levels[level - 1][1])
        grid = np.arange(FANOUT)
        a = (u[:, None, None] * FANOUT + grid[None, :, None] + 0 * grid).reshape(-1)
        b = (v[:, None, None] * FANOUT + grid[None, None, :] + 0 * grid[:, None]).reshape(-1)
        keep = (a < n) & (b < n) & (a <= b)
        return a[keep], b[keep]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def joined_parts(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect what is connected by all links of similarity ``percent`` or more."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][0]))
    ranked = [sets[i] for i in order]
    parent, links = np.arange(len(ranked)), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def compare(u: np.ndarray, v: np.ndarray) -> None:
        for i, j in zip(u.tolist(), v.tolist()):
            a, b = root(i), root(j)
            if a != b and similar(ranked[i], ranked[j], percent):
                parent[max(a, b)] = min(a, b)
                links.append((order[i], order[j]))

    tree = SignatureTree(ranked)
    maps = tree.levels[0][0]
    if len(ranked) > 2 * FANOUT:
        # What most sets are close to is compared with all first: parts that are linked are skipped later.
        flags = np.unpackbits(maps.view(np.uint8), axis=1)
        center = int(np.argmax(flags @ flags.mean(0, dtype=np.float32) / np.maximum(1, flags.sum(1))))
        rest = np.delete(np.arange(len(ranked)), center)
        low, high = np.minimum(rest, center), np.maximum(rest, center)
        near = tree.possible(0, low, high, percent)
        compare(low[near], high[near])
        del flags
    top = len(tree.levels) - 1
    nodes = np.arange(len(tree.levels[top][1]))
    u, v = (x.reshape(-1) for x in np.meshgrid(nodes, nodes, indexing="ij"))
    stack = [(top, u[u <= v], v[u <= v])]
    while stack:
        level, u, v = stack.pop()
        if len(u) > 4096:
            stack += [(level, u[at : at + 4096], v[at : at + 4096]) for at in range(0, len(u), 4096)]
            continue
        if level == 0:
            u, v = u[u < v], v[u < v]
        if len(links) > 0:
            roots = np.array([root(i) for i in range(len(ranked))]) if level == 0 or len(u) > 64 else None
            if roots is not None:
                span = FANOUT**level
                at = np.arange(0, len(roots), span)
                one, most = np.minimum.reduceat(roots, at), np.maximum.reduceat(roots, at)
                apart = ~((one[u] == most[u]) & (one[v] == most[v]) & (one[u] == one[v]))
                u, v = u[apart], v[apart]
        if len(u) == 0:
            continue
        keep = tree.possible(level, u, v, percent)
        u, v = u[keep], v[keep]
        if level == 0:
            compare(u, v)
        elif len(u):
            stack.append((level - 1, *tree.children(level, u, v)))
    return links


def class_links(wanted: DataFrame, docs: DataFrame, size: int, percent: int, id: str, text: str) -> DataFrame:
    """(a, b) links between classes; ``wanted`` has (rep, node, family, n_tiles)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("node", "family", "n_tiles")}
            found = [shingle_set(t, hashes, size) for t in _texts(batch.column("text"))]
            keep = [i for i, s in enumerate(found) if len(s) and set_node(s) == columns["node"][i]]
            for at in range(0, len(keep), 500):
                part = keep[at : at + 500]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([columns[n][i] for i in part], pa.int64()) for n in ("node", "family", "n_tiles")),
                        pa.array([found[i].tobytes() for i in part], pa.binary()),
                    ],
                    names=["node", "family", "n_tiles", "tokens"],
                )

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["family", "ti", "tj"]):
            nodes, first = np.unique(group["node"].to_numpy(), return_index=True)
            tokens = group["tokens"].take(pa.array(first)).to_pylist()
            found = joined_parts([np.frombuffer(t, _U64) for t in tokens], percent) if len(nodes) > 1 else []
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[list(a)]), pa.array(nodes[list(b)])], names=["a", "b"]
                )

    few = wanted.count() <= MOST_SENT_CLASSES
    rows = rows_of(docs, id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    wide = rows.join(
        F.broadcast(wanted) if few else wanted, F.col("doc_id").eqNullSafe(F.col("rep"))
    ).select("text", "node", "family", "n_tiles")
    tile = F.pmod(F.xxhash64("node"), F.col("n_tiles"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tiles") - 1))
    tiled = (
        wide.mapInArrow(sets, "node long, family long, n_tiles long, tokens binary")
        .withColumn("tile", tile)
        .withColumn("other", other)
        .select("node", "family", "tokens", F.least("tile", "other").alias("ti"), F.greatest("tile", "other").alias("tj"))
    )
    key = ["family", "ti", "tj"]
    return tiled.repartition(*key).sortWithinPartitions(*key).mapInArrow(links, "a long, b long")


def similar_components(
    docs: DataFrame, size: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    ``percent`` is the least Jaccard similarity of a link."""
    rows = stored(document_sets(docs, size, band_count(percent), id, text), "shingle-sets")
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    classes = stored(classes, "set-classes")
    banded = classes.select("node", F.explode("bands").alias("band"))
    leads = banded.groupBy("band").agg(F.min("node").alias("lead"), F.max("node").alias("most")).where("lead < most")
    near = banded.join(leads, "band").where("node <> lead").select("node", "lead").distinct()
    families = components(near, "node", "lead")
    members = classes.join(families, "node").select("node", "rep", "n", F.col("component").alias("family"))
    members = stored(members, "set-families")
    tiles = members.groupBy("family").agg(F.ceil(F.sum("n") / TILE_SHINGLES).alias("n_tiles"))
    wanted = stored(members.join(tiles, "family").select("rep", "node", "family", "n_tiles"), "wanted-sets")
    linked = components(class_links(wanted, docs, size, percent, id, text))
    # Linked classes take the smallest id of all their members, others their own.
    of_class = members.join(linked, "node").select("node", "rep", "component")
    least = of_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_node = of_class.join(least, "component").select("node", "component_id")
    ids = classes.join(of_node, "node", "left").select("node", F.coalesce("component_id", "rep").alias("component_id"))
    full = rows.where("node IS NOT NULL").join(ids, "node").select("doc_id", "n_shingles", "component_id")
    empty = rows.where("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def op4_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all ``documents`` by 3-word shingles at a similarity of 0.9."""
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, percent=90)
