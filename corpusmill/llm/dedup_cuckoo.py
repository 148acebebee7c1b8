"""Exact dedup with an index of live digests behind cuckoo filters.

The content of a document, A-Z lower-cased, is known by its SHA-256. The index is dealt into partitions by digest. A partition
is a cuckoo filter, 16-bit fingerprints in buckets of four, and the digests themselves, stored by first bucket,
each with the document that stands for it and its number of copies.

* A digest that the filter doesn't hold is new. A hit is verified against the digests stored in its bucket, so a
  fingerprint that two digests share does no harm.
* Of equal contents the document with the largest id is live: a larger one takes the place of the one before.
* A digest is deleted by taking its fingerprint out of the filter and its entry out of the store. It can come back later.
* An insertion that finds no room after ``MOST_KICKS`` moves makes the filter twice as large, from the stored digests.

An index is a written table (digests, and one row per partition with the filter's slots). ``inserted`` and ``deleted`` read one
and write the next, so a lost task only repeats its own partitions. A partition is held by one task at a time and has about
``PER_PARTITION`` digests: an index that outgrows this is dealt into more partitions from its digests. Copies are
pre-aggregated in the task that reads them, so a content that makes up a third of all rows reaches its partition as a
few rows; on the way back its rows are salted.

Defined cases: a null text counts as empty; a null id is the smallest; rows of the same id and text are copies, of which one is
kept; an empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.words import lower_ascii, rows_of, stored
from corpusmill.plans.skew import join_on_counted_key

PER_BUCKET, LEAST_BUCKETS, MOST_KICKS = 4, 64, 500
# Digests of one partition, some 300 bytes each in a task.
PER_PARTITION = 250_000
# Rows that a task pre-aggregates at a time.
TOGETHER = 200_000
_ROW = "digest binary, doc_id long, row long, n long"
_INDEX = f"partition int, {_ROW}, buckets int, slots binary"
_FILTER, _KEY, _INSERT, _DELETE = range(4)


class CuckooIndex:
    """One partition of the index: the filter, and the entries that hits are verified against."""

    def __init__(self, buckets: int = LEAST_BUCKETS, slots: bytes | None = None):
        self.buckets = buckets
        self.slots = array("H", slots if slots is not None else bytes(2 * PER_BUCKET * buckets))
        self.resized = 0
        self.at: dict[int, list[list]] = {}

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint (never 0, which marks a free slot) and both buckets."""
        mark = int.from_bytes(digest[:2], "big") or 1
        first = int.from_bytes(digest[2:8], "big") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x9E3779B1 >> 8) & (self.buckets - 1))

    def _slot_of(self, mark: int, *buckets: int) -> int:
        for b in buckets:
            for slot in range(PER_BUCKET * b, PER_BUCKET * b + PER_BUCKET):
                if self.slots[slot] == mark:
                    return slot
        return -1

    def find(self, digest: bytes) -> list | None:
        """The entry [digest, key, copies] of a live digest."""
        mark, first, second = self._places(digest)
        if self._slot_of(mark, first, second) < 0:
            return None
        return next((e for e in self.at.get(first, ()) if e[0] == digest), None)

    def load(self, digest: bytes, key: tuple, copies: int) -> None:
        """An entry whose fingerprint the filter has."""
        self.at.setdefault(self._places(digest)[1], []).append([digest, key, copies])

    def insert(self, digest: bytes, key: tuple, copies: int = 1) -> None:
        """``key`` stands for the digest if it is the largest so far."""
        entry = self.find(digest)
        if entry is not None:
            entry[1], entry[2] = max(entry[1], key), entry[2] + copies
            return
        self.load(digest, key, copies)
        if not self._put(*self._places(digest)):
            self._resize()

    def delete(self, digest: bytes) -> bool:
        entry = self.find(digest)
        if entry is None:
            return False
        mark, first, second = self._places(digest)
        self.slots[self._slot_of(mark, first, second)] = 0
        self.at[first].remove(entry)
        return True

    def _put(self, mark: int, first: int, second: int) -> bool:
        slot = self._slot_of(0, first, second)
        bucket = second
        for kick in range(MOST_KICKS):
            if slot >= 0:
                self.slots[slot] = mark
                return True
            # The place changes from kick to kick, so moves don't run in a circle.
            out = PER_BUCKET * bucket + (kick + (mark >> 3)) % PER_BUCKET
            mark, self.slots[out] = self.slots[out], mark
            bucket = self._other(bucket, mark)
            slot = self._slot_of(0, bucket)
        return False

    def _resize(self) -> None:
        """The next larger filter that has room for the stored digests."""
        entries = list(self.entries())
        whole = False
        while not whole:
            self.buckets *= 2
            self.resized += 1
            self.slots = array("H", bytes(2 * PER_BUCKET * self.buckets))
            whole = all(self._put(*self._places(e[0])) for e in entries)
        self.at = {}
        for digest, key, copies in entries:
            self.load(digest, key, copies)

    def entries(self) -> Iterator[list]:
        for bucket in self.at.values():
            yield from bucket


@dataclass
class LiveIndex:
    """A written index: its table and the number of its partitions."""

    table: DataFrame
    partitions: int

    def live(self) -> DataFrame:
        """(digest, keep_id, keep_row, n_rows) of every live digest."""
        return self.table.where("slots IS NULL").select(
            "digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("n_rows")
        )


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, digest): what the index needs of a document. Written, so that ``row`` stays what it is."""
    content = F.encode(lower_ascii(F.coalesce("text", F.lit(""))), "UTF-8")
    return stored(
        rows_of(docs, id, text=text).select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2(content, 256)).alias("digest"),
        ),
        "digests",
    )


def _order(doc_id: int | None, row: int) -> tuple:
    return doc_id is not None, doc_id or 0, row


def _fewer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, doc_id, row, n): the largest row of each digest among rows that a task reads together."""

    def merged(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        best: dict[bytes, list] = {}
        for batch in rows:
            for digest, doc_id, row in zip(*(batch[c].to_pylist() for c in ("digest", "doc_id", "row"))):
                key = _order(doc_id, row)
                entry = best.setdefault(digest, [key, doc_id, 0])
                if entry[0] < key:
                    entry[:2] = key, doc_id
                entry[2] += 1
        values = list(best.values())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(best, pa.binary()),
                pa.array([v[1] for v in values], pa.int64()),
                pa.array([v[0][2] for v in values], pa.int64()),
                pa.array([v[2] for v in values], pa.int64()),
            ],
            names=["digest", "doc_id", "row", "n"],
        )

    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + batch.num_rows
        if n >= TOGETHER:
            yield merged(held)
            held, n = [], 0
    if held:
        yield merged(held)


def _applied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by partition and step in, the partitions' next state out."""
    schema = pa.schema(
        [("partition", pa.int32()), ("digest", pa.binary()), ("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()),
         ("buckets", pa.int32()), ("slots", pa.binary())]
    )

    def state(partition: int, index: CuckooIndex) -> Iterator[pa.RecordBatch]:
        rows = [(partition, None, None, None, None, index.buckets, index.slots.tobytes())]
        for digest, (known, doc_id, row), n in index.entries():
            rows.append((partition, digest, doc_id if known else None, row, n, None, None))
            if len(rows) == 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    current, index = None, CuckooIndex()
    for batch in batches:
        names = ("partition", "step", "digest", "doc_id", "row", "n", "buckets", "slots")
        for partition, step, digest, doc_id, row, n, buckets, slots in zip(*(batch[c].to_pylist() for c in names)):
            if partition != current:
                if current is not None:
                    yield from state(current, index)
                current, index = partition, CuckooIndex()
            if step == _INSERT:
                index.insert(digest, _order(doc_id, row), n)
            elif step == _KEY:
                index.load(digest, _order(doc_id, row), n)
            elif step == _DELETE:
                index.delete(digest)
            else:
                index = CuckooIndex(buckets, slots)
    if current is not None:
        yield from state(current, index)


def _partition(partitions: int):
    return F.pmod(F.xxhash64("digest"), F.lit(partitions)).cast("int")


def _next(index: LiveIndex | None, steps: DataFrame, partitions: int) -> LiveIndex:
    """The index after ``steps`` (step, digest, doc_id, row, n)."""
    rows = steps.withColumn("partition", _partition(partitions))
    if index is not None:
        same = index.partitions == partitions
        kept = index.table if same else index.table.where("slots IS NULL").withColumn("partition", _partition(partitions))
        # Digests that come to another partition are inserted into its filter anew.
        step = F.when(F.col("slots").isNotNull(), F.lit(_FILTER)).otherwise(F.lit(_KEY if same else _INSERT))
        rows = rows.unionByName(kept.withColumn("step", step), allowMissingColumns=True)
    else:
        rows = rows.withColumns({"buckets": F.lit(None).cast("int"), "slots": F.lit(None).cast("binary")})
    dealt = rows.repartition("partition").sortWithinPartitions("partition", "step")
    return LiveIndex(stored(dealt.mapInArrow(_applied, _INDEX), "live-digests"), partitions)


def inserted(index: LiveIndex | None, rows: DataFrame) -> LiveIndex:
    """The next index, with the documents of ``digests``; ``None`` begins a new one."""
    few = rows.select("digest", "doc_id", "row").mapInArrow(_fewer, _ROW)
    held = index.live().count() if index is not None else 0
    needed = -(-(held + rows.count()) // PER_PARTITION)
    partitions = max(needed, index.partitions if index is not None else 1)
    return _next(index, few.withColumn("step", F.lit(_INSERT)), partitions)


def deleted(index: LiveIndex, gone: DataFrame) -> LiveIndex:
    """The next index, without the contents of ``gone`` (digest): none of their copies is live any more."""
    none = F.lit(None).cast("long")
    steps = gone.select("digest").distinct().select(
        "digest", none.alias("doc_id"), none.alias("row"), none.alias("n"), F.lit(_DELETE).alias("step")
    )
    return _next(index, steps, index.partitions)


def exact_groups(rows: DataFrame, index: LiveIndex) -> DataFrame:
    """(doc_id, row, digest, keep_id, n_rows, kept) for each row of ``digests`` that went into ``index``.

    Only digests with copies are joined: a row that finds none stands for itself."""
    copies = index.live().where("n_rows > 1")
    found = join_on_counted_key(rows, copies, "digest", "row", "left")
    alone = F.col("keep_row").isNull()
    return found.select(
        "doc_id",
        "row",
        "digest",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n_rows", F.lit(1)).cast("long").alias("n_rows"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"),
    )


def without_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole rows of the live document of each content; repeated rows of one document stay together."""
    rows = digests(docs, id, text)
    live = inserted(None, rows).live().select(F.col("digest").alias("_digest"), F.col("keep_id").alias("_keep_id"))
    content = F.encode(lower_ascii(F.coalesce(F.col(f"`{text}`"), F.lit(""))), "UTF-8")
    same = (F.unhex(F.sha2(content, 256)) == F.col("_digest")) & F.col(f"`{id}`").cast("long").eqNullSafe(F.col("_keep_id"))
    return docs.join(live, same, "left_semi")


def op12_cuckoo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its exact copies."""
    rows = digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return exact_groups(rows, inserted(None, rows)).select(
        "doc_id",
        "keep_id",
        F.col("n_rows").alias("group_size"),
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP12_SQL = """
    SELECT doc_id, max(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
           doc_id = max(doc_id) OVER copies AS kept, text_sha256
    FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
          FROM documents)
    WINDOW copies AS (PARTITION BY text_sha256)
"""
