"""Record files as a Spark data source: ``spark.read.format("tfrecord")`` and
``df.write.format("tfrecord")``.

A file is a sequence of length-prefixed, checksummed Example messages, optionally gzip- or
zlib-compressed as a whole. Columns are integer lists (BIGINT or ARRAY<BIGINT>) and byte strings (STRING or
BINARY). One task reads one file in batches; the shard planner keeps files at a bounded size. A task writes
one file per shard it holds and never more than a batch in memory; files appear under their final names
only when the whole job commits, so a lost executor leaves nothing behind.
"""

from __future__ import annotations

import fnmatch
import gzip
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from corpusmill.functions.crc32c import masked_crc32c
from corpusmill.sources.filesystem import filesystem_of

# File suffixes by compression; field tags of the Example message.
GZIP_SUFFIXES = (".gz", ".gzip")
ZLIB_SUFFIXES = (".lz", ".zlib")
RECORD_SUFFIXES = {"none": "tfrecord", "gz": "tfrecord.gz", "gzip": "tfrecord.gz",
                   "lz": "tfrecord.lz", "zlib": "tfrecord.lz"}
FIRST_FIELD, SECOND_FIELD, THIRD_FIELD = b"\x0a", b"\x12", b"\x1a"

# Payload that a task decodes at a time, Arrow data that it encodes at a time, and bytes that it reads at a time: messages
# take many times the room of their varints.
_BATCH_BYTES, _ENCODED_BYTES = 1 << 20, 4 << 20
_READ_BYTES = 1 << 20


class TFRecordDataSource(DataSource):
    """Options: ``path`` (file, folder or glob; several separated by commas), and for writing
    ``compression`` (none, gz, gzip, lz, zlib; default lz), ``name`` (file prefix), ``shard`` (column that
    numbers the files) and ``total`` (number of shards, part of the file names)."""

    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> StructType:
        raise ValueError("record files carry no schema; give one with .schema(...)")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TFRecordDataSource)


def list_files(location: str) -> list[str]:
    """Data files of comma-separated files, folders or globs; an error when there are none."""
    found: list[str] = []
    for part in location.split(","):
        filesystem, path = filesystem_of(part.strip())
        folder, _, pattern = path.rpartition("/")
        if "*" in path or "?" in path:
            infos = filesystem.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            infos = [i for i in infos if fnmatch.fnmatch(i.base_name, pattern)]
        else:
            info = filesystem.get_file_info(path)
            is_folder = info.type == fs.FileType.Directory
            infos = filesystem.get_file_info(fs.FileSelector(path)) if is_folder else [info]
        uri = part.strip()
        scheme = uri[: len(uri) - len(path)] if "://" in uri else ""
        found += [
            scheme + i.path
            for i in sorted(infos, key=lambda i: i.path)
            if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))
        ]
    if not found:
        raise ValueError(f"there are no record files at {location}")
    return found


@dataclass
class _File(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.location = schema, options["path"]

    def partitions(self) -> list[InputPartition]:
        return [_File(path) for path in list_files(self.location)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        filesystem, path = filesystem_of(partition.path)
        with filesystem.open_input_stream(path, compression=None, buffer_size=_READ_BYTES) as raw:
            for records in _batched(_records(_decompressed(raw, path))):
                yield decode_examples(records, self.schema)


def _decompressed(raw, path: str):
    """A function ``read(n)`` over the plain bytes."""
    if path.endswith(GZIP_SUFFIXES):
        return gzip.GzipFile(fileobj=raw).read
    if not path.endswith(ZLIB_SUFFIXES):
        return raw.read
    inflater, pending = zlib.decompressobj(), bytearray()

    def read(n: int) -> bytes:
        while len(pending) < n and (piece := raw.read(_READ_BYTES)):
            pending.extend(inflater.decompress(piece))
        out = bytes(pending[:n])
        del pending[:n]
        return out

    return read


def _records(read) -> Iterator[tuple[bytes, int, bytes, int]]:
    while header := read(12):
        if len(header) < 12:
            raise ValueError("truncated record file")
        size, header_crc = struct.unpack("<QI", header)
        body = read(size + 4)
        if len(body) < size + 4:
            raise ValueError("truncated record file")
        yield header[:8], header_crc, body[:size], struct.unpack("<I", body[size:])[0]


def _batched(records) -> Iterator[list[bytes]]:
    """Payloads in batches of bounded size, checksums verified."""
    held: list[tuple] = []
    size = 0
    for record in records:
        held.append(record)
        size += len(record[2])
        if size >= _BATCH_BYTES:
            yield _verified(held)
            held, size = [], 0
    if held:
        yield _verified(held)


def _verified(held: list[tuple]) -> list[bytes]:
    heads, head_crcs, payloads, crcs = zip(*held)
    if (masked_crc32c(list(heads)) != np.array(head_crcs, np.uint32)).any() or (
        masked_crc32c(list(payloads)) != np.array(crcs, np.uint32)
    ).any():
        raise ValueError("corrupt record: checksum does not match")
    return list(payloads)


@dataclass
class _Written(WriterCommitMessage):
    files: list


class _Writer(DataSourceArrowWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.location = options["path"].rstrip("/")
        self.compression = options.get("compression", "lz")
        if self.compression not in RECORD_SUFFIXES:
            raise ValueError(f"compression must be one of {', '.join(RECORD_SUFFIXES)}")
        self.prefix = options.get("name", "dataset")
        self.shard = options.get("shard")
        self.total = int(options.get("total", 0))
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex
        if self.shard and not self.total:
            raise ValueError("the option total is required with shard")
        if not overwrite:
            filesystem, path = filesystem_of(self.location)
            if filesystem.get_file_info(path).type != fs.FileType.NotFound and filesystem.get_file_info(
                fs.FileSelector(path)
            ):
                raise ValueError(f"output folder is not empty: {self.location}")

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        filesystem, folder = filesystem_of(self.location)
        staging = f"{folder}/_staging-{self.job}"
        filesystem.create_dir(staging)
        suffix, task = RECORD_SUFFIXES[self.compression], TaskContext.get().partitionId()
        files, out, current = [], None, None
        for batch in batches:
            for shard, rows in self._by_shard(batch):
                if out is None or shard != current:
                    if out is not None:
                        out.close()
                    final = f"{self.prefix}_%05d_%05d.{suffix}" % (
                        (task, self.total) if shard is None else (shard, self.total)
                    )
                    if any(name == final for _, name in files):
                        raise ValueError(f"sort by {self.shard} within partitions before writing")
                    staged = f"{staging}/{uuid.uuid4().hex}"
                    files.append((staged, final))
                    out, current = _Compressed(filesystem.open_output_stream(staged, compression=None), self.compression), shard
                for some in _in_pieces(rows):
                    out.write(frame_records(encode_examples(some)))
        if out is not None:
            out.close()
        return _Written(files)

    def _by_shard(self, batch: pa.RecordBatch):
        if not self.shard:
            return [(None, batch)] if batch.num_rows else []
        at = batch.schema.get_field_index(self.shard)
        shards = batch.column(at).to_numpy(zero_copy_only=False)
        payload = batch.remove_column(at)
        cuts = np.flatnonzero(np.diff(shards)) + 1
        bounds = [0, *cuts.tolist(), len(shards)]
        return [(int(shards[a]), payload.slice(a, b - a)) for a, b in zip(bounds, bounds[1:]) if b > a]

    def commit(self, messages: list) -> None:
        filesystem, folder = filesystem_of(self.location)
        filesystem.create_dir(folder)
        if self.overwrite:
            for info in filesystem.get_file_info(fs.FileSelector(folder)):
                if info.type == fs.FileType.File:
                    filesystem.delete_file(info.path)
        for message in messages:
            for staged, final in message.files if message else []:
                filesystem.move(staged, f"{folder}/{final}")
        self._clear(filesystem, folder)

    def abort(self, messages: list) -> None:
        self._clear(*filesystem_of(self.location))

    def _clear(self, filesystem: fs.FileSystem, folder: str) -> None:
        staging = f"{folder}/_staging-{self.job}"
        if filesystem.get_file_info(staging).type != fs.FileType.NotFound:
            filesystem.delete_dir(staging)


def _in_pieces(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Halves of halves of the rows, in order, until each is one row or small."""
    if rows.num_rows <= 1 or rows.get_total_buffer_size() <= _ENCODED_BYTES or rows.nbytes <= _ENCODED_BYTES:
        yield rows
        return
    half = rows.num_rows // 2
    yield from _in_pieces(rows.slice(0, half))
    yield from _in_pieces(rows.slice(half))


class _Compressed:
    def __init__(self, raw, compression: str):
        self.raw = raw
        self.gzip = gzip.GzipFile(fileobj=raw, mode="wb", mtime=0) if compression in ("gz", "gzip") else None
        self.zlib = zlib.compressobj() if compression in ("lz", "zlib") else None

    def write(self, data: bytes) -> None:
        if self.gzip:
            self.gzip.write(data)
        else:
            self.raw.write(self.zlib.compress(data) if self.zlib else data)

    def close(self) -> None:
        if self.gzip:
            self.gzip.close()
        if self.zlib:
            self.raw.write(self.zlib.flush())
        self.raw.close()


def frame_records(payloads: list[bytes]) -> bytes:
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    parts = []
    for head, head_crc, payload, crc in zip(heads, masked_crc32c(heads), payloads, masked_crc32c(payloads)):
        parts += [head, head_crc.tobytes(), payload, crc.tobytes()]
    return b"".join(parts)


def _varints(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All values as varints in one string, and the number of bytes of each."""
    rest = values.astype(np.int64).view(np.uint64)
    widest = max(1, -(-int(rest.max(initial=0)).bit_length() // 7))
    columns = np.empty((len(rest), widest), np.uint8)
    sizes = np.ones(len(rest), np.int64)
    for k in range(widest):
        columns[:, k] = rest & np.uint64(0x7F)
        rest = rest >> np.uint64(7)
        more = rest > 0
        columns[more, k] |= 0x80
        sizes += more
    used = np.arange(widest) < sizes[:, None]
    return columns[used].tobytes(), sizes


def _with_lengths(parts: list[bytes], tag: bytes) -> list[bytes]:
    """Each part as a length-delimited field."""
    data, sizes = _varints(np.fromiter(map(len, parts), np.int64, len(parts)))
    ends = np.cumsum(sizes).tolist()
    return [tag + data[a:b] + part for a, b, part in zip([0, *ends], ends, parts)]


def encode_examples(batch: pa.RecordBatch) -> list[bytes]:
    """One Example message per row."""
    features: list[list[bytes]] = []
    for name, column in zip(batch.schema.names, batch.columns):
        if pa.types.is_integer(column.type) or pa.types.is_list(column.type):
            lists = _with_lengths(_packed_lists(column), FIRST_FIELD)
            # An empty list is a message without a field.
            values = _with_lengths([b"" if x == FIRST_FIELD + b"\0" else x for x in lists], THIRD_FIELD)
        else:
            raw = column.cast(pa.binary()).to_pylist()
            fields = _with_lengths([b or b"" for b in raw], FIRST_FIELD)
            values = _with_lengths([b"" if b is None else f for b, f in zip(raw, fields)], FIRST_FIELD)
        key = _with_lengths([name.encode()], FIRST_FIELD)[0]
        entries = [key + v for v in _with_lengths(values, SECOND_FIELD)]
        features.append(_with_lengths(entries, FIRST_FIELD))
    return _with_lengths([b"".join(row) for row in zip(*features)], FIRST_FIELD)


def _packed_lists(column: pa.Array) -> list[bytes]:
    if pa.types.is_integer(column.type):
        offsets, values = np.arange(len(column) + 1), column.to_numpy(zero_copy_only=False)
    else:
        offsets = column.offsets.to_numpy()
        offsets, values = offsets - offsets[0], column.flatten().to_numpy(zero_copy_only=False)
    data, sizes = _varints(values)
    ends = np.concatenate([[0], np.cumsum(sizes)])[offsets].tolist()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def _fields(data: bytes, at: int, stop: int) -> list[tuple[int, int, int]]:
    """(tag, start, end) of the fields of a message; a varint field spans its own bytes."""
    out = []
    while at < stop:
        tag, begin = data[at], at + 1
        at, size, shift = begin, 0, 0
        while True:
            byte = data[at]
            at += 1
            size |= (byte & 0x7F) << shift
            if byte < 0x80:
                break
            shift += 7
        if tag & 7 == 2:
            begin, at = at, at + size
        elif tag & 7 != 0:
            raise ValueError("unexpected field in record")
        out.append((tag, begin, at))
    return out


def _unpack_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 0x80)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    sizes = ends - starts + 1
    values = (raw[starts] & np.uint8(0x7F)).astype(np.uint64)
    for k in range(1, int(sizes.max(initial=0))):
        longer = np.flatnonzero(sizes > k)
        values[longer] |= (raw[starts[longer] + k] & np.uint8(0x7F)).astype(np.uint64) << np.uint64(7 * k)
    return values.view(np.int64)


def decode_examples(payloads: list[bytes], schema: StructType) -> pa.RecordBatch:
    """Rows of the wanted features; the others are skipped unread. Integer lists are collected as raw
    bytes and unpacked once per column."""
    columns = {f.name.encode(): [[] for _ in payloads] for f in schema.fields}
    for row, data in enumerate(payloads):
        for _, a, b in _fields(data, 0, len(data)):
            for _, c, d in _fields(data, a, b):
                key, value = b"", None
                for tag, e, f in _fields(data, c, d):
                    if tag == FIRST_FIELD[0]:
                        key = data[e:f]
                    else:
                        value = e, f
                if key in columns and value:
                    for _, e, f in _fields(data, *value):
                        columns[key][row] += [data[g:h] for _, g, h in _fields(data, e, f)]
    arrays = [_to_arrow(columns[f.name.encode()], f.dataType, f.name) for f in schema.fields]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _to_arrow(rows: list[list[bytes]], dtype, name: str) -> pa.Array:
    if dtype == LongType() or isinstance(dtype, ArrayType) and dtype.elementType == LongType():
        parts = [b"".join(r) for r in rows]
        data = b"".join(parts)
        values = pa.array(_unpack_varints(data), pa.int64())
        counted = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint8) < 0x80)])
        byte_ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        offsets = counted[np.concatenate([[0], byte_ends])].astype(np.int32)
        if isinstance(dtype, ArrayType):
            return pa.ListArray.from_arrays(offsets, values)
        if (np.diff(offsets) != 1).any():
            raise ValueError(f"column {name} holds one value per record, the file has another number")
        return values
    if any(len(r) > 1 for r in rows):
        raise ValueError(f"column {name} holds one value per record, the file has more")
    single = [r[0] if r else None for r in rows]
    if dtype == StringType():
        return pa.array([None if v is None else v.decode() for v in single], pa.string())
    if dtype == BinaryType():
        return pa.array(single, pa.binary())
    raise ValueError(f"column {name} has an unsupported type {dtype.simpleString()}")


def placed_by_shard(rows: DataFrame, shard: str, total: int, order: list[str]) -> DataFrame:
    """Rows in the order of their files. The shard is the partition: each task writes one file."""
    return rows.repartitionById(max(total, 1), F.col(shard).cast("int")).sortWithinPartitions(shard, *order)


def write_records(
    examples: DataFrame, location: str, shard: str | None = None, total: int = 0, compression: str = "lz",
    name: str = "dataset", mode: str = "append", order: list[str] | None = None, placed: bool = False,
) -> None:
    """Writes one file per shard, its records in ``order``. The plain form writes one file per task.

    ``placed`` examples are written as they stand: what comes from ``placed_by_shard`` row by row, so that texts are shuffled
    and not what is made of them."""
    register(examples.sparkSession)
    if shard and not placed:
        # ``order`` columns only sort; they are not part of the records.
        order = order or []
        examples = placed_by_shard(examples, shard, total, order).drop(*order)
    writer = examples.write.format("tfrecord").mode(mode).option("compression", compression).option("name", name)
    if shard:
        writer = writer.option("shard", shard).option("total", str(total))
    writer.save(location)
