"""Record files: checksums, message encoding, shards, compression, failures."""

import os
import struct
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.functions.crc32c import crc32c, masked_crc32c
from corpusmill.operators import records
from corpusmill.operators.shards import observed_totals
from corpusmill.session import scratch_path
from corpusmill.sources import tfrecord
from corpusmill.sources.tfrecord import list_files, write_records


def slow_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_crc32c():
    # Published check values.
    assert int(crc32c([b"123456789"])[0]) == 0xE3069283
    assert int(crc32c([bytes(32)])[0]) == 0x8A9136AA
    messages = [bytes((i * 7 + n) % 256 for i in range(n)) for n in [0, 1, 3, 4, 5, 8, 9, 31, 64, 65, 1000, 4097]]
    assert [int(c) for c in crc32c(messages)] == [slow_crc32c(m) for m in messages]


ROWS = [
    (0, 0, Decimal(2**64 - 1), "naïve 日本 🙂", [1, 300, 2**62], [0, 1], [1, 5]),
    (1, 0, Decimal(5), "", [], [], []),
    (2, 1, Decimal(2**63), "x" * 5000, list(range(4000)), [0], [5000]),
    (3, 2, Decimal(2**63 - 1), "last", [-1, 0], [7], [8]),
]
def test_rows_are_encoded_in_pieces():
    """Of a batch of 48 MB no more than ``_ENCODED_BYTES`` or one row is encoded at a time, in order."""
    lists = [[i] * 10_000 for i in range(600)] + [[600] * 1_000_000, [601]]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int64()))], names=["target"])
    pieces = list(tfrecord._in_pieces(batch))
    assert all(p.num_rows == 1 or p.nbytes <= tfrecord._ENCODED_BYTES for p in pieces)
    assert pa.Table.from_batches(pieces) == pa.Table.from_batches([batch])
    assert [x for p in pieces for x in tfrecord.encode_examples(p)] == tfrecord.encode_examples(batch)


SCHEMA = "n long, shard long, id decimal(20,0), content string, target array<bigint>, offset_start array<bigint>, offset_end array<bigint>"


@pytest.fixture(scope="module")
def examples(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("compression,suffix", [("none", "tfrecord"), ("gz", "tfrecord.gz"), ("zlib", "tfrecord.lz")])
def test_examples_roundtrip(spark, examples, compression, suffix):
    location = scratch_path(spark, "records").removeprefix("file:")
    records.write_examples(examples, location, 3, compression=compression, order=["n"])
    assert sorted(os.listdir(location)) == [f"dataset_{i:05d}_00003.{suffix}" for i in range(3)]
    got = {r.content: r for r in records.read_examples(spark, location).collect()}
    for _, _, uid, content, target, starts, ends in ROWS:
        r = got[content]
        assert (r.id, r.targets, r.offset_start, r.offset_end) == (uid, target, starts, ends)
    with pytest.raises(Exception, match="not empty"):
        records.write_examples(examples, location, 3)
    records.write_examples(examples.where("shard = 0"), location, 1, compression=compression, mode="overwrite")
    assert sorted(os.listdir(location)) == [f"dataset_00000_00001.{suffix}"]


def test_totals_while_writing(spark, examples):
    counted, totals = observed_totals(examples)
    records.write_examples(counted, scratch_path(spark, "observed"), 3, order=["n"])
    assert totals.get == {"tokens": 4005, "examples": 4}


def test_framing(spark):
    location = scratch_path(spark, "frames").removeprefix("file:")
    write_records(spark.createDataFrame([([1, 2, 300],)], "v array<bigint>").coalesce(1), location, compression="none")
    raw = open(list_files(location)[0], "rb").read()
    size, head_crc = struct.unpack("<QI", raw[:12])
    payload = raw[12 : 12 + size]
    # Example{features{feature{"v": int64_list{1, 2, 300}}}} by hand.
    assert payload == bytes.fromhex("0a0f0a0d0a01761208" + "1a060a040102ac02")
    assert head_crc == int(masked_crc32c([raw[:8]])[0])
    assert struct.unpack("<I", raw[12 + size :])[0] == int(masked_crc32c([payload])[0])


def test_corruption_is_noticed(spark):
    location = scratch_path(spark, "corrupt").removeprefix("file:")
    write_records(spark.createDataFrame([([1, 2, 3],)], "v array<bigint>").coalesce(1), location, compression="none")
    path = list_files(location)[0]
    raw = bytearray(open(path, "rb").read())
    raw[-6] ^= 1
    open(path, "wb").write(bytes(raw))
    with pytest.raises(Exception, match="corrupt record"):
        spark.read.format("tfrecord").schema("v array<bigint>").load(location).collect()


def test_seq2seq_and_fixed(spark):
    pairs = spark.range(8).select(
        F.array_repeat("id", 8).alias("content"), F.array_repeat(F.lit(0).cast("bigint"), 8).alias("target")
    )
    location = scratch_path(spark, "seq2seq")
    records.write_seq2seq(pairs, location)
    back = records.read_seq2seq(spark, location)
    assert back.exceptAll(pairs).isEmpty() and back.count() == 8
    with pytest.raises(Exception, match="no record files"):
        records.read_seq2seq(spark, location + "-missing").collect()

    rows = spark.createDataFrame([([1, 2, 3, 4, 5, 6], [6, 5, 4, 3, 2, 1])], "tokens array<bigint>, idx array<bigint>")
    fixed = scratch_path(spark, "fixed")
    records.write_fixed(rows, fixed, 2)
    assert records.read_fixed(spark, fixed, 2).collect() == rows.collect()
    with pytest.raises(Exception, match="must have 9 ids"):
        records.read_fixed(spark, fixed, 3).collect()


def test_unsorted_shards_are_refused(spark):
    rows = spark.createDataFrame([(0, [1]), (1, [2]), (0, [3])], "shard long, v array<bigint>").coalesce(1)
    with pytest.raises(Exception, match="sort by shard"):
        (rows.write.format("tfrecord").mode("append").option("shard", "shard").option("total", "2")
         .save(scratch_path(spark, "unsorted")))
