"""Record files written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.feeding import document_sizes
from corpusmill.catalog.synthetic import LENGTH, SEED, TRAIN_SQL, VOCAB, joined, sum_one
from corpusmill.catalog.tables import table
from corpusmill.catalog.tokens import EXAMPLES_SQL, ascii_texts, encoded_examples
from corpusmill.operators import records
from corpusmill.operators.shards import size_shards, with_shard
from corpusmill.session import cut_lineage, scratch_path
from corpusmill.sources.sidecar import read_sidecar, write_sidecar
from corpusmill.sources.tfrecord import placed_by_shard

FILE_BYTES = 300_000


def examples_through_records(compression):
    """Encoded documents to size-bounded record files and back."""

    def query(spark, sf_dir):
        location = scratch_path(spark, "records")
        plan = cut_lineage(size_shards(document_sizes(spark, sf_dir), ["doc_id"], "bytes", FILE_BYTES))
        total = plan.agg(F.max("shard") + 1).first()[0]
        # Texts are moved to the files' tasks, their ids are made there.
        texts = with_shard(ascii_texts(table(spark, sf_dir, "documents").select("doc_id", "text")), plan, "doc_id")
        encoded = encoded_examples(spark, sf_dir, placed_by_shard(texts, "shard", total or 0, ["doc_id"]))
        rows = encoded.withColumnRenamed("text", "content")
        records.write_examples(rows, location, total or 0, compression=compression, placed=True)
        back = records.read_examples(spark, location)
        return joined(
            back.select("content", F.col("id").cast("string").alias("id"), "targets", "offset_start", "offset_end"),
            "targets", "offset_start", "offset_end",
        )

    return query


def seq2seq_roundtrip(spark, sf_dir):
    location = scratch_path(spark, "seq2seq")
    records.write_seq2seq(sum_one(spark, sf_dir), location)
    return joined(records.read_seq2seq(spark, location), "content", "target")


def sidecar_roundtrip(spark, sf_dir):
    """The description of the synthetic data set."""
    location = scratch_path(spark, "dataset")
    n = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    info = n.agg(F.count(F.lit(1)).alias("n_samples")).select(
        F.lit("sum_one").alias("kind"),
        F.lit(LENGTH).cast("bigint").alias("max_sequence_length"),
        F.lit(VOCAB).cast("bigint").alias("vocab_size"),
        F.lit(SEED).cast("bigint").alias("seed"),
        "n_samples",
    )
    write_sidecar(info, location)
    return read_sidecar(spark, location).select(*info.columns)


QUERIES = {
    "records_roundtrip": examples_through_records("lz"),
    "records_roundtrip_gzip": examples_through_records("gz"),
    "records_roundtrip_plain": examples_through_records("none"),
    "seq2seq_roundtrip": seq2seq_roundtrip,
    "sidecar_roundtrip": sidecar_roundtrip,
}

BACK_SQL = f"""
    SELECT content, id, target AS targets, offset_start, offset_end
    FROM ({EXAMPLES_SQL.replace("/*more*/", ", any_value(text) AS content")})
"""
ORACLES = {
    "records_roundtrip": BACK_SQL,
    "records_roundtrip_gzip": BACK_SQL,
    "records_roundtrip_plain": BACK_SQL,
    "seq2seq_roundtrip": f"SELECT content, target FROM ({TRAIN_SQL})",
    "sidecar_roundtrip": f"""
        SELECT 'sum_one' AS kind, CAST({LENGTH} AS BIGINT) AS max_sequence_length, CAST({VOCAB} AS BIGINT) AS vocab_size,
               CAST({SEED} AS BIGINT) AS seed, count(*) AS n_samples
        FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
}
