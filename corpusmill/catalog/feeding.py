"""Feed, sampling and shard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.synthetic import joined
from corpusmill.catalog.tables import PATH_SQL, SEQUENCES_SQL, sequences, table
from corpusmill.operators import feed, shards
from corpusmill.operators.records import checked_fixed
from corpusmill.plans.ordinal import with_running

KEYS = ["conv_id", "turn"]
PAD_LENGTH, PACK_LENGTH, BATCH, EPOCHS, SEED, TAKE, BUFFER = 16, 64, 8, 3, 1337, 100, 50
SHARD_BYTES, FILES_PER_CHUNK, CYCLE = 100_000, 7, 4


def pack_sequences(spark, sf_dir):
    examples = feed.with_eos(sequences(spark, sf_dir))
    return joined(feed.pack_rows(examples, KEYS, PACK_LENGTH), "targets", "segmentation", "position")


def batch(drop_remainder):
    def query(spark, sf_dir):
        padded = feed.pad_rows(sequences(spark, sf_dir), PAD_LENGTH)
        rows = feed.batches(padded, KEYS, BATCH, ["target"], drop_remainder)
        flat = F.flatten(F.transform("examples", lambda e: e["target"]))
        return joined(rows.select("batch", "n_examples", flat.alias("ids")), "ids")

    return query


def shuffle_seeded(spark, sf_dir):
    """Where each example stands in the shuffled order of each epoch."""
    repeated = feed.repeat(sequences(spark, sf_dir).select(*KEYS), EPOCHS)
    order = feed.shuffled(repeated, SEED, ["epoch", *KEYS])
    return with_running(order, ["epoch", "shuffle_key"]).withColumnRenamed("_ordinal", "position")


def sample_replace(spark, sf_dir):
    """One document drawn, with replacement, for each labelled row."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    draws = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("draw"))
    return feed.sample_with_replacement(documents, ["doc_id"], draws, SEED)


def interleave(spark, sf_dir):
    return feed.interleaved(table(spark, sf_dir, "documents"), "source", ["doc_id"], CYCLE)


def interleave_slots(spark, sf_dir):
    return feed.interleaved_slots(table(spark, sf_dir, "documents"), "source", ["doc_id"], CYCLE)


def shuffle_buffer(spark, sf_dir):
    return feed.buffer_shuffled(sequences(spark, sf_dir), KEYS, BUFFER, SEED)


def document_sizes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"))


def size_shards(spark, sf_dir):
    return shards.size_shards(document_sizes(spark, sf_dir), ["doc_id"], "bytes", SHARD_BYTES)


def shard_files(spark, sf_dir):
    """The record files of the plan: name, number of documents, bytes."""
    sizes = document_sizes(spark, sf_dir)
    per_shard = (
        sizes.join(shards.size_shards(sizes, ["doc_id"], "bytes", SHARD_BYTES), "doc_id")
        .groupBy("shard")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    )
    total = per_shard.agg(F.count(F.lit(1))).scalar()
    return per_shard.select(shards.shard_file_name(F.col("shard"), total).alias("name"), "files", "bytes")


def compression_guard(spark, sf_dir):
    """Each source as a set of record files: all, some or none of them compressed."""
    path = F.expr(
        "concat('/', source, '/', doc_id, CASE source WHEN 'src0' THEN '.tfrecord' WHEN 'src1' THEN"
        " CASE WHEN lang = 'en' THEN '.tfrecord.gz' ELSE '.tfrecord' END ELSE '.tfrecord.gz' END)"
    )
    listed = table(spark, sf_dir, "documents").select("source", path.alias("path"))
    ends = F.col("path").endswith("gz")
    # The whole listing, and the sources one by one (the same aggregate, grouped).
    grouped = listed.groupBy("source").agg(F.bool_or(ends).alias("any_gz"), F.bool_and(ends).alias("all_gz"))
    whole = shards.compression_of(listed).select(F.lit("all").alias("files"), "compression")
    return whole.unionByName(
        grouped.select(
            F.col("source").alias("files"),
            F.expr("CASE WHEN all_gz THEN 'GZIP' WHEN any_gz THEN 'INVALID' ELSE 'NONE' END").alias("compression"),
        )
    )


def fixed_len_check(spark, sf_dir):
    """Fixed-length rows of six numbers per order line; the check passes them on."""
    tokens = F.expr(
        "array(l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint), cast(l_quantity as bigint), 0L)"
    )
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", tokens.alias("tokens"), F.reverse(tokens).alias("idx")
    )
    return joined(checked_fixed(rows, 2), "tokens", "idx")


QUERIES = {
    "append_eos": lambda spark, sf_dir: joined(feed.with_eos(sequences(spark, sf_dir)), "target"),
    "trim_pad": lambda spark, sf_dir: joined(feed.pad_rows(sequences(spark, sf_dir), PAD_LENGTH), "target"),
    "pack_sequences": pack_sequences,
    "batch_keep": batch(False),
    "batch_drop": batch(True),
    "repeat_epochs": lambda spark, sf_dir: joined(feed.repeat(sequences(spark, sf_dir), EPOCHS), "target"),
    "shuffle_seeded": shuffle_seeded,
    "take_n": lambda spark, sf_dir: joined(feed.take(sequences(spark, sf_dir), KEYS, TAKE), "target"),
    "sample_replace": sample_replace,
    "interleave": interleave,
    "interleave_slots": interleave_slots,
    "shuffle_buffer": shuffle_buffer,
    "count_chunks": lambda spark, sf_dir: shards.count_chunks(
        table(spark, sf_dir, "documents"), ["doc_id"], FILES_PER_CHUNK
    ),
    "size_shards": size_shards,
    "shard_files": shard_files,
    "compression_guard": compression_guard,
    "fixed_len_check": fixed_len_check,
}

JOINED = "array_to_string({0}, ' ')"
PADDED_SQL = f"""
    SELECT conv_id, turn, list_slice(list_concat(target, list_transform(range({PAD_LENGTH}), lambda x: 0)), 1, {PAD_LENGTH})
           AS target
    FROM ({SEQUENCES_SQL})
"""
BATCH_SQL = f"""
    WITH n AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS o FROM ({PADDED_SQL})),
    b AS (SELECT o // {BATCH} AS batch, count(*) AS n_examples, flatten(list(target ORDER BY o)) AS ids
          FROM n GROUP BY o // {BATCH})
    SELECT batch, n_examples, {JOINED.format("ids")} AS ids FROM b
"""
# The single-task folds, as recursive queries.
PACK_SQL = f"""
    WITH RECURSIVE s AS (
        SELECT row_number() OVER (ORDER BY conv_id, turn) AS o,
               list_slice(list_append(target, 1), 1, {PACK_LENGTH}) AS ids
        FROM ({SEQUENCES_SQL})),
    f AS (
        SELECT o, ids, CAST(0 AS BIGINT) AS row_no, CAST(1 AS BIGINT) AS segment, len(ids) AS used FROM s WHERE o = 1
        UNION ALL
        SELECT s.o, s.ids,
               CASE WHEN f.used + len(s.ids) > {PACK_LENGTH} THEN f.row_no + 1 ELSE f.row_no END,
               CASE WHEN f.used + len(s.ids) > {PACK_LENGTH} THEN 1 ELSE f.segment + 1 END,
               CASE WHEN f.used + len(s.ids) > {PACK_LENGTH} THEN len(s.ids) ELSE f.used + len(s.ids) END
        FROM f JOIN s ON s.o = f.o + 1),
    r AS (
        SELECT row_no, flatten(list(ids ORDER BY o)) AS t,
               flatten(list(list_transform(ids, lambda x: segment) ORDER BY o)) AS s,
               flatten(list(range(len(ids)) ORDER BY o)) AS p
        FROM f GROUP BY row_no),
    z AS (SELECT *, list_transform(range({PACK_LENGTH} - len(t)), lambda x: 0) AS z FROM r)
    SELECT row_no, {JOINED.format("list_concat(t, z)")} AS targets, {JOINED.format("list_concat(s, z)")} AS segmentation,
           {JOINED.format("list_concat(p, z)")} AS position
    FROM z
"""
SHARDS_CTE = f"""
    d AS (SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, row_number() OVER (ORDER BY doc_id) AS o FROM documents),
    f AS (
        SELECT o, doc_id, bytes, CAST(0 AS BIGINT) AS shard, bytes AS held FROM d WHERE o = 1
        UNION ALL
        SELECT d.o, d.doc_id, d.bytes, CASE WHEN f.held >= {SHARD_BYTES} THEN f.shard + 1 ELSE f.shard END,
               CASE WHEN f.held >= {SHARD_BYTES} THEN d.bytes ELSE f.held + d.bytes END
        FROM f JOIN d ON d.o = f.o + 1)
"""
GUARD = "CASE WHEN bool_and(path LIKE '%gz') THEN 'GZIP' WHEN bool_or(path LIKE '%gz') THEN 'INVALID' ELSE 'NONE' END"

ORACLES = {
    "append_eos": f"SELECT conv_id, turn, {JOINED.format('list_append(target, 1)')} AS target FROM ({SEQUENCES_SQL})",
    "trim_pad": f"SELECT conv_id, turn, {JOINED.format('target')} AS target FROM ({PADDED_SQL})",
    "pack_sequences": PACK_SQL,
    "batch_keep": BATCH_SQL,
    "batch_drop": f"SELECT * FROM ({BATCH_SQL}) WHERE n_examples = {BATCH}",
    "repeat_epochs": f"""
        SELECT conv_id, turn, {JOINED.format("target")} AS target, CAST(epoch AS INTEGER) AS epoch
        FROM ({SEQUENCES_SQL}), range({EPOCHS}) e(epoch)""",
    "shuffle_seeded": f"""
        WITH k AS (
            SELECT conv_id, turn, CAST(epoch AS INTEGER) AS epoch,
                   md5(concat_ws('-', {SEED}, epoch, conv_id, turn)) AS shuffle_key
            FROM conversations, range({EPOCHS}) e(epoch))
        SELECT *, row_number() OVER (ORDER BY epoch, shuffle_key) - 1 AS position FROM k""",
    "take_n": f"""
        SELECT conv_id, turn, {JOINED.format("target")} AS target FROM ({SEQUENCES_SQL})
        ORDER BY conv_id, turn LIMIT {TAKE}""",
    "sample_replace": f"""
        WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o FROM documents),
        d AS (SELECT doc_id AS draw,
                     CAST(concat('0x', substr(md5(concat_ws('-', {SEED}, doc_id)), 1, 15)) AS BIGINT)
                     % (SELECT count(*) FROM documents) AS o
              FROM labels)
        SELECT draw, doc_id FROM d JOIN p USING (o)""",
    "interleave": f"""
        SELECT source, doc_id, (dense_rank() OVER (ORDER BY source) - 1) // {CYCLE} AS cycle_no,
               row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS row_in_file,
               dense_rank() OVER (ORDER BY source) - 1 AS file_slot
        FROM documents""",
    "interleave_slots": f"""
        WITH RECURSIVE f AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source) AS o FROM documents GROUP BY source),
        s AS (
            SELECT CAST(0 AS BIGINT) AS o, CAST(NULL AS VARCHAR) AS source, CAST(0 AS BIGINT) AS begin_at, CAST(0 AS BIGINT) AS slot,
                   [{", ".join(["CAST(0 AS BIGINT)"] * CYCLE)}] AS free
            UNION ALL
            SELECT f.o, f.source, list_min(free), CAST(list_position(free, list_min(free)) AS BIGINT) - 1,
                   list_transform(free, lambda x, i: CASE WHEN i = list_position(free, list_min(free)) THEN x + f.n + 1 ELSE x END)
            FROM s JOIN f ON f.o = s.o + 1)
        SELECT source, doc_id, begin_at + row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS turn, CAST(slot AS INTEGER) AS slot
        FROM documents JOIN s USING (source)""",
    "shuffle_buffer": f"""
        WITH p AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS place FROM conversations),
        k AS (
            SELECT *, place + CAST(concat('0x', substr(md5(concat_ws('-', {SEED}, place)), 1, 15)) AS BIGINT) % {BUFFER} AS key FROM p)
        SELECT conv_id, turn, row_number() OVER (ORDER BY key, place) - 1 AS position FROM k""",
    "count_chunks": f"""
        SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // {FILES_PER_CHUNK} AS chunk FROM documents""",
    "size_shards": f"WITH RECURSIVE {SHARDS_CTE} SELECT doc_id, shard FROM f",
    "shard_files": f"""
        WITH RECURSIVE {SHARDS_CTE},
        s AS (SELECT shard, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM f GROUP BY shard)
        SELECT concat('dataset_', lpad(CAST(shard AS VARCHAR), 5, '0'), '_',
                      lpad(CAST((SELECT count(*) FROM s) AS VARCHAR), 5, '0'), '.tfrecord.lz') AS name, files, bytes
        FROM s""",
    "compression_guard": f"""
        WITH l AS (
            SELECT source, concat('/', source, '/', doc_id, CASE source WHEN 'src0' THEN '.tfrecord' WHEN 'src1' THEN
                CASE WHEN lang = 'en' THEN '.tfrecord.gz' ELSE '.tfrecord' END ELSE '.tfrecord.gz' END) AS path
            FROM documents)
        SELECT 'all' AS files, {GUARD} AS compression FROM l
        UNION ALL SELECT source, {GUARD} FROM l GROUP BY source""",
    "fixed_len_check": """
        SELECT l_orderkey, l_linenumber,
               concat_ws(' ', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT), 0) AS tokens,
               concat_ws(' ', 0, CAST(l_quantity AS BIGINT), l_linenumber, l_suppkey, l_partkey, l_orderkey) AS idx
        FROM lineitem""",
}
