"""Metrics, argmax decoding and number queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.synthetic import joined
from corpusmill.catalog.tables import table
from corpusmill.functions.numbers import human_number, round_vocab
from corpusmill.functions.sequences import argmax, decode_answer, encode_query
from corpusmill.operators import evaluate

STEPS, BATCH, POSITIONS, SCORES = 50, 8, 8, 8


def predictions(spark, sf_dir):
    """Quantities predicted from prices; returned lines are masked."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / 1000).alias("prediction"),
        F.when(F.col("l_returnflag") == "R", F.lit(-100.0)).otherwise(F.col("l_quantity")).alias("label"),
    )


def eval_metrics(spark, sf_dir):
    return evaluate.metrics(predictions(spark, sf_dir)).withColumn("value", F.round("value", 4))


def argmax_decode(spark, sf_dir):
    """Each vector as the scores of eight positions."""
    rows = F.transform(
        F.sequence(F.lit(0), F.lit(POSITIONS - 1)), lambda i: F.slice("embedding", i * SCORES + 1, F.lit(SCORES))
    )
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", argmax(F.col("embedding")).alias("best"), decode_answer(rows).alias("answer")
    )


def shift_encode(spark, sf_dir):
    text = F.expr("concat_ws(' ', l_linenumber, cast(l_quantity as int), l_suppkey, l_partkey, l_linenumber, l_suppkey)")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("query"))
    return joined(rows.withColumn("ids", encode_query(F.col("query"))), "ids")


def vocab_round(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", round_vocab(F.col("n_chars")).alias("rounded"))


def number_format(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    types = {f.name: f.dataType for f in orders.schema.fields}
    return orders.select(
        "o_orderkey",
        human_number(F.col("o_custkey") * 1000, types["o_custkey"]).alias("customer"),
        human_number(F.col("o_totalprice"), types["o_totalprice"]).alias("price"),
    )


QUERIES = {
    "eval_metrics": eval_metrics,
    "argmax_decode": argmax_decode,
    "shift_encode": shift_encode,
    "vocab_round": vocab_round,
    "number_format": number_format,
    "length_check": lambda spark, sf_dir: evaluate.length_check(table(spark, sf_dir, "conversations"), STEPS, BATCH),
}

ORACLES = {
    "eval_metrics": """
        WITH p AS (
            SELECT l_extendedprice / 1000 AS p, CASE WHEN l_returnflag = 'R' THEN -100.0 ELSE l_quantity END AS y
            FROM lineitem),
        m AS (SELECT avg((y - p) * (y - p)) AS a, avg(p) AS b,
                     avg((y - p) * (y - p)) FILTER (WHERE y <> -100) AS c, avg(p) FILTER (WHERE y <> -100) AS d FROM p)
        SELECT 'mean_squared_error' AS name, round(a, 4) AS value FROM m
        UNION ALL SELECT 'mean_prediction', round(b, 4) FROM m
        UNION ALL SELECT 'masked_mean_squared_error', round(c, 4) FROM m
        UNION ALL SELECT 'masked_mean_prediction', round(d, 4) FROM m""",
    "argmax_decode": f"""
        WITH e AS (
            SELECT vec_id, embedding, list_transform(range({POSITIONS}), lambda i:
                       list_slice(embedding, i * {SCORES} + 1, i * {SCORES} + {SCORES})) AS rows_
            FROM embeddings),
        b AS (SELECT vec_id, embedding, list_transform(rows_, lambda r: list_position(r, list_max(r)) - 4) AS ids FROM e)
        SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best,
               coalesce(array_to_string(list_filter(ids, lambda x: x > 0), ' '), '') AS answer
        FROM b""",
    "shift_encode": """
        SELECT l_orderkey, l_linenumber,
               concat_ws(' ', l_linenumber, CAST(l_quantity AS INTEGER), l_suppkey, l_partkey, l_linenumber, l_suppkey) AS query,
               concat_ws(' ', 2, l_linenumber + 3, CAST(l_quantity AS INTEGER) + 3, l_suppkey + 3, l_partkey + 3,
                         l_linenumber + 3, l_suppkey + 3, 1) AS ids
        FROM lineitem""",
    "vocab_round": "SELECT doc_id, CAST(ceil(n_chars / 128) * 128 AS BIGINT) AS rounded FROM documents",
    "number_format": """
        SELECT o_orderkey, format('{:,}', o_custkey * 1000) AS customer, format('{:,.2f}', o_totalprice) AS price
        FROM orders""",
    "length_check": f"""
        SELECT CAST({STEPS} AS BIGINT) AS expected_steps, least(count(*) // {BATCH}, {STEPS}) AS steps_done,
               count(*) // {BATCH} >= {STEPS} AS lasts
        FROM conversations""",
}
