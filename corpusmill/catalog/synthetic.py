"""Synthetic sequence data generated from the rows of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.tables import table
from corpusmill.operators import synth
from corpusmill.operators.feed import split_test
from corpusmill.session import scratch_path
from corpusmill.streaming.synth import sum_one_stream

LENGTH, VOCAB, SEED, NDIGITS = 8, 16, 1337, 3


def samples(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sample_id")
    )


def joined(df, *columns):
    """Arrays as text, which both engines print alike."""
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), " ") for c in columns})


def sum_one(spark, sf_dir, split="train"):
    return synth.sum_one(samples(spark, sf_dir).distinct(), LENGTH, VOCAB, SEED, split)


def synth_new_samples(spark, sf_dir):
    test, train = sum_one(spark, sf_dir, "test"), sum_one(spark, sf_dir, "train")
    return joined(synth.new_samples_only(test, train), "content", "target")


def stream_synth(spark, sf_dir):
    """The generator over a stream of sample ids, collected by a file sink."""
    output = scratch_path(spark, "stream-synth")
    schema = table(spark, sf_dir, "documents").schema
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents*.parquet")
    ids = source.select(F.col("doc_id").alias("sample_id"))
    query = (
        sum_one_stream(ids, LENGTH, VOCAB, SEED)
        .writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "offsets"))
        .trigger(availableNow=True)
        .start(output)
    )
    query.awaitTermination()
    return joined(spark.read.parquet(output), "content", "target")


def problem_indices(spark, sf_dir):
    idx = F.expr("(l_partkey % 1000) * 1000 + l_suppkey % 1000").alias("idx")
    return table(spark, sf_dir, "lineitem").select(idx).distinct()


def problems(spark, sf_dir):
    return synth.addition_problems(problem_indices(spark, sf_dir), NDIGITS)


def synth_addition(spark, sf_dir):
    examples = synth.addition_examples(problems(spark, sf_dir), NDIGITS)
    return joined(examples.select("idx", "render", "x", "y"), "x", "y")


def addition_render(spark, sf_dir):
    rendered = synth.render(F.col("a"), F.col("b"), F.col("c"), NDIGITS)
    return (
        problems(spark, sf_dir)
        .withColumn("render", rendered)
        .select("idx", "a", "b", "c", "render", synth.humanize(F.col("render"), NDIGITS).alias("equation"))
    )


def equation_lines(spark, sf_dir):
    """Equations between part and supplier numbers: full sums and last digits by line number."""
    text = F.expr(
        "concat(l_partkey, ' + ', l_suppkey, ' = ',"
        " CASE WHEN l_linenumber % 2 = 0 THEN l_partkey + l_suppkey ELSE (l_partkey + l_suppkey) % 10 END)"
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"))


QUERIES = {
    "synth_sum_one": lambda spark, sf_dir: joined(sum_one(spark, sf_dir), "content", "target"),
    "synth_new_samples": synth_new_samples,
    "stream_synth": stream_synth,
    "synth_addition": synth_addition,
    "addition_split": lambda spark, sf_dir: split_test(problem_indices(spark, sf_dir), "idx", SEED),
    "addition_render": addition_render,
    "equation_check": lambda spark, sf_dir: synth.check_equations(equation_lines(spark, sf_dir)),
}


def sum_one_sql(ids: str, split: str = "train") -> str:
    drawn = f"4 + CAST(concat('0x', substr(md5(concat_ws('-', {SEED}, '{split}', sample_id, i)), 1, 8)) AS BIGINT) % {VOCAB - 8}"
    ids_list = f"list_transform(range(1, {LENGTH - 2}), lambda i: {drawn})"
    text = "concat('2 ', array_to_string({0}, ' '), ' 1 0')"
    return f"""SELECT sample_id, {text.format("ids")} AS content,
        {text.format("list_transform(ids, lambda x: x + 1)")} AS target
        FROM (SELECT sample_id, {ids_list} AS ids FROM (SELECT DISTINCT {ids} AS sample_id FROM {{0}}))"""


LINE_ID = "l_orderkey * 10 + l_linenumber"
TRAIN_SQL = sum_one_sql(LINE_ID).format("lineitem")
TEST_SQL = sum_one_sql(LINE_ID, "test").format("lineitem")
INDEX_SQL = "SELECT DISTINCT (l_partkey % 1000) * 1000 + l_suppkey % 1000 AS idx FROM lineitem"
PROBLEMS_SQL = f"""
    SELECT idx, a, b, a + b AS c,
           concat(lpad(CAST(a AS VARCHAR), 3, '0'), lpad(CAST(b AS VARCHAR), 3, '0'),
                  lpad(CAST(a + b AS VARCHAR), 4, '0')) AS render
    FROM (SELECT idx, idx // 1000 AS a, idx % 1000 AS b FROM ({INDEX_SQL}))
"""

ORACLES = {
    "synth_sum_one": TRAIN_SQL,
    "synth_new_samples": f"SELECT * FROM ({TEST_SQL}) WHERE content NOT IN (SELECT content FROM ({TRAIN_SQL}))",
    "stream_synth": sum_one_sql("doc_id").format("documents"),
    "synth_addition": f"""
        SELECT idx, render, array_to_string(string_split(substr(render, 1, 9), ''), ' ') AS x,
               concat('-100 -100 -100 -100 -100 ', array_to_string(string_split(substr(render, 7), ''), ' ')) AS y
        FROM ({PROBLEMS_SQL})""",
    "addition_split": f"""
        WITH p AS ({INDEX_SQL})
        SELECT idx, row_number() OVER (ORDER BY md5(concat_ws('-', {SEED}, idx)), idx)
                    <= least(floor((SELECT count(*) FROM p) * 0.2), 1000) AS is_test
        FROM p""",
    "addition_render": f"""
        SELECT idx, a, b, c, render, concat(a, ' + ', b, ' = ', c) AS equation FROM ({PROBLEMS_SQL})""",
    "equation_check": """
        WITH e AS (
            SELECT l_orderkey, l_linenumber, l_partkey AS a, l_suppkey AS b,
                   CASE WHEN l_linenumber % 2 = 0 THEN l_partkey + l_suppkey
                        ELSE (l_partkey + l_suppkey) % 10 END AS c
            FROM lineitem)
        SELECT l_orderkey, l_linenumber, concat(a, ' + ', b, ' = ', c) AS text, a, b, c,
               a + b = c AS holds, (a + b) % 10 = c AS holds_mod10
        FROM e""",
}
