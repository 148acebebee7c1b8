"""Language model and filter, batch and stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.tables import documents, table
from corpusmill.catalog.texts import LINES_SQL
from corpusmill.operators import lang
from corpusmill.operators.units import split_units
from corpusmill.session import scratch_path
from corpusmill.sources.textfiles import write_text
from corpusmill.streaming.lines import filter_stream, kept_lines, line_stream

LANGUAGES = ["de", "en", "es", "fr"]
WANTED = ["en", "fr"]
KEYS = ["doc_id", "unit_no"]


def lines(spark, sf_dir):
    return split_units(documents(spark, sf_dir, "doc_id", "lang", "text"), "line")


def model(spark, sf_dir):
    """The model, written once and read back: it is scored against more than once."""
    path = scratch_path(spark, "languages")
    lang.train_model(lines(spark, sf_dir), LANGUAGES).write.parquet(path)
    return spark.read.parquet(path)


def lang_model(spark, sf_dir):
    weights = [F.col("weights")[i].alias(f"w_{name}") for i, name in enumerate(LANGUAGES)]
    return lang.train_model(lines(spark, sf_dir), LANGUAGES).select("gram", *weights)


def lang_predict(spark, sf_dir):
    scored = lang.score(lines(spark, sf_dir).drop("lang"), model(spark, sf_dir), LANGUAGES, KEYS)
    return scored.withColumn("score", F.round("score", 6))


def lang_predict_by_join(spark, sf_dir):
    """The same scores the way a model of any size gets them."""
    scored = lang.score_by_join(lines(spark, sf_dir).drop("lang"), model(spark, sf_dir), LANGUAGES, KEYS)
    return scored.withColumn("score", F.round("score", 6))


def lang_filter(reverse):
    def query(spark, sf_dir):
        units = lines(spark, sf_dir).drop("lang")
        return lang.filter_units(units, model(spark, sf_dir), LANGUAGES, WANTED, reverse=reverse)

    return query


def stream_lang_filter(spark, sf_dir):
    """The documents as text files, streamed line by line through the filter."""
    folder, output = scratch_path(spark, "lines-in"), scratch_path(spark, "lines-out")
    write_text(table(spark, sf_dir, "documents"), folder)
    stream = filter_stream(
        line_stream(spark, folder), model(spark, sf_dir), LANGUAGES, WANTED, output, scratch_path(spark, "offsets")
    )
    stream.awaitTermination()
    return kept_lines(spark, output)


QUERIES = {
    "lang_model": lang_model,
    "lang_predict": lang_predict,
    "lang_predict_by_join": lang_predict_by_join,
    "lang_filter": lang_filter(False),
    "lang_filter_reverse": lang_filter(True),
    "stream_lang_filter": stream_lang_filter,
}


def _grams(source: str) -> str:
    return f"""SELECT * EXCLUDE (t, i), substr(t, CAST(i AS INTEGER), 3) AS gram
        FROM (SELECT *, unnest(range(1, length(t) - 1)) AS i FROM {source} WHERE length(t) >= 3)"""


def _sums(template: str, glue: str = ", ") -> str:
    return glue.join(template.format(name) for name in LANGUAGES)


STRIPPED = "trim(text, concat(' ', chr(9), chr(10), chr(13)))"
MODEL_SQL = f"""
    pieces AS (SELECT doc_id, lang, {LINES_SQL} AS p FROM documents),
    units AS (
        SELECT doc_id, lang, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS unit_no, unnest(p) AS text FROM pieces),
    stripped AS (SELECT doc_id, unit_no, lang, {STRIPPED} AS t FROM units),
    grams AS ({_grams('stripped')}),
    counted AS (
        SELECT gram, {_sums("count(*) FILTER (WHERE lang = '{0}') AS n_{0}")} FROM grams GROUP BY gram),
    totals AS (SELECT count(*) AS n_grams, {_sums("sum(n_{0}) AS t_{0}")} FROM counted),
    weights AS (
        SELECT gram, {_sums("CAST(round(ln((n_{0} + 1) / (t_{0} + n_grams)) * 1000000) AS BIGINT) AS w_{0}")}
        FROM (SELECT * FROM counted UNION ALL SELECT '', {_sums("0")}), totals)
"""
SCORED_SQL = f"""
    summed AS (
        SELECT doc_id, unit_no, {_sums("CAST(sum(w_{0}) AS BIGINT) AS s_{0}")}
        FROM grams JOIN weights USING (gram) GROUP BY doc_id, unit_no),
    every AS (
        SELECT doc_id, unit_no, text, {_sums("coalesce(s_{0}, 0) AS s_{0}")}
        FROM units LEFT JOIN summed USING (doc_id, unit_no)),
    best AS (SELECT *, greatest({_sums("s_{0}")}) AS b FROM every),
    scored AS (
        SELECT doc_id, unit_no, text,
               CASE {_sums("WHEN s_{0} = b THEN '{0}'", " ")} END AS lang,
               1 / ({_sums("exp((s_{0} - b) / 1000000)", " + ")}) AS score
        FROM best)
"""
KEPT = "lang IN ('en', 'fr') AND score > 0.9"

ORACLES = {
    "lang_model": f"WITH {MODEL_SQL} SELECT gram, {_sums('w_{0}')} FROM weights",
    "lang_predict": f"WITH {MODEL_SQL}, {SCORED_SQL} SELECT doc_id, unit_no, lang, round(score, 6) AS score FROM scored",
    "lang_predict_by_join": f"""
        WITH {MODEL_SQL}, {SCORED_SQL} SELECT doc_id, unit_no, lang, round(score, 6) AS score FROM scored""",
    "lang_filter": f"WITH {MODEL_SQL}, {SCORED_SQL} SELECT doc_id, unit_no, text FROM scored WHERE {KEPT}",
    "lang_filter_reverse": f"""
        WITH {MODEL_SQL}, {SCORED_SQL} SELECT doc_id, unit_no, text FROM scored WHERE NOT ({KEPT})""",
    # A stream line has no terminator, and the text sink ends each document with one.
    "stream_lang_filter": f"""
        WITH {MODEL_SQL.replace("stripped AS (", "streamed AS (SELECT doc_id, generate_subscripts(p, 1) AS unit_no, unnest(p) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)), stripped AS (", 1)},
        stream_grams AS ({_grams(f"(SELECT doc_id, unit_no, {STRIPPED} AS t FROM streamed)")}),
        {SCORED_SQL.replace("FROM grams", "FROM stream_grams").replace("FROM units", "FROM streamed")}
        SELECT text FROM scored WHERE {KEPT}""",
}
