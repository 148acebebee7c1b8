"""Word counts, BPE training, encoding and decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.feeding import SHARDS_CTE, size_shards
from corpusmill.catalog.tables import documents, table
from corpusmill.catalog.synthetic import joined
from corpusmill.catalog.texts import ASCII_SQL
from corpusmill.functions.bytelevel import BYTE_TO_ID, FIRST_MERGE_ID, ID_TO_BYTE, SPECIAL_TOKENS, symbol
from corpusmill.functions.text import collapse_non_ascii
from corpusmill.operators import bpe_encode, bpe_train
from corpusmill.operators.bpe_train import MIN_FREQUENCY
from corpusmill.operators.shards import encode_totals, with_shard
from corpusmill.session import cut_lineage, scratch_path

MERGES = 32
VOCAB_SIZE = FIRST_MERGE_ID + MERGES
# The vocabulary that the reference trains (scripts/train_uds.sh).
WHOLE_VOCAB_SIZE = 1010
LEXICON = ["the", "and", "of", "to", "in", "that", "der", "die", "und", "la", "les", "est", "el", "los"]
_models: dict = {}


def ascii_texts(docs):
    return docs.withColumn("text", collapse_non_ascii(F.col("text")))


def ascii_documents(spark, sf_dir):
    """The cleaned corpus: what cleaning leaves needs no normalisation."""
    return ascii_texts(documents(spark, sf_dir, "doc_id", "text"))


def words(spark, sf_dir):
    return bpe_train.word_counts(ascii_documents(spark, sf_dir), normalize=False)


def model(spark, sf_dir, vocab_size=VOCAB_SIZE):
    """The model of a corpus, trained once per session: several queries encode with it."""
    key = (spark.sparkContext.applicationId, sf_dir, vocab_size)
    if key not in _models:
        _models[key] = bpe_train.train(words(spark, sf_dir), vocab_size)
    return _models[key]


def word_freq(spark, sf_dir):
    return bpe_train.word_counts(documents(spark, sf_dir, "text"), normalize=False)


def bpe_pair_counts(spark, sf_dir):
    """Pair counts before the first merge, with the ids of the pair."""
    counts = bpe_train.pair_counts(bpe_train.initial_symbols(words(spark, sf_dir)))
    code = lambda i: F.ascii(F.substring("pair", i, 1)) - 0x100
    return counts.select(code(1).alias("left_id"), code(2).alias("right_id"), "n")


def bpe_merges(spark, sf_dir):
    trained = bpe_train.train(words(spark, sf_dir), VOCAB_SIZE)
    return trained.merges_table(spark).toDF("rank", "left_id", "right_id", "new_id")


def encode_ids(spark, sf_dir):
    encoded = bpe_encode.encode(ascii_documents(spark, sf_dir), model(spark, sf_dir), normalize=False)
    return joined(encoded.select("doc_id", "target"), "target")


def encoded_examples(spark, sf_dir, texts):
    return bpe_encode.encode_with_offsets(texts, model(spark, sf_dir), normalize=False)


def examples(spark, sf_dir):
    return encoded_examples(spark, sf_dir, ascii_documents(spark, sf_dir))


def encode_offsets(spark, sf_dir):
    columns = ("target", "offset_start", "offset_end")
    return joined(examples(spark, sf_dir).select("doc_id", F.col("id").cast("string").alias("id"), *columns), *columns)


def roundtrip_mismatches(spark, sf_dir):
    """Documents that do not decode to their text: none."""
    trained = model(spark, sf_dir)
    encoded = bpe_encode.encode(ascii_documents(spark, sf_dir), trained, normalize=False)
    return bpe_encode.roundtrip_mismatches(encoded, trained.vocab_table(spark), normalize=False)


def decode_ids(spark, sf_dir):
    trained = model(spark, sf_dir)
    encoded = bpe_encode.encode(ascii_documents(spark, sf_dir), trained, normalize=False)
    return bpe_encode.decode(encoded, trained.vocab_table(spark)).select("doc_id", "decoded")


def totals(spark, sf_dir):
    """The totals of an encode run with a whole vocabulary."""
    trained = model(spark, sf_dir, WHOLE_VOCAB_SIZE)
    encoded = bpe_encode.encode(ascii_documents(spark, sf_dir), trained, normalize=False)
    plan = cut_lineage(size_shards(spark, sf_dir))
    return encode_totals(with_shard(encoded.select("doc_id", "target"), plan, "doc_id"))


def saved_model_differences(spark, sf_dir):
    """Probes (the benchmark items) that a saved and reloaded model encodes differently: none."""
    trained = model(spark, sf_dir)
    location = scratch_path(spark, "tokenizer")
    trained.save(spark, location)
    loaded = bpe_train.load_model(spark, location)
    probes = table(spark, sf_dir, "benchmark")
    before, after = (cut_lineage(bpe_encode.encode(probes, m)) for m in (trained, loaded))
    return before.exceptAll(after).unionByName(after.exceptAll(before)).select("item_id", "text")


def lexicon(spark):
    return spark.createDataFrame([(w,) for w in LEXICON], "word string")


def added_tokens(spark, sf_dir):
    """Occurrences of each added token in the encoded documents."""
    trained = model(spark, sf_dir)
    extended = bpe_train.Model(trained.merges, trained.tokens, LEXICON)
    encoded = bpe_encode.encode(ascii_documents(spark, sf_dir), extended, normalize=False)
    vocab = extended.vocab_table(spark).where("added")
    counts = encoded.select(F.explode("target").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    # The counts are one row per id, so this join is as small as the vocabulary.
    return counts.join(vocab, "id").select(F.col("token").cast("string").alias("word"), "n")


QUERIES = {
    "word_freq": word_freq,
    "bpe_pair_counts": bpe_pair_counts,
    "bpe_merges": bpe_merges,
    "encode_ids": encode_ids,
    "encode_offsets": encode_offsets,
    "decode_ids": decode_ids,
    "roundtrip_mismatches": roundtrip_mismatches,
    "encode_totals": totals,
    "saved_model_differences": saved_model_differences,
    "lexicon_coverage": lambda spark, sf_dir: bpe_encode.added_token_coverage(
        documents(spark, sf_dir, "text"), lexicon(spark)
    ),
    "added_tokens": added_tokens,
}

# RE2 has no look-ahead. A mark in front of the last white space before each word stands in for it.
WS = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
MARK = r"\x{E000}"
PRETOKEN_SQL = (
    rf"''s|''t|''re|''ve|''m|''ll|''d|(?:{MARK} )?\p{{L}}+|(?:{MARK} )?\p{{N}}+"
    rf"|(?:{MARK} )?[^{WS}{MARK}\p{{L}}\p{{N}}]+|{MARK}?[{WS}]+"
)


def words_sql(text: str) -> str:
    """The list of pre-tokens of a text that gets a prefix space."""
    prefixed = f"CASE WHEN {text} = '' OR starts_with({text}, ' ') THEN {text} ELSE concat(' ', {text}) END"
    marked = f"regexp_replace({prefixed}, '([{WS}])([^{WS}])', concat(chr(57344), '\\1\\2'), 'g')"
    return (
        f"list_transform(regexp_extract_all({marked}, '{PRETOKEN_SQL}'), "
        "lambda w: replace(w, chr(57344), ''))"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_PRINTED = [b for b in range(1, 128) if b not in (10, 13)]
TO_SYMBOLS = (
    f"replace(replace(translate(word, concat({', '.join(f'chr({b})' for b in _PRINTED)}), "
    f"{_quoted(''.join(symbol(BYTE_TO_ID[b]) for b in _PRINTED))}), "
    f"chr(10), '{symbol(BYTE_TO_ID[10])}'), chr(13), '{symbol(BYTE_TO_ID[13])}')"
)
CORPUS_SQL = f"""
    corpus AS MATERIALIZED (SELECT doc_id, {ASCII_SQL} AS text FROM documents),
    occurrences AS MATERIALIZED (
        SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word
        FROM (SELECT doc_id, {words_sql('text')} AS ws FROM corpus)),
    w0 AS MATERIALIZED (
        SELECT word, n, {TO_SYMBOLS} AS s FROM (SELECT word, count(*) AS n FROM occurrences GROUP BY word))
"""


def _pairs(stage: int) -> str:
    return f"""SELECT substr(s, CAST(i AS INTEGER), 2) AS pair, sum(n) AS n
        FROM (SELECT s, n, unnest(range(1, length(s))) AS i FROM w{stage} WHERE length(s) > 1) GROUP BY 1"""


def training_sql(merges: int) -> str:
    """One merge per stage: the most frequent pair, and the words after merging it."""
    stages = []
    for k in range(merges):
        stages.append(f"p{k} AS MATERIALIZED (SELECT pair FROM ({_pairs(k)}) ORDER BY n DESC, pair LIMIT 1)")
        stages.append(
            f"w{k + 1} AS MATERIALIZED (SELECT word, n, replace(s, pair, '{symbol(FIRST_MERGE_ID + k)}') AS s FROM w{k}, p{k})"
        )
    return ", ".join([CORPUS_SQL, *stages])


TRAINING = training_sql(MERGES)
IDS = "list_transform(string_split({0}, ''), lambda c: unicode(c) - 256)"
ENCODED_SQL = f"""
    {TRAINING},
    encoded AS MATERIALIZED (
        SELECT doc_id, string_agg(s, '' ORDER BY pos) AS s FROM occurrences JOIN w{MERGES} USING (word) GROUP BY doc_id)
"""
# One merge per round, until the vocabulary is full or every pair rare. One row of a round, without a word, holds the tokens by id: a pair
# that makes the text of a known token gets its symbol.
_FIRST_TOKENS = ", ".join([*["''" for _ in SPECIAL_TOKENS], *[f"chr({b})" if 0 < b < 128 else "''" for b in ID_TO_BYTE]])
WHOLE_TRAINING = f"""
    {CORPUS_SQL},
    rounds(k, word, n, s, tokens) AS (
        SELECT 0, word, CAST(n AS HUGEINT), s, CAST(NULL AS VARCHAR[]) FROM w0
        UNION ALL SELECT 0, NULL, 0, '', [{_FIRST_TOKENS}]
        UNION ALL (
            WITH p AS (
                SELECT pair, sum(n) AS n
                FROM (SELECT substr(s, CAST(i AS INTEGER), 2) AS pair, n
                      FROM (SELECT s, n, unnest(range(1, length(s))) AS i FROM rounds WHERE length(s) > 1))
                GROUP BY pair),
            best AS (SELECT pair FROM p WHERE n >= {MIN_FREQUENCY} ORDER BY n DESC, pair LIMIT 1),
            made AS (
                SELECT pair, tokens, concat(tokens[unicode(pair) - 255], tokens[unicode(substr(pair, 2, 1)) - 255]) AS token
                FROM best, rounds WHERE tokens IS NOT NULL AND len(tokens) < {WHOLE_VOCAB_SIZE}),
            placed AS (SELECT pair, token, coalesce(list_position(tokens, token), len(tokens) + 1) AS place FROM made)
            SELECT k + 1, word, n, replace(s, pair, chr(CAST(255 + place AS INTEGER))),
                   CASE WHEN place > len(tokens) THEN list_append(tokens, token) ELSE tokens END
            FROM rounds, placed)),
    w AS MATERIALIZED (SELECT word, s FROM rounds WHERE word IS NOT NULL AND k = (SELECT max(k) FROM rounds))
"""
TOKEN_TEXT = f"""
    t0 AS (SELECT substr(s, i, 1) AS c, substr(word, i, 1) AS t
           FROM (SELECT word, s, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS i FROM w0) GROUP BY ALL),
    {", ".join(
        f"t{k + 1} AS (SELECT * FROM t{k} UNION ALL SELECT '{symbol(FIRST_MERGE_ID + k)}', concat(a.t, b.t) FROM p{k}, t{k} a, t{k} b WHERE a.c = substr(pair, 1, 1) AND b.c = substr(pair, 2, 1))"
        if k % 8 != 7 else
        f"t{k + 1} AS MATERIALIZED (SELECT * FROM t{k} UNION ALL SELECT '{symbol(FIRST_MERGE_ID + k)}', concat(a.t, b.t) FROM p{k}, t{k} a, t{k} b WHERE a.c = substr(pair, 1, 1) AND b.c = substr(pair, 2, 1))"
        for k in range(MERGES)
    )}
"""
EXAMPLES_SQL = f"""
    WITH {ENCODED_SQL}, {TOKEN_TEXT},
    chars AS (SELECT doc_id, generate_subscripts(cs, 1) AS pos, unnest(cs) AS c
              FROM (SELECT doc_id, string_split(s, '') AS cs FROM encoded WHERE s <> '')),
    spans AS (
        SELECT doc_id, pos, c, t, length(t) - length(ltrim(t, ' ')) AS spaces,
               sum(length(t)) OVER (PARTITION BY doc_id ORDER BY pos) AS e
        FROM chars JOIN t{MERGES} USING (c)),
    placed AS (
        SELECT doc_id, pos, c, t, spaces, starts_with(text, ' ') AND pos = 1 AND spaces = 1 AS opening,
               e - CASE WHEN starts_with(text, ' ') THEN 0 ELSE 1 END AS e
        FROM spans JOIN corpus USING (doc_id)),
    bounds AS (
        SELECT doc_id, pos, c, CASE WHEN opening THEN 0 ELSE greatest(e - length(t) + spaces, 0) END AS a,
               CASE WHEN opening AND t = ' ' THEN 0 ELSE greatest(e, 0) END AS b
        FROM placed)
    SELECT doc_id,
           CAST(CAST(concat('0x', substr(sha256(any_value(text)), 1, 16)) AS UBIGINT) AS VARCHAR) AS id,
           string_agg(CAST(unicode(c) - 256 AS VARCHAR), ' ' ORDER BY pos) AS target,
           string_agg(CAST(CAST(a AS BIGINT) AS VARCHAR), ' ' ORDER BY pos) AS offset_start,
           string_agg(CAST(CAST(b AS BIGINT) AS VARCHAR), ' ' ORDER BY pos) AS offset_end
           /*more*/
    FROM bounds JOIN corpus USING (doc_id) GROUP BY doc_id
"""

ORACLES = {
    "word_freq": f"""
        SELECT word, count(*) AS n FROM (SELECT unnest({words_sql('text')}) AS word FROM documents) GROUP BY word""",
    "bpe_pair_counts": f"""
        WITH {CORPUS_SQL}
        SELECT CAST(unicode(pair) - 256 AS INTEGER) AS left_id, CAST(unicode(substr(pair, 2, 1)) - 256 AS INTEGER) AS right_id,
               CAST(n AS BIGINT) AS n
        FROM ({_pairs(0)})""",
    "bpe_merges": f"WITH {TRAINING} " + " UNION ALL ".join(
        f"SELECT CAST({k} AS INTEGER) AS rank, CAST(unicode(pair) - 256 AS INTEGER) AS left_id, "
        f"CAST(unicode(substr(pair, 2, 1)) - 256 AS INTEGER) AS right_id, CAST({FIRST_MERGE_ID + k} AS INTEGER) AS new_id FROM p{k}"
        for k in range(MERGES)
    ),
    "encode_ids": f"WITH {ENCODED_SQL} SELECT doc_id, array_to_string({IDS.format('s')}, ' ') AS target FROM encoded",
    "encode_offsets": EXAMPLES_SQL,
    "decode_ids": f"""
        SELECT doc_id, CASE WHEN t = '' OR starts_with(t, ' ') THEN t ELSE concat(' ', t) END AS decoded
        FROM (SELECT doc_id, {ASCII_SQL} AS t FROM documents)""",
    "roundtrip_mismatches": "SELECT count(*) AS examples, CAST(0 AS BIGINT) AS mismatches FROM documents",
    "encode_totals": f"""
        WITH RECURSIVE {WHOLE_TRAINING}, {SHARDS_CTE},
        encoded AS (SELECT doc_id, sum(length(s)) AS n FROM occurrences JOIN w USING (word) GROUP BY doc_id),
        t AS (SELECT CAST(sum(n) AS BIGINT) AS tokens, count(*) AS examples FROM encoded),
        s AS (SELECT count(DISTINCT shard) AS record_files FROM f)
        SELECT tokens, examples, record_files, round(tokens / record_files, 2) AS tokens_per_file FROM t, s""",
    "saved_model_differences": "SELECT item_id, text FROM benchmark WHERE 1 = 0",
    "lexicon_coverage": f"""
        WITH c AS (SELECT ltrim(unnest({words_sql('text')}), ' ') AS word FROM documents),
        l AS (SELECT unnest([{', '.join(_quoted(w) for w in LEXICON)}]) AS word)
        SELECT l.word, count(c.word) AS n FROM l LEFT JOIN c ON l.word = c.word GROUP BY l.word""",
    "added_tokens": f"""
        WITH c AS (SELECT unnest(regexp_extract_all({ASCII_SQL},
                     '{"|".join(sorted(LEXICON, key=lambda w: (-len(w), w)))}')) AS word FROM documents)
        SELECT word, count(*) AS n FROM c GROUP BY word""",
}
