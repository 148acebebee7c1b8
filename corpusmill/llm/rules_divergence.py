"""Quality rules by distribution divergence.

Every text gives two histograms: the classes of its characters, and its common words per language with a bin
for all other words. References are the same histograms summed over all documents of a language. A text is far
from a language when the Jensen-Shannon distance (base 2, 0 to 1) of its characters or of its words exceeds a
threshold; it is rejected when it is far from every language. A language whose common words are not listed is compared by characters
alone, and a language without enough text for a reference is left to the base rules. Histograms of short texts say little, so each is
only compared from a least number of characters or words on; below it, it never rejects.

Two base rules come first: too few words, and too large a share of words in repeated windows of eight.

Everything is an expression over one row, but for the references. Those of ``MOST_REFERENCES`` languages are part of the expressions; a
text that is far from all of these is compared with the references of all other languages by a join.

Defined cases: a null text has no words; a row keeps its own result whatever other rows have its id; documents of
no language, or of one without a reference, are decided by the base rules; an empty
table gives an empty result; columns other than id, text and language are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.words import discard, stored, words
from corpusmill.plans.skew import without_ids

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
SYMBOLS = "[#*$%&|<>]"
# Frequent function words of each language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "on", "with", "as", "are", "be", "this"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "dans", "qui", "sur"],
}
# Character classes, told apart in this order; what is left is the last class.
CHARACTERS = ["[aeiou]", "[b-df-hj-np-tv-z]", "[A-Z]", "[0-9]", "[.,;:!?'\"()-]", "[\\x21-\\x7E]", "[\\u00C0-\\u024F]"]
LEAST_CHARACTERS = 200
LEAST_COMPARED_WORDS = 100
# Characters of a language that make a reference, and languages whose references are literals: those with the most text.
LEAST_REFERENCE, MOST_REFERENCES = 20_000, 64
FARTHEST_CHARACTERS = 0.32
FARTHEST_WORDS = 0.28

_LISTED = list(dict.fromkeys(w for ws in COMMON_WORDS.values() for w in ws))


def repeated_words(words_: str, at_least: int = WINDOW + 1) -> list[tuple[str, Column]]:
    """Columns, one after the other, up to ``n_repeat_words``: words inside windows that occur twice or more."""
    n, hashes, pairs, starts = F.size(words_), F.col("_hashes"), F.col("_pairs"), F.col("_starts")
    window = F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice(words_, i, WINDOW)))
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.filter(
        pairs, lambda p, i: (p["h"] == F.get(pairs, i - 1)["h"]) | (p["h"] == F.get(pairs, i + 1)["h"])
    )
    gaps = F.zip_with(
        F.slice(starts, F.lit(1), F.size(starts) - 1),
        F.slice(starts, F.lit(2), F.size(starts) - 1),
        lambda a, b: F.least(F.lit(WINDOW), b - a),
    )
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda s, x: s + x)
    return [
        ("_hashes", F.when(n >= at_least, window)),
        ("_pairs", F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), ordered)),
        ("_starts", F.when(pairs.isNotNull(), F.sort_array(F.transform(twice, lambda p: p["i"])))),
        ("n_repeat_words", F.coalesce(F.when(F.size(starts) > 0, covered), F.lit(0)).cast("long")),
    ]


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` as a struct ``_doc``, the counts of the base rules, and both histograms."""
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    listed = F.array(*[F.lit(w) for w in _LISTED])
    longest = max(map(len, _LISTED))
    places = F.filter(
        F.transform(F.filter("_words", lambda w: F.length(w) <= longest), lambda w: F.array_position(listed, w)),
        lambda i: i > 0,
    )
    steps = [
        ("_words", words(F.col("_text"))),
        ("_joined", F.array_join("_words", "")),
        ("_lines", lines),
        ("_places", places),
        ("n_words", F.size("_words").cast("long")),
        ("word_chars", F.length("_joined").cast("long")),
        ("n_symbols", F.regexp_count("_text", F.lit(SYMBOLS)).cast("long")),
        ("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")),
        *repeated_words("_words"),
    ]
    seen = [F.regexp_count("_joined", F.lit(c)).cast("long") for c in CHARACTERS[:5]]
    ascii_ = F.regexp_count("_joined", F.lit(CHARACTERS[5])).cast("long")
    accented = F.regexp_count("_joined", F.lit(CHARACTERS[6])).cast("long")
    first = F.array(*seen)
    out = docs.select(F.struct("*").alias("_doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    for name, column in steps:
        out = out.withColumn(name, column)
    out = out.withColumn("_first", first).withColumn("_ascii", ascii_).withColumn("_accented", accented)
    total = F.aggregate("_first", F.lit(0).cast("long"), lambda s, x: s + x)
    characters = F.concat(
        "_first",
        F.array(F.col("_ascii") - total, F.col("_accented"), F.col("word_chars") - F.col("_ascii") - F.col("_accented")),
    )
    n_listed = F.transform(
        F.sequence(F.lit(1), F.lit(len(_LISTED))),
        lambda k: (F.size("_places") - F.size(F.array_remove("_places", k.cast("long")))).cast("long"),
    )
    return out.select(
        "_doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        characters.alias("characters"), n_listed.alias("common"),
    )


def _references(statistics: DataFrame, lang: str) -> DataFrame:
    """(language, characters, common, n_words, word_chars): sums over all documents of each language with enough text."""
    n = len(CHARACTERS) + 1
    language = F.col(f"_doc.`{lang}`").cast("string")
    sums = statistics.where(language.isNotNull()).groupBy(language.alias("language")).agg(
        F.array(*[F.sum(F.get("characters", F.lit(i))) for i in range(n)]).alias("characters"),
        F.array(*[F.sum(F.get("common", F.lit(i))) for i in range(len(_LISTED))]).alias("common"),
        F.sum("n_words").alias("n_words"),
        F.sum("word_chars").alias("word_chars"),
    )
    return sums.where((F.col("word_chars") >= LEAST_REFERENCE) & (F.col("n_words") > 0))


def language_references(statistics: DataFrame, lang: str = "lang") -> dict[str, tuple[list[int], list[int] | None]]:
    """Character counts, and counts of the language's listed words with all other words last, of the ``MOST_REFERENCES`` languages with
    the most text, and of all whose common words are listed. ``further_references`` has the other languages."""
    enough = _references(statistics, lang)
    rows = enough.orderBy(F.desc("word_chars"), "language").limit(MOST_REFERENCES).collect()
    if len(rows) == MOST_REFERENCES:
        rows += enough.where(F.col("language").isin(*COMMON_WORDS)).collect()
    out = {}
    for row in rows:
        own = [row["common"][_LISTED.index(w)] for w in COMMON_WORDS.get(row["language"], [])]
        out[row["language"]] = (list(row["characters"]), [*own, row["n_words"] - sum(own)] if own else None)
    return dict(sorted(out.items()))


def further_references(statistics: DataFrame, references: dict, lang: str = "lang") -> DataFrame | None:
    """(further, shares): shares of the character classes of each language with enough text that is not among ``references``."""
    if len(references) < MOST_REFERENCES:
        return None
    others = _references(statistics, lang).where(~F.col("language").isin(*references))
    shares = F.transform("characters", lambda x: x / F.col("word_chars"))
    return others.select(F.col("language").alias("further"), shares.alias("shares"))


def divergence(counts: Column, total: Column, reference: list[int] | Column) -> Column:
    """Jensen-Shannon distance of counts that sum up to ``total`` to a reference histogram, or to a column of its shares."""

    def terms(c: Column, q: Column) -> Column:
        p = c / total
        m = (p + q) / 2
        part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
        return (part(p) + part(q)) / 2

    shares = reference
    if isinstance(reference, list):
        shares = F.array(*[F.lit(x / float(sum(reference))) for x in reference])
    sum_ = F.aggregate(F.zip_with(counts, shares, terms), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(sum_, F.lit(0.0)))


def judged(
    statistics: DataFrame, references: dict[str, tuple[list[int], list[int] | None]], lang: str = "lang", further: DataFrame | None = None
) -> DataFrame:
    """Adds ``base_failed``, ``distances`` (language, characters, words) to ``references``, and ``kept``."""
    n = F.col("n_words")
    base_failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n)
    distances = []
    for language, (characters, common) in references.items():
        words_distance = F.lit(None).cast("double")
        if common is not None:
            own = F.array(*[F.get("common", F.lit(_LISTED.index(w))) for w in COMMON_WORDS[language]])
            others = n - F.aggregate(own, F.lit(0).cast("long"), lambda s, x: s + x)
            words_distance = divergence(F.concat(own, F.array(others)), n, common)
        distances.append(
            F.struct(
                F.lit(language).alias("language"),
                F.when(F.col("word_chars") >= LEAST_CHARACTERS, divergence(F.col("characters"), F.col("word_chars"), characters)).alias("characters"),
                F.when(n >= LEAST_COMPARED_WORDS, words_distance).alias("words"),
            )
        )
    out = statistics.withColumn("base_failed", base_failed)
    if not distances:
        return out.withColumn("kept", ~F.col("base_failed"))
    near = lambda d: (
        (F.coalesce(d["characters"], F.lit(0.0)) <= FARTHEST_CHARACTERS) & (F.coalesce(d["words"], F.lit(0.0)) <= FARTHEST_WORDS)
    )
    language = F.col(f"_doc.`{lang}`").cast("string")
    told = F.coalesce(language.isin(*references), F.lit(False))
    out = out.withColumn("distances", F.array(*distances))
    if further is None:
        return out.withColumn("kept", ~F.col("base_failed") & (~told | F.exists("distances", near)))
    columns = [*out.columns, "kept"]
    out = out.join(further.select("further"), language == F.col("further"), "left")
    told = told | F.col("further").isNotNull()
    out = out.withColumn("_open", ~F.col("base_failed") & told & ~F.exists("distances", near)).drop("further")
    left = out.where("_open")
    close = divergence(F.col("characters"), F.col("word_chars"), F.col("shares")) <= FARTHEST_CHARACTERS
    close = (F.col("word_chars") < LEAST_CHARACTERS) | close
    parts = [
        out.where("NOT _open").withColumn("kept", ~F.col("base_failed")),
        left.join(further, close, "left_semi").withColumn("kept", F.lit(True)),
        left.join(further, close, "left_anti").withColumn("kept", F.lit(False)),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(*columns)


def judged_by_all(statistics: DataFrame, lang: str = "lang") -> DataFrame:
    """``judged`` by the references of all languages with enough text."""
    references = language_references(statistics, lang)
    further = further_references(statistics, references, lang)
    return judged(statistics, references, lang, None if further is None else stored(further, "further-references"))


def quality(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``_doc`` (the row), its statistics, ``base_failed`` and ``kept``."""
    statistics = stored(text_statistics(docs, text), "text-statistics")
    return judged_by_all(statistics, lang)


def kept_documents(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns.

    A row passes or not by its text and language. The statistics are written with a key of these, and the rows of the keys that
    fail are left out of ``docs``: texts are neither written nor shuffled."""
    of_text, of_lang = F.col(f"`{text}`"), F.col(f"`{lang}`").cast("string")
    key = F.xxhash64(of_lang.isNull(), F.coalesce(of_lang, F.lit("")), F.coalesce(of_text, F.lit("")))
    statistics = text_statistics(docs.select(of_text.alias("text"), of_lang.alias("lang"), key.alias("_row_key")))
    statistics = stored(statistics.withColumn("_doc", F.struct("_doc.lang", "_doc._row_key")), "text-statistics")
    failing = stored(judged_by_all(statistics).where("NOT kept").select("_doc._row_key").distinct(), "failing-documents")
    discard(statistics)
    return without_ids(docs.withColumn("_row_key", key), failing, "_row_key").select(*[f"`{c}`" for c in docs.columns])


def op5_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # The text itself is not carried along.
    narrow = stored(
        text_statistics(docs.select("doc_id", "lang", "text")).withColumn(
            "_doc", F.struct("_doc.doc_id", "_doc.lang")
        ),
        "text-statistics",
    )
    return judged_by_all(narrow).select(
        "_doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )
