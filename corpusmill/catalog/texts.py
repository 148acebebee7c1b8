"""Units, cleaning and exact deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.tables import PATH_SQL, files, table
from corpusmill.functions.text import collapse_non_ascii, fingerprint64, slices
from corpusmill.operators import clean, dedup
from corpusmill.plans.parallel import spread
from corpusmill.operators.units import split_units
from corpusmill.session import scratch_path
from corpusmill.sources.paths import files_at, files_below
from corpusmill.sources.textfiles import file_fingerprints, read_files, write_text

ENDS = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
LINES_SQL = rf"list_filter(regexp_extract_all(text, '[^{ENDS}]*(?:\r\n|[{ENDS}]|\z)'), lambda x: x <> '')"
ASCII_SQL = r"regexp_replace(text, '[^\x00-\x7F]+', ' ', 'g')"
UPPER_LOWER_DIGITS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(48, 58)]))
FILES_PER_FOLDER = 1000
WIDE = "".join(chr(ord(c) + 0xFEE0) for c in UPPER_LOWER_DIGITS)


def unique_clean_lines(spark, sf_dir):
    """The flagship: clean text, drop exact copies, split into lines, count per source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    kept = dedup.keep_first(docs.withColumn("text", collapse_non_ascii(F.col("text"))), "doc_id")
    lines = split_units(kept, "line")
    return lines.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("text").cast("bigint")).alias("n_chars")
    )


def units(by):
    return lambda spark, sf_dir: split_units(table(spark, sf_dir, "documents").select("doc_id", "text"), by)


def lines_through_files(compression):
    """Documents written as text files, listed, and read back as line units."""

    def query(spark, sf_dir):
        folder = scratch_path(spark, "texts")
        write_text(table(spark, sf_dir, "documents"), folder, compression=compression)
        paths = [r.path for r in files_at(spark, folder).collect()]
        return read_files(spark, paths, by="line").select("text")

    return query


def dedup_files(spark, sf_dir):
    """Documents as files, one each, listed and compared by their bytes: each content and how many files have it."""
    folder = scratch_path(spark, "files")
    # Folders of some files each, so that neither the committer nor the listing has all files on the driver.
    of = F.expr(f"monotonically_increasing_id() div {FILES_PER_FOLDER}").alias("folder")
    texts = table(spark, sf_dir, "documents").select(F.col("text").alias("value"), of)
    texts.write.partitionBy("folder").option("maxRecordsPerFile", 1).text(folder)
    report = dedup.hash_groups(file_fingerprints(files_below(spark, folder)))
    return hex_hash(report).select("hash", F.col("n_rows").alias("n"))


def clean_ascii(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", collapse_non_ascii(F.col("text")).alias("text"))


def clean_nfkc(spark, sf_dir):
    """Documents with their ASCII letters and digits in full width: cleaning brings them back."""
    wide = spread(files(spark, sf_dir)).withColumn("text", F.translate("text", UPPER_LOWER_DIGITS, WIDE))
    return clean.clean_files(wide).select("path", "text")


def listed_by_language(spark, sf_dir):
    """Document paths, with an extension that depends on the language."""
    ending = F.expr("CASE lang WHEN 'en' THEN '.txt' WHEN 'fr' THEN '.TXT' WHEN 'de' THEN '.txt' ELSE '.zst' END")
    root = F.expr("CASE WHEN lang = 'de' THEN '' ELSE '/' END")
    return table(spark, sf_dir, "documents").select(
        F.concat(root, "source", F.lit("/"), F.col("doc_id").cast("string"), ending).alias("path")
    )


LISTED_SQL = """
    SELECT concat(CASE WHEN lang = 'de' THEN '' ELSE '/' END, source, '/', doc_id,
                  CASE lang WHEN 'en' THEN '.txt' WHEN 'fr' THEN '.TXT' WHEN 'de' THEN '.txt' ELSE '.zst' END) AS path
    FROM documents
"""


def prints(spark, sf_dir):
    return dedup.fingerprints(files(spark, sf_dir))


def hex_hash(df):
    return df.withColumn("hash", F.lower(F.hex("hash")))


def fingerprint(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", fingerprint64(F.col("text")).cast("string").alias("id")
    )


def dedup_keep_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return dedup.keep_first(docs, "doc_id").select("doc_id", "source", "text")


def offset_slices(spark, sf_dir):
    """First and last ten characters of each document by their offsets."""
    n = F.length("text").cast("bigint")
    starts = F.array(F.lit(0).cast("bigint"), F.greatest(n - 10, F.lit(0)))
    ends = F.array(F.least(n, F.lit(10)), n)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(slices(F.col("text"), starts, ends), "|").alias("pieces")
    )


QUERIES = {
    "unique_clean_lines": unique_clean_lines,
    "units_file": units("file"),
    "units_line": units("line"),
    "units_passage": units("passage"),
    "text_files_lines": lines_through_files("none"),
    "gzip_files_lines": lines_through_files("gzip"),
    "dedup_files": dedup_files,
    "clean_ascii": clean_ascii,
    "clean_nfkc": clean_nfkc,
    "clean_totals": lambda spark, sf_dir: clean.clean_totals(listed_by_language(spark, sf_dir)),
    "path_guard": lambda spark, sf_dir: clean.relative_paths(listed_by_language(spark, sf_dir)),
    "fingerprint": fingerprint,
    "dedup_unique": lambda spark, sf_dir: hex_hash(dedup.unique_index(prints(spark, sf_dir))).drop("ordinal"),
    "dedup_keep_first": dedup_keep_first,
    "dedup_sorted": lambda spark, sf_dir: dedup.sorted_listing(prints(spark, sf_dir)),
    "dedup_duplicates": lambda spark, sf_dir: hex_hash(dedup.duplicate_report(prints(spark, sf_dir))),
    "dedup_members": lambda spark, sf_dir: hex_hash(
        dedup.duplicate_members(prints(spark, sf_dir)).select("path", "hash", "n_rows")
    ),
    "hash_totals": lambda spark, sf_dir: dedup.hash_totals(prints(spark, sf_dir)),
    "offset_slices": offset_slices,
}

PRINTS_SQL = f"SELECT doc_id, {PATH_SQL} AS path, sha256(text) AS hash FROM documents"

ORACLES = {
    "dedup_files": "SELECT sha256(concat(text, chr(10))) AS hash, count(*) AS n FROM documents GROUP BY 1",
    "unique_clean_lines": f"""
        WITH cleaned AS (SELECT doc_id, source, {ASCII_SQL} AS text FROM documents),
        first_of AS (SELECT min(doc_id) AS doc_id FROM cleaned GROUP BY text),
        lines AS (SELECT source, unnest({LINES_SQL}) AS line FROM cleaned JOIN first_of USING (doc_id))
        SELECT source, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
        FROM lines GROUP BY source""",
    "units_file": "SELECT doc_id, CAST(0 AS INTEGER) AS unit_no, text FROM documents",
    "units_line": f"""
        WITH l AS (SELECT doc_id, {LINES_SQL} AS pieces FROM documents)
        SELECT doc_id, CAST(generate_subscripts(pieces, 1) - 1 AS INTEGER) AS unit_no, unnest(pieces) AS text FROM l""",
    "units_passage": """
        WITH l AS (SELECT doc_id, string_split(text, '.') AS pieces FROM documents)
        SELECT doc_id, CAST(generate_subscripts(pieces, 1) - 1 AS INTEGER) AS unit_no, unnest(pieces) AS text FROM l""",
    "text_files_lines": f"""
        WITH l AS (SELECT concat(text, chr(10)) AS text FROM documents)
        SELECT unnest({LINES_SQL}) AS text FROM l""",
    "gzip_files_lines": f"""
        WITH l AS (SELECT concat(text, chr(10)) AS text FROM documents)
        SELECT unnest({LINES_SQL}) AS text FROM l""",
    "clean_ascii": f"SELECT doc_id, {ASCII_SQL} AS text FROM documents",
    "clean_nfkc": f"SELECT {PATH_SQL} AS path, {ASCII_SQL} AS text FROM documents",
    "clean_totals": f"""
        SELECT count(*) FILTER (WHERE path LIKE '%.txt') AS good_files, count(*) AS total_files FROM ({LISTED_SQL})""",
    "path_guard": f"SELECT path FROM ({LISTED_SQL}) WHERE path NOT LIKE '/%'",
    "fingerprint": """
        SELECT doc_id, CAST(CAST(concat('0x', substr(sha256(text), 1, 16)) AS UBIGINT) AS VARCHAR) AS id
        FROM documents""",
    "dedup_unique": f"SELECT arg_min(path, doc_id) AS path, hash FROM ({PRINTS_SQL}) GROUP BY hash",
    "dedup_keep_first": """
        SELECT doc_id, source, text FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "dedup_sorted": f"SELECT path, hash FROM ({PRINTS_SQL}) ORDER BY hash, path",
    "dedup_duplicates": f"SELECT hash, count(*) AS n_rows FROM ({PRINTS_SQL}) GROUP BY hash HAVING count(*) > 1",
    "dedup_members": f"""
        SELECT path, hash, n_rows
        FROM (SELECT path, hash, count(*) OVER (PARTITION BY hash) AS n_rows FROM ({PRINTS_SQL})) WHERE n_rows > 1""",
    "hash_totals": f"SELECT count(hash) AS files_hashed, count(*) AS files_listed FROM ({PRINTS_SQL})",
    "offset_slices": """
        SELECT doc_id, concat(substr(text, 1, 10), '|', substr(text, greatest(length(text) - 10, 0) + 1)) AS pieces
        FROM documents""",
}
