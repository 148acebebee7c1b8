"""Rows that every operator must take: nulls, empty and long texts, copies, clashing column names."""

SCHEMA = (
    "doc_id long, text string, source string, lang string, n_chars long, size string, shard int, "
    "key string, words string, _rank int, n string, line string, h long"
)
LONG = "long words and more of them " * 4000
TEXTS = [
    (1, "A few Words on one line\nand some more here", "b"),
    (2, None, "a"),
    (3, "", None),
    (4, LONG, "a"),
    (5, "A few Words on one line\nand some more here", "b"),
    (5, "A few Words on one line\nand some more here", "b"),
    (None, "no id at all", "c"),
    (8, " \n\t ", "b"),
    (9, "Ünï\x85codé\x0bwörds <|endoftext|> 世界 x  two", None),
    (10, "\n\n a \n\n a \n", "c"),
    (11, "word", "c"),
]


def edge_docs(spark, texts=TEXTS):
    rows = [(i, t, s, None, None, "x", 1, "k", "w", 2, "n", "l", 3) for i, t, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


def empty_docs(spark):
    return edge_docs(spark).where("doc_id < 0")


def given(spark, sf="0.001"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
