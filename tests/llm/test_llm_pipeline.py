"""The stages of the corpus pipeline, one after the other, on the smallest table."""

from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import rules_divergence as rules
from corpusmill.llm.words import stored

SF = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        counts.append(docs.count())
    n, rules, lines, near, mixed = counts
    # Rules take documents away, lines leave all of them (some without text), near copies go, the mix takes some twice.
    assert n > rules == lines >= near > 0 and mixed > 0
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_copies", "mix", "pack"]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {d.doc_id for d in docs.collect()}
    used: dict = {}
    for p in pieces:
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in used.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= 2048
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))


def test_rules_write_no_texts(spark, monkeypatch):
    """What the rules keep on disk has no text, and the rows that pass are those of the rules, copies and nulls included."""
    written = []
    monkeypatch.setattr(rules, "stored", lambda df, name: written.append(df.schema.simpleString()) or stored(df, name))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(20).withColumn("lang", F.lit(None).cast("string")).unionByName(docs.limit(20).withColumn("text", F.lit(None).cast("string")))
    docs = docs.unionByName(docs.limit(30)).unionByName(odd)
    kept = rules.kept_documents(docs)
    assert written and not any("text:" in schema for schema in written)
    wanted = rules.quality(docs).where("kept").select("_doc.*")
    assert 0 < kept.count() < docs.count() and kept.exceptAll(wanted).isEmpty() and wanted.exceptAll(kept).isEmpty()
