"""Exact dedup behind cuckoo filters, against grouping in Python."""

import hashlib
import random
import string

import pytest

from corpusmill.llm import dedup_cuckoo
from corpusmill.llm.dedup_cuckoo import CuckooIndex, deleted, digests, exact_groups, inserted, op12_cuckoo, without_copies
from edge_docs import edge_docs, empty_docs

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def digest_of(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).digest()


def key(i):
    return hashlib.sha256(str(i).encode()).digest()


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(digest_of(text), []).append(doc_id)
    return groups


def test_filter_grows_from_stored_keys_and_forgets():
    index = CuckooIndex()
    for i in range(5000):
        index.insert(key(i), (True, i, 0))
    assert index.resized >= 4
    assert all(index.find(key(i))[1] == (True, i, 0) for i in range(5000))
    assert all(index.find(key(i)) is None for i in range(5000, 9000))
    assert all(index.delete(key(i)) for i in range(0, 5000, 2))
    assert not index.delete(key(0))
    for i in range(5000):
        assert (index.find(key(i)) is None) == (i % 2 == 0)
    index.insert(key(0), (True, 7, 0))
    index.insert(key(0), (True, 3, 0), 2)
    assert index.find(key(0))[1:] == [(True, 7, 0), 3]


def test_hits_are_verified():
    """Digests with the same fingerprint and buckets: the filter can't tell them apart, the store does."""
    index = CuckooIndex()
    one, two = bytes(31) + b"\x01", bytes(31) + b"\x02"
    index.insert(one, (True, 1, 0))
    assert index.find(two) is None
    index.insert(two, (True, 2, 0))
    assert index.delete(one) and index.find(one) is None and index.find(two)[1] == (True, 2, 0)


def test_random_operations():
    rng, index, model = random.Random(5), CuckooIndex(2), {}
    for _ in range(20000):
        d, doc = key(rng.randrange(400)), rng.randrange(1000)
        if rng.random() < 0.6:
            index.insert(d, (True, doc, 0))
            old = model.get(d, (-1, 0))
            model[d] = (max(old[0], doc), old[1] + 1)
        else:
            assert index.delete(d) == (model.pop(d, None) is not None)
    assert {bytes(e[0]): (e[1][1], e[2]) for e in index.entries()} == model


def test_groups_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dedup_cuckoo, "PER_PARTITION", 300)
    rng = random.Random(1)
    rows = [(i, rng.choice(["Hot TEXT", "hot text", f"t{rng.randrange(900)}", "Ünï", "ünï", "", None])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    keyed = digests(docs)
    index = inserted(None, keyed)
    assert index.partitions == 10
    groups = expected(rows)
    texts = dict(rows)
    got = exact_groups(keyed, index).collect()
    assert len(got) == len(rows)
    for r in got:
        members = groups[digest_of(texts[r.doc_id])]
        assert (r.keep_id, r.n_rows, r.kept) == (max(members), len(members), r.doc_id == max(members))
        assert bytes(r.digest) == digest_of(texts[r.doc_id])


def test_index_lives_on(spark, monkeypatch):
    """A second day's documents, then a deletion, then the text comes back; the index is dealt out anew as it grows."""
    monkeypatch.setattr(dedup_cuckoo, "PER_PARTITION", 50)
    first = spark.createDataFrame([(i, f"t{i % 60}") for i in range(100)], "doc_id long, text string")
    second = spark.createDataFrame([(i, f"T{i % 90}") for i in range(100, 300)], "doc_id long, text string")
    one = inserted(None, digests(first))
    two = inserted(one, digests(second))
    assert two.partitions > one.partitions
    want = {}
    for i in range(300):
        want.setdefault(digest_of(f"t{i % (60 if i < 100 else 90)}"), []).append(i)
    assert {bytes(r.digest): (r.keep_id, r.n_rows) for r in two.live().collect()} == {d: (max(m), len(m)) for d, m in want.items()}
    gone = digests(spark.createDataFrame([(0, "t5"), (1, "never seen"), (2, "t5")], "doc_id long, text string"))
    three = deleted(two, gone)
    left = {bytes(r.digest) for r in three.live().collect()}
    assert left == set(want) - {digest_of("t5")}
    four = inserted(three, digests(spark.createDataFrame([(4, "T5")], "doc_id long, text string")))
    assert [r.keep_id for r in four.live().collect() if bytes(r.digest) == digest_of("t5")] == [4]


def test_edges(spark):
    docs = edge_docs(spark)
    keyed = digests(docs)
    got = exact_groups(keyed, inserted(None, keyed)).collect()
    assert len(got) == docs.count()
    by_digest = {}
    for r in got:
        by_digest.setdefault(bytes(r.digest), []).append(r)
    for rows in by_digest.values():
        assert sum(r.kept for r in rows) == 1
        assert {r.n_rows for r in rows} == {len(rows)}
        assert {r.keep_id for r in rows} == {max((r.doc_id for r in rows if r.doc_id is not None), default=None)}
    assert {r.n_rows for r in by_digest[digest_of("")]} == {2}
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 5, 5, 8, 9, 10, 11]
    assert exact_groups(digests(empty_docs(spark)), inserted(None, digests(empty_docs(spark)))).isEmpty()


@pytest.mark.parametrize("sf", ["0.001"])
def test_query(spark, sf):
    got = op12_cuckoo(spark, f"/root/testdata/sf{sf}")
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").collect()}
    groups = expected(docs.items())
    for r in got.collect():
        members = groups[digest_of(docs[r.doc_id])]
        assert tuple(r) == (r.doc_id, max(members), len(members), r.doc_id == max(members), digest_of(docs[r.doc_id]).hex())
