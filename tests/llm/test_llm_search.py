"""Ranked search by matrix products, against sums in whole numbers."""

import math
import random
import re
import string
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import search_blas
from corpusmill.llm.search_blas import EXACT, MOST_IMPACT, op11_blas, terms_of, top_documents, weight_tiles
from edge_docs import edge_docs, empty_docs

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counts:
            n = sum(c.values())
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_terms():
    for text in ["", "A-b_c 12x", "Ünï\x85código 世界", "a\x00b\x7fC`d{e", "İstanbul ſ K"]:
        assert [t.decode() for t in terms_of(text.encode())] == terms(text)


@pytest.mark.parametrize("most", [40, 10**7, 10**12])
def test_tiles_hold_all_weights_exactly(most):
    rng = random.Random(most)
    weights = [{t: rng.randrange(1, most) for t in rng.sample(range(300), 60)} for _ in range(9)]
    tiles = weight_tiles(weights, tile_terms=50)
    back = [Counter() for _ in weights]
    for tile in tiles:
        assert len(tile.terms) <= 50
        assert (tile.dense(9).sum(axis=0) * MOST_IMPACT < EXACT).all()
        for r, c, d in zip(tile.rows, tile.columns, tile.digits):
            back[c][tile.terms[r]] += int(d) << tile.shift
    assert [dict(b) for b in back] == weights


def test_against_brute_force(spark, monkeypatch):
    """Many ties, small tiles, several blocks of items."""
    monkeypatch.setattr(search_blas, "TILE_ITEMS", 3)
    monkeypatch.setattr(search_blas, "TILE_TERMS", 4)
    monkeypatch.setattr(search_blas, "TILE_DOCS", 16)
    monkeypatch.setattr(search_blas, "HELD", 50)
    monkeypatch.setattr(search_blas, "BLOCK_CHARACTERS", 120)
    rng = random.Random(2)
    pool = [f"w{i}" for i in range(25)] + ["Ä", "x1", "THE", "the"]
    docs = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(300)]
    docs += [(i, "the same words for all") for i in range(300, 420)]
    items = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 8)))) for i in range(20)] + [(99, "same SAME words"), (99, "w1 w1 w1")]
    rng.shuffle(docs)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert found(top_documents(d, i)) == brute(docs, items)
    assert found(top_documents(d, i, k=3)) == brute(docs, items, 3)


def test_edges(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(1, "word WORDS", "x"), (None, "line", "y"), (3, None, "z"), (4, "...", "z")], "item_id long, text string, rank string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(top_documents(docs, items)) == brute(rows, [(r.item_id, r.text) for r in items.collect()])
    for d, i in ((empty_docs(spark), items), (docs, items.where("item_id > 9"))):
        got = top_documents(d, i)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.isEmpty()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert found(op11_blas(spark, sf)) == brute(docs, items)


def test_best_of_breaks_ties_by_id():
    items, ids = np.zeros(6, np.int64), np.array([5, 3, 4, 1, 2, 0])
    scores, nulls = np.array([7, 7, 7, 7, 9, 7]), np.array([0, 0, 0, 0, 0, 1])
    assert ids[search_blas.best_of(items, nulls, ids, scores, 3)].tolist() == [2, 1, 3]
