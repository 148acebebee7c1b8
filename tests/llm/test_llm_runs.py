"""Periodic runs by suffix trees, against all lags of all words."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from corpusmill.llm.runs_suffix import Extensions, RangeMinimum, _runs_of_texts, op13_runs, periodic_runs, runs_of, with_planted_periods
from edge_docs import edge_docs, empty_docs


def split(text):
    return (text or "").encode().split()


def brute(seq, least=6, periods=4):
    """Stretches that equal themselves q words on, for every q, whose smallest period is q."""
    n, out = len(seq), []
    numbers = {w: i for i, w in enumerate(dict.fromkeys(seq))}
    a = np.array([numbers[w] for w in seq])
    for q in range(1, n // periods + 1):
        same = np.concatenate([[0], a[q:] == a[:-q], [0]]).astype(int)
        starts, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for start, end in zip(starts.tolist(), ends.tolist()):
            length = end - start + q
            part = a[start : start + length]
            if length >= max(least, periods * q) and not any((part[d:] == part[:-d]).all() for d in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(seq, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(seq) if i not in gone)


def planted(doc_id, seq):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(seq)
    if doc_id is None or h % 10 or not n:
        return seq
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [seq[i if i < a else a + (i - a) % p] for i in range(n)]


@pytest.mark.parametrize("least, periods", [(6, 4), (2, 2), (6, 2), (3, 3), (12, 2)])
def test_runs_against_brute_force(least, periods):
    rng = random.Random(least * periods)
    for _ in range(400):
        seq = [rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randint(0, 45))]
        if rng.random() < 0.4:
            piece = seq[: rng.randint(1, 6)] or [1]
            seq = seq[:10] + piece * rng.randint(1, 6) + piece[: rng.randint(0, len(piece))] + seq[10:]
        want = brute(seq, least, periods)
        assert [tuple(r) for r in runs_of(seq, least, periods).tolist()] == want
        # The same through the choice of stretches, with neighbours that must not matter.
        texts = [[b"%d" % s for s in seq], [], [b"%d" % s for s in seq[::-1]], [b"1"] * 3]
        for text, got in zip(texts, _runs_of_texts(texts, least, periods)):
            assert [tuple(r) for r in got.tolist()] == brute(text, least, periods)


def test_long_sequences():
    for seq in ([1] * 50_000, [1, 2, 3, 4, 5] * 9_000 + [1, 2], list(range(1, 30_001))):
        want = [] if seq[0] != seq[1] and seq[1] + 3 < max(seq) else [(0, len(seq), 1 if seq[0] == seq[1] else 5)]
        assert [tuple(r) for r in runs_of(seq).tolist()] == want


def test_extensions_and_minima():
    rng = random.Random(8)
    values = np.array([rng.randrange(50) for _ in range(333)])
    a, b = (np.array([rng.randrange(333) for _ in range(2000)]) for _ in range(2))
    want = [values[min(i, j) : max(i, j) + 1].min() for i, j in zip(a, b)]
    assert RangeMinimum(values).least(a, b).tolist() == want
    seq = [rng.randint(1, 2) for _ in range(60)]
    extensions = Extensions(seq)
    for i in range(61):
        for j in range(61):
            if i != j:
                n = next((k for k in range(60) if i + k == 60 or j + k == 60 or seq[i + k] != seq[j + k]), 0)
                assert extensions.common(np.array([i]), np.array([j]))[0] == n
    smaller, larger = extensions.ranks()
    suffixes = [seq[i:] for i in range(61)]
    assert np.argsort(smaller).tolist() == sorted(range(61), key=lambda i: [*suffixes[i], 0])
    assert np.argsort(larger).tolist() == sorted(range(61), key=lambda i: [*suffixes[i], 9])


def test_edges(spark):
    rows = [(1, "a b " * 9, "x"), (1, "a b " * 9, "x"), (None, "go go go go go go go", None), (4, None, "y"), (5, "", "y"), (6, " \t\x0b\n", "y"),
            (7, "Ü\x85x " * 8 + "世界", "z"), (8, "hop " * 30_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect()), key=repr)
    want = []
    for doc_id, text, _ in rows:
        seq = split(text)
        runs = [(0, 30_000, 1)] if doc_id == 8 else brute(seq)
        want.append((doc_id, len(seq), runs, collapsed(seq, runs).decode()))
    assert got == sorted(want, key=repr)
    assert periodic_runs(empty_docs(spark)).isEmpty()
    assert periodic_runs(edge_docs(spark)).count() == edge_docs(spark).count()
    with pytest.raises(ValueError):
        periodic_runs(docs, least=1)


def test_planted(spark):
    docs = edge_docs(spark).unionByName(spark.range(3000).selectExpr("id AS doc_id", "'a b c d e f g' AS text"), allowMissingColumns=True)
    got = with_planted_periods(docs).collect()
    texts = sorted((repr(r.doc_id), b" ".join(split(r.text))) for r in got)
    assert texts == sorted((repr(r.doc_id), b" ".join(planted(r.doc_id, split(r.text)))) for r in docs.collect())


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op13_runs(spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = got.collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    assert sum(r.n_runs for r in rows) > 10
    for r in rows:
        seq = planted(r.doc_id, split(docs[r.doc_id]))
        runs = brute(seq)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        milli = best[0] if best[0] is None else 1000 * best[1] // best[2]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert tuple(r) == (
            r.doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(seq, runs)).hexdigest()
        )
