import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from edge_docs import edge_docs, empty_docs, given

from corpusmill.llm import ppm


def brute_scores(train, texts, order, share):
    """Counts in dicts, escapes and exclusions symbol by symbol."""
    counts, total = defaultdict(Counter), 0
    for t in train:
        s = bytes([255]) * order + t.lower() + b"\xff"
        for i in range(order, len(s)):
            total += 1
            for k in range(order + 1):
                counts[s[i - k : i]][s[i]] += 1
    kept = {c: n for c, n in counts.items() if sum(n.values()) * share >= total}
    out = []
    for t in texts:
        s = bytes([255]) * order + t.lower() + b"\xff"
        score = 0.0
        for i in range(order, len(s)):
            excluded, done = set(), False
            for k in range(order, -1, -1):
                seen = {x: n for x, n in kept.get(s[i - k : i], {}).items() if x not in excluded}
                if not seen:
                    continue
                space = sum(seen.values()) + len(seen)
                if s[i] in seen:
                    score += math.log10(seen[s[i]] / space)
                    done = True
                    break
                score += math.log10(len(seen) / space)
                excluded |= seen.keys()
            if not done:
                score -= math.log10(256 - len(excluded))
        out.append(score)
    return out


def check(docs, rows, order, share):
    data = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in data]
    train = [t for (_, t), h in zip(data, held) if not h]
    tokens = Counter(w for t in train for w in [*t.lower().split(), b""])
    n, v = sum(tokens.values()), len(tokens)
    scores = brute_scores(train, [t for _, t in data], order, share)
    want = []
    for (i, t), h, s in zip(data, held, scores):
        words = [*t.lower().split(), b""]
        base = sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        want.append((i, h, len(words), sum(tokens[w] > 0 for w in words), n, base, s))
    got = [tuple(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")) for r in rows]
    order_ = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=order_), sorted(want, key=order_)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-5)


@pytest.mark.parametrize("share,word_share", [(1 << 16, 1 << 18), (200, 50)])
def test_against_brute_force(spark, monkeypatch, share, word_share):
    monkeypatch.setattr(ppm, "WORD_SHARE", word_share)
    monkeypatch.setattr(ppm, "SHARE", share)
    monkeypatch.setattr(ppm.trie_edges, "__defaults__", (ppm.ORDER, share))
    docs = given(spark).where("doc_id < 60")
    check(docs, ppm.scored(docs, order=3).collect(), 3, share)


def test_edges(spark):
    docs = edge_docs(spark)
    check(docs, ppm.scored(docs).collect(), ppm.ORDER, ppm.SHARE)
    assert ppm.scored(empty_docs(spark)).count() == 0
    alone = edge_docs(spark, [(1, "unseen", "a")] if zlib.crc32(b"1") % 5 == 1 else [(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1), "unseen", "a")])
    assert ppm.scored(alone).first()["score"] == pytest.approx(-7 * math.log10(256), rel=1e-5)


def test_probabilities_sum_to_one(spark):
    rows = ppm.rows_of(given(spark).where("doc_id < 40"), "doc_id", text="text")
    trie = ppm.Trie(ppm.trie_edges(ppm.corpus_counts(rows, 4), 4, 500).toArrow(), 4)
    n_seen = trie.cost.shape[1] - 1
    p = 10.0 ** trie.cost
    assert (abs(p[:, :-1].sum(1) + p[:, -1] * (256 - n_seen) - 1) < 1e-4).all()


def test_adaptive(spark):
    rng = random.Random(1)
    text = "".join(rng.choices("abc ", k=60))
    again = ppm.adaptive_score((text * 5).encode())
    assert again < 0 and again > 5 * ppm.adaptive_score(text.encode()) * 0.6
    assert ppm.adaptive_score(b"") == pytest.approx(-math.log10(256))
    got = {r["doc_id"]: r["score"] for r in ppm.adaptive_scores(edge_docs(spark).where("doc_id <> 4")).collect()}
    assert got[2] == got[3] == pytest.approx(-math.log10(256))


def test_longer_contexts_help_on_held_out_texts(spark):
    docs = given(spark, "0.01")
    costs = []
    for order in (1, 6):
        rows = ppm.scored(docs, order=order).where("held_out").collect()
        costs.append(-sum(r["score"] for r in rows))
    n_bytes = sum(len((r["text"] or "").encode()) + 1 for r in docs.where(ppm.held_out(docs.doc_id)).collect())
    assert costs[1] < 0.75 * costs[0] and costs[1] / n_bytes < math.log10(256) / 3


def test_rare_contexts_are_kept(spark, monkeypatch):
    """Contexts that occur once among more than 131,072 bytes count, whatever file of the trie they are in."""
    monkeypatch.setattr(ppm, "GRAMS_PER_FILE", 1000, raising=False)
    monkeypatch.setattr(ppm, "_UNSEEN", 100, raising=False)
    rng = random.Random(6)
    texts = [(i, "".join(rng.choices("abcdeé \n", k=7000)) + f" rare{i % 9} {chr(0x4E00 + i)}", "s") for i in range(30)]
    docs = edge_docs(spark, texts)
    check(docs, ppm.scored(docs, order=3).collect(), 3, 1 << 62)
