import base64
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from edge_docs import edge_docs, empty_docs, given

from corpusmill.llm import jaccard_tree, warc_segments
from corpusmill.llm.components import components
from corpusmill.session import scratch_path


def brute_components(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def word_sets(texts, size):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def brute_links(sets, percent):
    by_token, shared = defaultdict(list), defaultdict(int)
    for i, s in enumerate(sets):
        for t in s:
            for j in by_token[t]:
                shared[j, i] += 1
            by_token[t].append(i)
    return [
        (i, j) for (i, j), n in shared.items() if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n)
    ]


@pytest.mark.parametrize("make,sf", [(given, "0.001"), (given, "0.01")])
@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_tables_against_brute_force(spark, make, sf, size, percent):
    docs = make(spark, sf)
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    sets = word_sets([r["text"] for r in rows], size)
    comp = brute_components(len(rows), brute_links(sets, percent))
    want = {r["doc_id"]: (len(s), rows[c]["doc_id"]) for r, s, c in zip(rows, sets, comp)}
    got = jaccard_tree.similar_components(docs, size, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def family(rng, n, length, edits):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(length)]
    texts = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(length)] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    return texts


def test_large_family_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_tree, "TILE_SHINGLES", 4000)
    rng = random.Random(1)
    texts = family(rng, 150, 100, 4) + family(rng, 60, 40, 3) + ["a b", "a b", "A  b", "one", None, ""]
    docs = edge_docs(spark, [(i, t, "s") for i, t in enumerate(texts)])
    sets = word_sets(texts, 3)
    want = brute_components(len(texts), brute_links(sets, 90))
    want = [i if not sets[i] else c for i, c in enumerate(want)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_tree.similar_components(docs, 3, 90).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_tree_equals_all_pairs():
    rng = random.Random(7)
    for n, length, edits in ((3, 30, 2), (90, 60, 6), (200, 25, 3)):
        words = word_sets(family(rng, n, length, edits), 3)
        sets = [np.unique(np.array([abs(hash(t)) for t in s], np.uint64)) for s in words]
        links = [
            (i, j)
            for i in range(n)
            for j in range(i)
            if jaccard_tree.similar(sets[i], sets[j], 90)
        ]
        assert brute_components(n, jaccard_tree.joined_parts(sets, 90)) == brute_components(n, links)


def test_edges(spark):
    got = jaccard_tree.similar_components(edge_docs(spark), 3, 90).collect()
    found = defaultdict(list)
    for r in got:
        found[r["doc_id"]].append((r["n_shingles"], r["component_id"]))
    assert found[1] == [(8, 1)] and found[5] == [(8, 1)] * 2 and found[2] == [(0, 2)] and found[3] == [(0, 3)]
    assert found[None] == [(2, None)] and found[8] == [(0, 8)] and found[11] == [(1, 11)]
    assert jaccard_tree.similar_components(empty_docs(spark)).count() == 0


def test_components_of_chains(spark):
    rng = random.Random(2)
    order = list(range(300))
    rng.shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(299) if i % 37] + [(400, 401), (401, 400), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute_components(402, [e for e in edges if None not in e])
    assert all(got.get(i, i) == want[i] for i in range(402)) and set(got.values()) <= set(range(402))


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, digest string, n int")


def test_warc_round_trip(spark):
    rng = random.Random(4)
    bodies = [None, "", "é" * 5000, "a\r\n0\r\n\r\nb", "WARC/1.1\r\n\r\n"] + ["".join(rng.choices("ab\n é", k=rng.randint(0, 9000))) for _ in range(40)]
    rows = [(i, f"http://x/{i} \n", b) for i, b in enumerate(bodies + bodies[::2])] + [(None, None, "none"), (500, None, bodies[9]), (500, None, bodies[9])] + [(700, None, "é" * 3000)] * 30
    folder = scratch_path(spark, "warc-test")
    archives = warc_segments.pages_to_archives(pages(spark, rows), folder, segment=1000, archive=3000)
    assert archives.count() > 5
    records = warc_segments.read_records(archives, folder)
    assert records.where("record_type = 'continuation'").count() > 50
    # Every revisit names a response that is there, continuations name a first segment.
    named = {r.record_id: r.record_type for r in records.collect()}
    assert all(re.fullmatch(r"<urn:page:[^<>]+>", name) for name in named)
    assert {named[r.refers_to] for r in records.where("refers_to IS NOT NULL").collect()} == {"response"}
    assert {named[r.origin_id] for r in records.where("record_type = 'continuation'").collect()} == {"response"}
    got = warc_segments.reassembled(records).collect()
    assert sum(r["segments"] > 1 for r in got) > 10 and min(r["segments"] for r in got) == 1
    last = {}
    for i, _, b in rows:
        last[b or ""] = max(last.get(b or "", -1), -1 if i is None else i)
    want, have = [], []
    for i, _, b in rows:
        b = b or ""
        revisit = i is not None and i < last[b]
        digest = base64.b32encode(hashlib.sha1(b.encode()).digest()).decode()
        want.append((str(i), len(b.encode()), digest, "revisit" if revisit else "response", str(last[b]) if revisit else None, None if revisit else b))
    for r in got:
        number = lambda s: s and s.split(":")[2].rstrip(">")
        assert r["fault"] is None
        have.append((number(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"]), None if r["payload"] is None else bytes(r["payload"]).decode()))
    assert sorted(map(repr, have)) == sorted(map(repr, want))
    assert warc_segments.pages_to_archives(pages(spark, []), scratch_path(spark, "w")).count() == 0


def test_warc_query(spark):
    """At the shipped sizes a good part of the pages is segmented, and every page comes back."""
    got = warc_segments.op7_segments(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 250 and not any(r["fault"] for r in got)
    assert sum(r["segments"] > 1 for r in got) >= 25
    sizes = {r.page_id: len((r.html or "").encode()) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert {r["page_id"]: r["payload_bytes"] for r in got} == sizes


def test_warc_faults():
    body = b"hello" * 50
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc_segments.framed(body, 64)
    digest = "sha1:" + warc_segments.payload_digest(body)

    def parts(cut=100, **change):
        cuts = [block[i : i + cut] for i in range(0, len(block), cut)]
        out = [{"record_type": "response" if i == 1 else "continuation", "digest": digest if i == 1 else None, "segment": i, "total_length": len(block) if i == len(cuts) else None, "block": c} for i, c in enumerate(cuts, 1)]
        out[-1] |= change
        return out

    assert warc_segments.restored(parts())[2:] == (None, body)
    assert warc_segments.restored(parts()[:-1])[2] == "total length"
    assert warc_segments.restored([parts()[0], *parts()[2:]])[2] == "missing segment"
    assert warc_segments.restored(parts()[1:])[2] == "missing segment"
    assert warc_segments.restored(parts(total_length=7))[2] == "total length"
    wrong = parts()
    wrong[0]["digest"] = "sha1:AAAA"
    assert warc_segments.restored(wrong)[2] == "digest"
    broken = parts()
    broken[0]["block"] = broken[0]["block"].replace(b"40\r\n", b"4x\r\n")
    assert warc_segments.restored(broken)[2] == "framing"
