import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from edge_docs import edge_docs, empty_docs, given
from pyspark.sql import functions as F

from corpusmill.llm import lines_simhash, rp_forest, rules_divergence as rules


def base_counts(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    n = len(words)
    chars = sum(len(w.decode()) for w in words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, chars, sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


@pytest.mark.parametrize("make", [edge_docs, empty_docs, given])
def test_rules_base(spark, make):
    docs = make(spark)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = rules.quality(docs).select("_doc.doc_id", "_doc.size" if make is edge_docs else "_doc.text", *names, "kept").collect()
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, *base_counts(r["text"] or "")) for r in docs.collect())
    assert sorted((r[0] is None, r[0] or 0, *r[2:8]) for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)


def distance(counts, reference):
    p, q = (np.array(x, float) / sum(x) for x in (counts, reference))
    m = (p + q) / 2
    part = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return math.sqrt(max(0.0, (part(p) + part(q)) / 2))


def test_rules_distances(spark):
    docs = given(spark)
    refs = {k: ([0] * 8, [0] * 16) for k in rules.COMMON_WORDS}
    found = {}
    for r in docs.collect():
        words = (r["text"] or "").encode().split()
        text = b"".join(words).decode()
        chars = [0] * 8
        for c in text:
            if c in "aeiou":
                i = 0
            elif "a" <= c <= "z":
                i = 1
            elif "A" <= c <= "Z":
                i = 2
            elif "0" <= c <= "9":
                i = 3
            elif c in ".,;:!?'\"()-":
                i = 4
            elif "\x21" <= c <= "\x7e":
                i = 5
            else:
                i = 6 if "À" <= c <= "ɏ" else 7
            chars[i] += 1
        own = {k: [sum(w.decode() == x for w in words) for x in ws] for k, ws in rules.COMMON_WORDS.items()}
        found[r["doc_id"]] = (chars, {k: [*v, len(words) - sum(v)] for k, v in own.items()}, len(words), len(text))
        if r["lang"] in refs:
            a, b = refs[r["lang"]]
            refs[r["lang"]] = ([x + y for x, y in zip(a, chars)], [x + y for x, y in zip(b, found[r["doc_id"]][1][r["lang"]])])
    for r in rules.quality(docs).select("_doc.doc_id", "distances", "kept", "base_failed").collect():
        chars, own, n, n_chars = found[r["doc_id"]]
        near = False
        for d in r["distances"]:
            a, b = refs[d["language"]]
            c = distance(chars, a) if n_chars >= rules.LEAST_CHARACTERS else None
            w = distance(own[d["language"]], b) if n >= rules.LEAST_COMPARED_WORDS else None
            assert d["characters"] == pytest.approx(c, abs=1e-9) and d["words"] == pytest.approx(w, abs=1e-9)
            near |= (c or 0) <= rules.FARTHEST_CHARACTERS and (w or 0) <= rules.FARTHEST_WORDS
        assert r["kept"] == (near and not r["base_failed"])


def test_rules_keep_good_and_reject_junk(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = rules.quality(docs).select("_doc.doc_id", "kept", "base_failed").join(labels, "doc_id").where("NOT base_failed").collect()
    good, junk = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert all(good) and sum(junk) < len(junk)
    kept = rules.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == rules.quality(docs).where("kept").count()


def test_rules_compare_with_every_language(spark, monkeypatch):
    """Texts are judged alike however many references are literals and however many are joined."""
    rng = random.Random(3)
    alphabets = {"x1": "abcdefghij", "x2": "0123456789", "x3": "ABCDEFGHIJ", "x4": "\u0430\u0431\u0432\u0433", "en": "etaoinshr"}
    write = lambda letters, n: " ".join("".join(rng.choices(letters, k=6)) for _ in range(n))
    rows = [(i, write(letters, 1500 + 50 * k), name) for k, (name, letters) in enumerate(alphabets.items()) for i in range(k * 10, k * 10 + 3)]
    rows += [(100 + k, write(alphabets["x2"], 90), name) for k, name in enumerate(["x1", "x3", "x4", "en", "none", None])]
    rows += [(200, write("+=<>[]{}^~", 90), "x1"), (201, write("+=<>[]{}^~", 90), "none"), (202, " ".join(rng.choices("+=~^", k=120)), "x4"), (203, "x", "x2")]
    rows += [rows[0], rows[-4]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judge = lambda: sorted((r.doc_id, r.base_failed, r.kept) for r in rules.quality(docs).select("_doc.doc_id", "base_failed", "kept").collect())
    want = judge()
    assert {k for i, _, k in want if i == 200} == {False} and {k for i, _, k in want if i == 100} == {True}
    for most in (1, 2, 5):
        monkeypatch.setattr(rules, "MOST_REFERENCES", most)
        assert judge() == want


def test_rules_leave_other_languages_alone(spark):
    """Languages without listed words are compared with their own characters, those without a reference not at all."""
    rng = random.Random(3)

    def text(letters, n):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n))

    russian, greek, chinese = "оеаинтсрвлкмдпуяыьгзбчй", "αβγδεζηθικλμνξοπρστυφχψω", "的一是不了人我在有他这中大来上国"
    rows = [(10_000 + i, text(russian, 150), "ru") for i in range(40)] + [(20_001, text(greek, 150), "el"), (20_002, text(chinese, 150), None)]
    rows += [(30_000, text("0123456789#$%", 150), "ru"), (30_001, text(russian, 150), "en"), (30_002, text(russian, 5), "ru")]
    docs = given(spark).select("doc_id", "text", "lang").unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    kept = {r["doc_id"]: r["kept"] for r in rules.quality(docs).select("_doc.doc_id", "kept").where("doc_id >= 10000").collect()}
    assert all(kept[i] for i, _, _ in rows[:42])
    # What is far from all references goes; Cyrillic text is near one now, whatever it is labelled.
    assert not kept[30_000] and kept[30_001] and not kept[30_002]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, leaf string, rank int")


def test_forest_edges(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(np.float32(x)) for x in rng.standard_normal(8)]) for i in range(60)]
    good += [(100 + i, good[3][1]) for i in range(40)]
    bad = [(200, None), (220, [0.0] * 8), (240, [1.0, None] + [0.0] * 6), (260, [float("nan")] + [1.0] * 7), (280, [1.0] * 9), (None, good[0][1])]
    got = rp_forest.nearest(vectors(spark, good + bad), F.col("doc_id") % 20 == 0, k=20, share=1.0).collect()
    x, found = dict(good), defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(found) == {i for i in x if i % 20 == 0}
    for q, rows in found.items():
        scored = sorted((-float(np.sum(np.array(x[q]) * np.array(x[i]))), i) for i in x if i != q)[:20]
        assert [i for i, _ in rows] == [i for _, i in scored]
        assert [s for _, s in rows] == pytest.approx([-s for s, _ in scored], rel=1e-12)
    few = rp_forest.nearest(vectors(spark, good[:3] + bad), F.col("doc_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == [(0, 1), (0, 2)]
    assert rp_forest.nearest(vectors(spark, []), F.col("doc_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("sf, small", [("0.01", False), ("0.1", False), ("0.1", True)])
def test_forest_recall(spark, monkeypatch, sf, small):
    """As shipped, and with blocks, pieces and lists that a small table fills."""
    if small:
        for name, value in (("QUERIES", 40), ("PIECE", 100), ("HELD", 500), ("LEAST_TASKS", 3)):
            monkeypatch.setattr(rp_forest, name, value)
    depths = []
    made = rp_forest.Forest.__init__
    monkeypatch.setattr(rp_forest.Forest, "__init__", lambda self, sample, depth: depths.append(depth) or made(self, sample, depth))
    table = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    got = rp_forest.nearest(table, F.col("doc_id") % 20 == 0).collect()
    assert depths[0] >= 2
    rows = table.collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    found, hits, n = defaultdict(set), 0, 0
    for r in got:
        found[r["query_id"]].add(r["vec_id"])
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        true = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        assert len(found[ids[i]]) == 20
        hits, n = hits + len(true & found[ids[i]]), n + 20
    print("recall", sf, hits / n)
    assert hits / n >= 0.9


def simhash(norm):
    votes, words = [0] * 63, norm.split(" ")
    for v, w in zip(words, words[1:]):
        h = xxhash.xxh64_intdigest(w.encode(), seed=xxhash.xxh64_intdigest(v.encode(), seed=42))
        for b in range(63):
            j, i = b % 21, b // 21
            votes[b] += h >> j + 21 * i & 1
    return sum(1 << b for b in range(63) if 2 * votes[b] > len(words) - 1)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_groups(docs):
    import regex

    where = defaultdict(list)
    for i, t in {(r["doc_id"], r["text"]) for r in docs.collect()}:
        for n, line in enumerate((t or "").split("\n")):
            norm = regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ")
            if len(norm.split(" ")) >= 5:
                where[norm].append((i if i is not None else -1, n))
    norms = sorted(where)
    sims, parent = [simhash(n) for n in norms], list(range(len(norms)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(norms)):
        for j in range(i):
            d = sims[i] ^ sims[j]
            if d.bit_count() <= lines_simhash.MOST_BITS and any(d >> at & ((1 << n) - 1) == 0 for at, n in lines_simhash.BLOCKS):
                longer = max(len(norms[i]), len(norms[j]))
                if min(len(norms[i]), len(norms[j])) >= 0.8 * longer and edit_distance(norms[i], norms[j]) <= math.floor(longer * (1 - 0.8)):
                    parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, n in enumerate(norms):
        groups[root(i)] += where[n]
    return sorted((at, at == min(g), min(g)) for g in groups.values() if len(g) > 1 for at in g)


def noisy(rng, line):
    words = line.split(" ")
    for _ in range(rng.randint(0, 2)):
        words[rng.randrange(len(words))] = rng.choice(["zap", "Foo!", "bar"])
    return " ".join(words)


def test_line_groups_against_brute_force(spark):
    rng = random.Random(6)
    base = [" ".join(rng.choice(["ka", "lo", "mi", "Tu"]) + rng.choice(["x", "yo", "zu", "q"]) + str(rng.randint(0, 30)) for _ in range(rng.randint(4, 30))) for _ in range(12)]
    texts = [(i, "\n".join(noisy(rng, rng.choice(base)) for _ in range(rng.randint(0, 6))), "s") for i in range(40)]
    docs = edge_docs(spark, [*texts, (100, None, "s"), (101, "", "s"), (None, base[0], "s"), texts[7], (102, base[1].upper() + "\n \nshort line\nshort line", "s")])
    got = lines_simhash.line_groups(docs).distinct().collect()
    keep = {r["group_id"]: (-1 if r["doc_id"] is None else r["doc_id"], r["line_no"]) for r in got if r["kept"]}
    assert sorted(((-1 if r["doc_id"] is None else r["doc_id"], r["line_no"]), r["kept"], keep[r["group_id"]]) for r in got) == brute_groups(docs)
    assert any(len({r["line_no"] for r in got if r["group_id"] == g}) > 1 for g in keep)


def test_texts_without_repeated_lines(spark):
    line = "this line is here again and again"
    docs = edge_docs(spark, [(1, f"first\n{line}\nlast", "a"), (2, f"{line}!\n{line.upper()}\n\nown words that nobody else would write", "b"), (3, None, "c"), (4, line, "d"), (5, "", "e")])
    out = lines_simhash.without_repeated_lines(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        1: f"first\n{line}\nlast", 2: "\nown words that nobody else would write", 3: None, 4: "", 5: "",
    }
    assert lines_simhash.without_repeated_lines(empty_docs(spark)).count() == 0
    assert lines_simhash.line_groups(edge_docs(spark)).count() > 0


def test_components_are_the_same_in_few_and_in_many_partitions(spark, monkeypatch):
    """A chain, a star, loops and nulls: the number of partitions decides nothing."""
    from corpusmill.llm import components as module

    edges = [(i, i + 1) for i in range(10, 40)] + [(100, x) for x in range(101, 160)] + [(1, 1), (None, 3), (100, 120)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {**{i: 10 for i in range(10, 41)}, **{x: 100 for x in range(100, 160)}}
    for few in (module.FEW_EDGES, 0):
        monkeypatch.setattr(module, "FEW_EDGES", few)
        rows = [(r.node, r.component) for r in module.components(df).collect()]
        assert len(rows) == len(want) and dict(rows) == want
