import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from edge_docs import edge_docs, empty_docs, given
from tokenizers import Tokenizer

import public_tokenizers as public
from corpusmill.llm import mix_lengths, pack_harmonic, shard_slots


def ordered(df, *by):
    return sorted(df.collect(), key=lambda r: tuple((r[c] is None, r[c] or 0) for c in by))


@pytest.mark.parametrize("make", [edge_docs, empty_docs, given])
def test_slots(spark, make):
    docs = make(spark)
    rows = shard_slots.shard_documents(docs, 7, n_slots=64).collect()
    assert len(rows) == docs.count()
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    texts = sorted(r["text"] or "" for r in docs.collect())
    want = sorted((len(t.encode()) + 16, zlib.crc32(t.encode())) for t in texts)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == want


def test_slots_are_near_equal(spark):
    rows = shard_slots.shard_documents(given(spark, "0.01"), 40).collect()
    loads = defaultdict(int)
    for r in rows:
        loads[r["shard"]] += r["size"]
    assert len(loads) == 40 and max(loads.values()) <= 1.02 * sum(loads.values()) / 40


def test_rebalancing_moves_about_one_share_of_bytes(spark):
    rows = shard_slots.sized(given(spark, "0.01"), n_slots=256).cache()
    sizes = shard_slots.slot_bytes(rows)
    one = shard_slots.rebalanced(shard_slots.first_map(spark, 4, 256), sizes, 4).cache()
    two = shard_slots.rebalanced(one, sizes, 5).cache()
    old = {r["virtual_slot"]: r["shard"] for r in one.collect()}
    new = {r["virtual_slot"]: (r["version"], r["shard"]) for r in two.collect()}
    assert {v for v, _ in new.values()} == {3} and {s for _, s in new.values()} == set(range(5))
    size = {r["virtual_slot"]: r["bytes"] for r in sizes.collect()}
    moved = sum(size.get(k, 0) for k, (_, s) in new.items() if old[k] != s)
    assert moved < 0.25 * sum(size.values())


def brute_fit(lengths, counts, budget):
    reach = {0}
    for length, count in zip(lengths, counts):
        reach = {r + k * length for r in reach for k in range(count + 1) if r + k * length <= budget}
    return max(reach)


def test_fitting_counts():
    rng = random.Random(3)
    for _ in range(200):
        lengths = np.array(sorted(rng.sample(range(0, 40), rng.randint(1, 6))))
        counts = np.array([rng.randint(1, 4) for _ in lengths])
        budget = rng.randint(0, int(lengths @ counts))
        got = mix_lengths.fitting_counts(lengths, counts, budget)
        assert (got <= counts).all() and (got >= 0).all()
        assert int(lengths @ got) <= budget
        if budget and lengths.max() > 0:
            proportional = np.where(lengths > 0, (counts * (budget / (lengths @ counts))).astype(int), 0)
            left = budget - int(lengths @ proportional)
            assert budget - int(lengths @ got) == left - brute_fit(lengths, counts - proportional, left)
    big = mix_lengths.fitting_counts(np.arange(1, 5000), np.full(4999, 7), 30_000_001, 1000)
    assert int(np.arange(1, 5000) @ big) == 30_000_001


def filled(sizes, share=1.5, weights=(3, 1, 2), most=2.0):
    """Targets by dealing the rest again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, budget = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while open_:
        level = (budget - sum(target[s] for s in names if s not in open_)) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        for s in full or open_:
            target[s] = most * sizes[s] if full else weight[s] * level
        open_ = open_ - full if full else set()
    return target


@pytest.mark.parametrize("make", [edge_docs, empty_docs, given])
def test_mix(spark, make):
    docs = make(spark)
    rows = mix_lengths.mixed(docs).collect()
    again = mix_lengths.mixed(docs.repartition(5)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in docs.collect():
        sizes[r["source"]] += len((r["text"] or "").encode().split())
    want = filled(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["times"] <= 2
        taken[r["source"]] += r["times"] * r["size"]
    assert len(rows) == docs.count()
    if make is given:
        assert all(abs(taken[s] - want[s]) < 0.02 * want[s] + 2 for s in want)


def test_one_length_is_ranked_in_groups(spark, monkeypatch):
    monkeypatch.setattr(mix_lengths, "RANKED_TOGETHER", 10)
    docs = edge_docs(spark, [(i, "five words are in here", "a" if i < 900 else "b") for i in range(1000)])
    rows = mix_lengths.mixed(docs).collect()
    by_source = {s: sum(r["times"] for r in rows if r["source"] == s) for s in "ab"}
    assert by_source == {"a": 1300, "b": 200}


def test_public_encoder_equals_tokenizer():
    encode = pack_harmonic.public_encoder(
        str(public.path("byte_bpe_50k.json")), str(public.path("byte_bpe_50k.tiktoken")), public.PATTERN
    )
    own = Tokenizer.from_file(str(public.path("byte_bpe_50k.json")))
    rng = random.Random(5)
    parts = ["a", "Word", "it's", " ", " ", "\n", "\t", "12", "…", "é", "世", " ", "<|endoftext|>", "!!", "'", "\r\n", "\x1c"]
    texts = ["", " ", "a\nb", "x \n y", " lead", "trail "] + ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == own.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("make", [edge_docs, empty_docs, given])
def test_pack_round_trip(spark, make):
    docs = make(spark)
    rows = pack_harmonic.packed_with_public_ids(docs, with_ids=True).collect()
    own = Tokenizer.from_file(str(public.path("byte_bpe_50k.json")))
    want = sorted([*own.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs.collect())
    sequences, pieces, padding, total = defaultdict(list), defaultdict(list), 0, 0
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.005 * total
    if make is given:
        got = []
        for parts in pieces.values():
            ids = []
            for start, more, n in sorted(parts):
                assert start == len(ids)
                ids += more
            assert len(ids) == n
            got.append(ids)
        assert sorted(got) == want
    assert sum(r["length"] for r in rows) == sum(map(len, want))
