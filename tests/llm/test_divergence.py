from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from cases import ascii_lower, empty_table, odd_rows, odd_table
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import divergence
from tideline.llm.queries import op12_divergence
from tideline.llm.sql import oracles


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_sql(spark, folder, scale):
    folder = folder.replace("sf0.001", scale)
    assert differences(spark, connect(folder), op12_divergence, oracles()["op12_divergence"], folder) is None


def brute(rows, keep, top):
    """rows (lang, source, text)."""
    docs = [(a or "", b or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(t or ""))) for a, b, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held, counts = Counter(), {}
        for one, source, words in docs:
            if one == lang:
                held.update(set(words))
                counts.setdefault(source, Counter()).update(words)
        kept = [w for w, n in held.items() if n >= keep]

        def shares(counter):
            total = sum(counter[w] for w in kept) + 2 * len(kept)
            return {w: 1 + 10**9 * (counter[w] + 2) // total for w in kept}

        q = shares(sum(counts.values(), Counter()))
        p = {s: shares(c) for s, c in counts.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            for part, items in (("pair", [(-sum(f(p[s][w], p[o][w]) for w in kept), o) for o in counts if o != s]),
                                ("term", [(-f(p[s][w], q[w]), w) for w in kept if counts[s][w] and p[s][w] > q[w]])):
                items.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, o, -v, n + 1) for n, (v, o) in enumerate(items) if part == "pair" or n < top]
    return sorted(out)


def run(spark, rows, keep=2, top=3, **options):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, shard int, term string")
    return sorted(tuple(r) for r in divergence.audit(frame, keep=keep, top=top, **options).collect())


def texts(seed, n=120, languages=("en", "de", None), sources=7):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdeéß中"), rng.integers(1, 4))) for _ in range(150)]
    return [(languages[int(rng.integers(len(languages)))], f"s{rng.integers(sources)}", " ".join(rng.choice(words, rng.integers(0, 40))).title())
            for _ in range(n)]


@pytest.mark.parametrize("small", [{}, {"BROADCAST": 2000}, {"CELLS": 300}, {"TILE": 2}, {"CHUNK": 200}])
def test_brute_force(spark, monkeypatch, small):
    for name, value in small.items():
        monkeypatch.setattr(divergence, name, value)
    rows = texts(1)
    assert run(spark, rows, shard=16 if small else 4096) == brute(rows, 2, 3)


def test_odd_rows(spark):
    rows = [(r[2], r[3], r[1]) for r in odd_rows()]
    got = sorted(tuple(r) for r in divergence.audit(odd_table(spark), keep=1, top=4).collect())
    assert got == brute(rows, 1, 4)
    # Without kept terms every pair is at 0 and there are no terms.
    none = sorted(tuple(r) for r in divergence.audit(odd_table(spark)).collect())
    assert none == brute(rows, 10, 10) and {r[2] for r in none} == {"pair"} and {r[4] for r in none} == {0}
    assert divergence.audit(empty_table(spark)).collect() == []


def test_a_long_text_and_very_frequent_terms(spark):
    rows = [("en", "a", "x y " * 600_000)] + [("en", s, "x z y") for s in "abc"] * 3
    assert run(spark, rows) == brute(rows, 2, 3)


@settings(max_examples=40, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6), min_size=1, max_size=300))
def test_perfect_hash(terms):
    terms = sorted(terms)
    seed, found, ordered = divergence.build_shard(terms)
    assert sorted(ordered) == terms
    assert divergence.shard_slots(divergence.hashes(ordered, seed), found, len(terms)).tolist() == list(range(len(terms)))


def test_perfect_hash_of_full_shards_and_of_hashes_alike(monkeypatch):
    terms = [b"%d" % i for i in range(6000)]
    assert len(divergence.build_shard(terms)[2]) == 6000
    real = divergence.hashes
    monkeypatch.setattr(divergence, "hashes", lambda t, seed=42: real(t, seed) // np.uint64(2**63) if seed == 42 else real(t, seed))
    monkeypatch.setattr(divergence, "_TRIALS", 4096)
    assert divergence.build_shard(terms[:50])[0] == 43


def test_other_seeds_are_looked_up(spark, monkeypatch):
    """Shards that needed another seed give the same counts."""
    real = divergence.displacements
    calls = []

    def second(h):
        calls.append(1)
        return None if len(calls) % 2 else real(h)

    rows = [type("Row", (), {})() for _ in range(3)]
    monkeypatch.setattr(divergence, "displacements", second)
    words = [b"w%d" % i for i in range(60)]
    h = divergence.hashes(words)
    for s, row in enumerate(rows):
        own = [w for w, x in zip(words, h.view(np.int64) % 3) if x == s]
        seed, found, ordered = divergence.build_shard(own)
        row.shard, row.n, row.seed, row.displacements = s, len(own), seed, found.astype("<i8").tobytes()
        row.ends, row.terms = np.cumsum([len(t) for t in ordered]).astype("<i8").tobytes(), b"".join(ordered)
    assert {r.seed for r in rows} == {43}
    import pyarrow as pa

    shards = divergence.LanguageShards(3).load(rows)
    asked = [*words, b"other", b"w60"]
    slots = shards.lookup(divergence.hashes(asked), pa.array(asked, pa.large_binary()))
    assert sorted(slots[:60].tolist()) == list(range(60)) and slots[60:].tolist() == [-1, -1]


def test_shares_are_exact_for_huge_counts():
    counts = np.array([0, 5, 10**10, 3 * 10**14], np.int64)
    assert divergence._share(counts, int(counts.sum()), 4).tolist() == [1 + 10**9 * (int(c) + 2) // (int(counts.sum()) + 8) for c in counts]
