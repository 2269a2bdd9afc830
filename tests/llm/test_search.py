from __future__ import annotations

import numpy as np
import pytest
from compare import connect, differences

from tideline.llm import search
from tideline.llm.queries import op10_search
from tideline.llm.sql import oracles

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, shard int"


def brute(rows, every=100, k=10):
    kept = {(i, tuple(int(np.floor(1024 * float(np.float32(x)))) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q, a in kept:
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in kept if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in search.search(frame, **options).collect())


def test_sql(spark, folder):
    assert differences(spark, connect(folder), op10_search, oracles()["op10_search"], folder) is None


@pytest.mark.parametrize("shard", [16_384, 40])
def test_brute_force(spark, shard):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=24) * rng.choice([0.01, 1, 30], 24)).tolist()) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(60)]
    assert run(spark, rows, shard=shard) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]),
            (None, [9.0, 9.0]), (6, []), (7, [-0.0001]), (8, [5.0, 1.0, 7.0]), (200, [0.0, 0.0]), (300, None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == []
    assert run(spark, []) == []


def test_the_split_follows_the_bounds(monkeypatch):
    """Skewed components: few terms are essential, fewer as the threshold rises, and most components are never read."""
    monkeypatch.setattr(search, "BLOCK", 100)
    rng = np.random.default_rng(5)
    rows = (rng.normal(size=(3000, 40)) * 300 / (1 + np.arange(40))).astype(np.int64)
    shard = search.Shard(np.arange(3000), rows)
    for q in range(20):
        shard.read = 0
        [(ids, scores)] = shard.tops([q], rows[q:q + 1], 10)
        exact = rows @ rows[q]
        best = sorted((-int(exact[i]), i) for i in range(3000) if i != q)[:10]
        assert list(zip((-scores).astype(int).tolist(), ids.tolist())) == best
        assert shard.read < 0.5 * rows.size


def test_ties_go_to_the_smaller_id_in_every_block(monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 3)
    rows = np.array([[1, 2]] * 20 + [[0, 0]] * 5)
    shard = search.Shard(np.arange(25)[::-1].copy(), rows)
    asked = np.array([[3, 4]] * 4)
    for own, (ids, scores) in zip((0, 7, 24, 99), shard.tops([0, 7, 24, 99], asked, 6)):
        assert ids.tolist() == [i for i in range(5, 25) if i != own][:6] and (scores == 11).all()
    assert shard.tops([1], np.array([[0, 0]]), 4)[0][0].tolist() == [0, 2, 3, 4]


@pytest.mark.parametrize("most", [100, 10**6, 10**12])
def test_values_of_any_width(spark, most):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=4) * most / 1024).round(2).tolist()) for i in range(0, 300, 2)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    got = sorted(tuple(r) for r in search.search(frame, shard=20).collect())
    for q, a in kept:
        if q % 100 == 0 and most < 10**12:  # beyond, products leave the 53 bits that are promised
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in kept if i != q)[:10]
            assert [r for r in got if r[0] == q] == [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert len(got) == 30
