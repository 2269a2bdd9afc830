from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import whitening
from tideline.llm.queries import op11_whitening

SCHEMA = "vec_id bigint, embedding array<float>, x string, component int, cross double"


def brute(rows):
    """{vec_id: (deviation, x)}, n, explained, and the covariance, in Python integers and plain numpy."""
    kept = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(x) for _, x in kept)
    kept = [(i, tuple(x + [0] * (width - len(x)))) for i, x in kept]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(x[d] for x in fit) for d in range(width)]
    centred = np.array([[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit) / n**3 for j in range(width)] for i in range(width)])
    return kept, n, sums, centred


def check(got, rows, components=4):
    kept, n, sums, cov = brute(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    k = len(values)
    assert len(got) == len(kept) * k
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append(r)
    signs = {}
    for i, x in kept:
        own = [r for r in by_id[i] if r.deviation == sum((n * a - b) ** 2 for a, b in zip(x, sums))]
        assert {r.component for r in own} == set(range(1, k + 1))
        for r in own:
            e = values[r.component - 1]
            if e <= 1e-12 * values[0]:
                assert r.whitened == r.explained == 0
                continue
            assert r.explained == pytest.approx(e / np.trace(cov), rel=1e-9)
            want = (np.array(x) - np.array(sums) / n) @ vectors[:, r.component - 1] / np.sqrt(e)
            if abs(want) > 1e-6:
                sign = signs.setdefault(r.component, np.sign(want * r.whitened))
                assert r.whitened == pytest.approx(sign * want, rel=1e-6, abs=1e-9)


def run(spark, rows, **options):
    return whitening.whiten(spark.createDataFrame([(i, v, "x", 1, 2.0) for i, v in rows], SCHEMA), **options).collect()


@pytest.mark.parametrize("block", [whitening.BLOCK, 64])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK", block)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 9)) * np.array([3, 2, 1.5, 1, 0.7, 0.5, 0.3, 0.2, 0.01]) + rng.normal(size=9) * 5
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[7].tolist()) for i in range(200)]
    check(run(spark, rows), rows)


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = op11_whitening(spark, folder)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]),
            (None, [9.0, 9.0]), (6, []), (7, [-0.0001]), (8, [5.0, 1.0, 7.0]), (8, [-0.0, 0.0, 1.0])]
    check(run(spark, rows), rows)
    single = run(spark, rows[:1])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in single] == [
        (1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]
    assert run(spark, []) == run(spark, rows[3:7]) == run(spark, [(6, [])]) == []


def test_wide_values(spark):
    """Sums of squares beyond 64 bits stay exact; a deviation that needs more than 64 bits is NULL."""
    rows = [(0, [1e9, 0.0]), (1, [-1e9, 2.0]), (2, [5.0, 3.0]), (3, [0.0, 0.0])]
    got = run(spark, rows)
    kept, n, sums, cov = brute(rows)
    for r in got:
        want = sum((n * a - b) ** 2 for a, b in zip(dict(kept)[r.vec_id], sums))
        assert r.deviation == (want if want < 2**63 else None)
    assert {r.identity_error < 1e-9 for r in got} == {True} and any(r.deviation is None for r in got)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 6), st.sampled_from([1, 3, 200, 1 << 20, 1 << 45, (1 << 62)]), st.integers(0, 10**6))
def test_scatter_is_exact(rows, width, most, seed):
    x = np.random.default_rng(seed).integers(-most, most, (rows, width), endpoint=True)
    full = np.concatenate([x, np.ones((rows, 1), np.int64)], 1).astype(object)
    assert (whitening.scatter(x) == full.T @ full).all()
