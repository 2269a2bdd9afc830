"""Watermarks of several sources with idle time-outs."""

from __future__ import annotations

import random

import pytest
from compare import connect, differences
from data import at
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.operators.idle import idle_watermark
from tideline.plans.oracles import oracles
from tideline.plans.queries import registered

SCHEMA = "seq bigint, source string, ts timestamp_ntz, arrival timestamp_ntz, _v string, x int"


def brute(rows, timeout):
    """{seq: least event time of the awake sources, the highest so far}; rows (seq, source, second, arrival)."""
    rows = sorted(rows, key=lambda r: (r[3], r[0]))
    begin = rows[0][3]
    value, seen = {r[1]: None for r in rows}, {r[1]: begin for r in rows}
    asleep, mark, out = set(), None, {}

    def look():
        nonlocal mark
        awake = [value[s] for s in value if s not in asleep]
        if awake and None not in awake:
            mark = min(awake) if mark is None else max(mark, min(awake))

    for seq, source, second, arrival in rows:
        for t in sorted({seen[s] + timeout for s in value if s not in asleep and seen[s] + timeout < arrival}):
            look()
            asleep |= {s for s in value if seen[s] + timeout == t}
        look()
        out[seq] = mark
        asleep.discard(source)
        seen[source] = arrival
        if second is not None:
            value[source] = second if value[source] is None else max(value[source], second)
    return out


def marks(spark, rows, timeout, **options):
    frame = spark.createDataFrame([(q, s, None if t is None else at(t), at(a), "own", 1) for q, s, t, a in rows], SCHEMA)
    got = idle_watermark(frame, "ts", "source", "arrival", "seq", f"{timeout} seconds", "2 seconds", **options)
    assert got.columns == [*frame.columns, "wm_before"]
    return {r.seq: r.wm_before for r in got.collect()}


def expected(rows, timeout):
    return {q: None if m is None else at(m - 2.001) for q, m in brute(rows, timeout).items()}


def test_a_silent_source_holds_the_watermark_until_its_time_out(spark):
    rows = [(0, "a", 0, 0), (1, "b", 1, 1), (2, "a", 5, 5), (3, "a", 9, 9), (4, "a", 11, 11), (5, "a", 12, 12), (6, "b", 2, 20), (7, "a", 21, 21)]
    got = marks(spark, rows, 10)
    # b falls asleep after 11; row 6 wakes it, and the watermark stays where it was.
    assert got == {0: None, 1: None, 2: at(-2.001), 3: at(-1.001), 4: at(-1.001), 5: at(8.999), 6: at(9.999), 7: at(9.999)}
    assert got == expected(rows, 10)


def test_a_source_without_rows_yet_holds_it_too(spark):
    rows = [(0, "a", 0, 0), (1, "a", 8, 8), (2, "a", 11, 11), (3, "late", 3, 40), (4, "a", 41, 41), (5, None, 1, 42), (6, "a", None, 43)]
    got = marks(spark, rows, 10)
    assert got[1] is None and got[2] == at(5.999)
    assert got == expected(rows, 10)


@pytest.mark.parametrize("bits,sources", [(16, 3), (3, 1), (3, 40), (1, 3)])
def test_equals_row_by_row(spark, bits, sources):
    rng = random.Random(bits * 100 + sources)
    rows, now = [], 0
    for seq in range(300):
        now += rng.choice([0, 0, 1, 1, 2, 3, 25])
        rows.append((seq, f"s{min(rng.randrange(sources), rng.randrange(sources))}", None if rng.random() < 0.05 else now - rng.randrange(15), now))
    rng.shuffle(rows)
    assert marks(spark, rows, 12, bucket_bits=bits, fold_bits=2) == expected(rows, 12)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 30), st.integers(0, 9)), min_size=1, max_size=25), st.integers(1, 12))
def test_any_rows(spark, steps, timeout):
    now, rows = 0, []
    for seq, (source, second, gap) in enumerate(steps):
        now += gap
        rows.append((seq, source, second, now))
    assert marks(spark, rows, timeout, bucket_bits=2) == expected(rows, timeout)


def test_empty(spark):
    assert marks(spark, [], 5) == {}


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query(spark, scale):
    folder = f"/root/testdata/{scale}"
    assert differences(spark, connect(folder), registered()["idle_sources_late"], oracles()["idle_sources_late"], folder) is None
