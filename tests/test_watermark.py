from __future__ import annotations

import random

import pytest
from data import DISORDERED, IN_ORDER, arrivals, at
from pyspark.sql import functions as F

from tideline.operators.ordered import ordered_parts, ordered_reduce
from tideline.operators.watermark import replay_watermark, split_late, tag_late, window_firings
from tideline.operators.windows import BOUNDS


def reduced(spark, seconds, delay):
    df = arrivals(spark, seconds)
    on_time, late = split_late(df, "ts", "seq", "5 seconds", delay)
    out = ordered_reduce(on_time, "k", "seq", "v", BOUNDS).orderBy("window_start").collect()
    return [(r.label, r.total) for r in out], [r.v for r in late.orderBy("seq").collect()]


def test_reduce_in_order(spark):
    got, late = reduced(spark, IN_ORDER, "0 seconds")
    assert got == [("a_4", 5), ("a_6", 11), ("a", 10), ("a", 20)]
    assert late == [4]


def test_reduce_with_disorder(spark):
    got, late = reduced(spark, DISORDERED, "2 seconds")
    assert got[:3] == [("a", 1), ("a_6_7", 18), ("a_12_10", 32)]
    assert late == [3, 4, 9, 8]


def test_open_window_does_not_fire(spark):
    df = arrivals(spark, IN_ORDER)
    fired = window_firings(df, "ts", "seq", "5 seconds", value="v", keys=["k"])
    assert [(r.firing, r.rows, r.total) for r in fired.orderBy("window_start").collect()] == [(1, 2, 5), (1, 2, 11), (1, 1, 10)]
    assert window_firings(df, "ts", "seq", "5 seconds", value="v", keys=["k"], flush=True).count() == 4


def test_lateness_fires_again(spark):
    # 12 closes [0, 5) and [5, 10); 3 and 9 come within 10 s of lateness, the 2 after 40 does not.
    df = arrivals(spark, [1, 6, 12, 3, 9, 4, 40, 2])
    fired = window_firings(df, "ts", "seq", "5 seconds", "0 seconds", "10 seconds", value="v", keys=["k"], flush=True)
    got = [(int((r.window_start - at(0)).total_seconds()), r.firing, r.rows, r.total) for r in fired.orderBy("window_start", "firing").collect()]
    assert got == [(0, 1, 1, 1), (0, 2, 2, 4), (0, 3, 3, 8), (5, 1, 1, 6), (5, 2, 2, 15), (10, 1, 1, 12), (40, 1, 1, 40)]


def test_first_row_of_a_closed_window_fires_it(spark):
    df = arrivals(spark, [12, 3, 4])
    fired = window_firings(df, "ts", "seq", "5 seconds", "0 seconds", "10 seconds", value="v", keys=["k"])
    assert [(r.firing, r.rows, r.total) for r in fired.orderBy("firing").collect()] == [(1, 1, 3), (2, 2, 7)]


def test_watermark_values(spark):
    df = replay_watermark(arrivals(spark, [5, 3, 9]), "ts", "seq", "2 seconds").orderBy("seq")
    assert [r.wm_before for r in df.collect()] == [None, at(2.999), at(2.999)]
    each = replay_watermark(arrivals(spark, [5, 3, 9]), "ts", "seq", per_event=True).orderBy("seq")
    assert [r.wm_before for r in each.collect()] == [None, at(5), at(5)]


def test_per_event_watermark_is_one_millisecond_ahead(spark):
    df = arrivals(spark, [1, 4.999, 2])
    late = lambda **kw: [r.is_late for r in tag_late(df, "ts", "seq", "5 seconds", **kw).orderBy("seq").collect()]
    assert late() == [False, False, False]
    assert late(per_event=True) == [False, False, True]


def test_going_on_from_an_earlier_part(spark):
    df = arrivals(spark, [3, 8])
    _, late = split_late(df, "ts", "seq", "5 seconds", start_max=at(6))
    assert [r.v for r in late.collect()] == [3]


def judge(rows, size, delay, lateness):
    """Definition, row by row."""
    top, late = None, []
    for seq, second in rows:
        end = second // size * size + size
        if top is not None and end + lateness <= top - delay:
            late.append(seq)
        top = second if top is None else max(top, second)
    return late


@pytest.mark.parametrize("bits", [16, 4, 1])
def test_split_equals_row_by_row(spark, bits):
    rng = random.Random(bits)
    seconds = [max(0, i // 3 + rng.randrange(-30, 6)) for i in range(400)]
    df = arrivals(spark, seconds)
    _, late = split_late(df, "ts", "seq", "5 seconds", "4 seconds", "3 seconds", bucket_bits=bits)
    assert sorted(r.seq for r in late.collect()) == judge(list(enumerate(seconds)), 5, 4, 3)


def test_reduce_in_parts(spark):
    df = arrivals(spark, list(range(50)))
    whole = ordered_reduce(df, "k", "seq", "v", part_bits=3).first()
    assert whole.label == "a_" + "_".join(map(str, range(1, 50))) and whole.total == sum(range(50))
    parts = ordered_parts(df, "k", "seq", "v", part_bits=3).orderBy("part").collect()
    assert "_".join(p.piece for p in parts) == "_".join(map(str, range(50)))
    assert max(p.rows for p in parts) == 8


def test_rows_without_time_are_in_no_window(spark):
    df = arrivals(spark, [1, 2]).withColumn("ts", F.when(F.col("v") == 1, F.col("ts")))
    assert tag_late(df, "ts", "seq", "5 seconds").count() == 1
