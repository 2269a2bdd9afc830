"""Streams with retractions, windows that fire with their rows, and state without a watermark filter."""

from __future__ import annotations

import os
import random

import pandas as pd
import pyarrow as pa
import pytest
from data import DISORDERED, IN_ORDER, arrivals, at
from pyspark.sql import functions as F

from tideline.operators.changelog import agg_changelog
from tideline.operators.ids import EPOCH_MS
from tideline.operators.watermark import window_firings
from tideline.streaming.changelog import PACK, _pack, _Retract, changelog_stream
from tideline.streaming.dedup import dedup_interval_stream
from tideline.streaming.firing import each_firing, fired_window_rows_stream
from tideline.streaming.ids import assign_ids_stream
from tideline.streaming.replay import replay, replay_into


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("agg,cuts", [("sum", [0]), ("sum", [0, 13, 14, 60]), ("max", [0, 30]), ("count", [0, 50])])
def test_changelog_for_any_cut_into_batches(rocksdb, agg, cuts):
    rng = random.Random(len(cuts))
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([0, 1, 2**53 + 1, -5, None]), sum(i >= c for c in cuts) - 1) for i in range(90)]
    table = rocksdb.createDataFrame(rows, "k string, seq bigint, v bigint, part int")
    got = replay(table, "part", len(cuts), lambda s: changelog_stream(s, "k", "seq", "v", agg))
    expected = agg_changelog(table, "k", "seq", "v", agg)
    assert got.columns == expected.columns and bag(got) == bag(expected)


def test_retractions_take_rows_back(rocksdb):
    rows = [("a", 0, 1, 5), ("a", 1, 1, 3), ("b", 2, -1, 7), ("a", 3, -1, 5), ("a", 4, 1, 0), ("a", 5, -1, 3), ("a", 6, -1, 0), ("a", 7, 1, None),
            ("a", 8, 1, 9), ("a", 9, -1, None), ("a", 10, -1, 9)]
    for cuts in ([0], [0, 3, 5, 6, 9]):
        table = rocksdb.createDataFrame([(*r, sum(r[1] >= c for c in cuts) - 1) for r in rows], "k string, seq bigint, s int, v bigint, part int")
        got = replay(table, "part", len(cuts), lambda s: changelog_stream(s, "k", "seq", "v", sign="s"))
        assert [(r.change_seq, r.row_kind, r.result) for r in got.orderBy("change_seq").collect()] == [
            (1, "+I", 5), (2, "-U", 5), (3, "+U", 8), (6, "-U", 8), (7, "+U", 3), (10, "-U", 3), (11, "+U", 0), (12, "-D", 0),
            (15, "+I", None), (16, "-U", None), (17, "+U", 9), (20, "-D", 9)]


def test_changelog_of_doubles_and_bad_calls(rocksdb):
    table = rocksdb.createDataFrame([(7, 0, 0.5, 0), (7, 1, None, 0), (7, 2, 0.25, 0)], "k bigint, seq bigint, v double, part int")
    got = replay(table, "part", 1, lambda s: changelog_stream(s, "k", "seq", "v"))
    assert bag(got) == bag(agg_changelog(table, "k", "seq", "v"))
    with pytest.raises(ValueError):
        changelog_stream(table, "k", "seq", "v", "max", sign="part")
    with pytest.raises(ValueError):
        changelog_stream(table, "k", "seq", "v", "avg")


class Entries:
    """A list state in memory that counts its calls."""

    def __init__(self):
        self.kept, self.calls = [], 0

    def getListState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return iter(list(self.kept))

    def clear(self):
        self.calls += 1
        self.kept = []

    def appendValue(self, value):
        self.calls += 1
        self.kept.append(value)


def test_many_keys_take_few_calls_into_the_state():
    state, changes = Entries(), _Retract("sum", "bigint")
    changes.init(state)

    def batch(first, sign, keys):
        frame = pd.DataFrame({"key": [str(k) for k in keys], "seq": range(first, first + len(keys)), "sign": sign, "present": True, "value": 5})
        return pd.concat(changes.handleInputRows((0,), iter([frame]), None))

    assert batch(0, 1, range(2500))["row_kind"].tolist() == ["+I"] * 2500
    assert state.calls <= 5 and max(len(keys) for keys, *_ in state.kept) <= 1000
    assert batch(2500, 1, range(2500))["result"].tolist() == [5, 10] * 2500
    assert batch(5000, -1, [*range(2499), *range(2499)])["row_kind"].tolist() == ["-U", "+U"] * 2499 + ["-D"] * 2499
    assert state.kept == [(["2499"], [2], [2], [10])] and state.calls <= 15


@pytest.mark.parametrize("agg,key,absent", [("sum", "bigint", False), ("sum", "string", True), ("count", "bigint", True), ("count", "string", False)])
def test_changes_at_once_are_those_row_by_row(agg, key, absent):
    rng, both, walked = random.Random(agg + key), [Entries(), Entries()], 0
    at_once, by_row = _Retract(agg, "bigint", key), _Retract(agg, "bigint", key)
    at_once.init(both[0])
    by_row.init(both[1])
    by_row._at_once = lambda kept, batch: None
    there, seq = [], 0
    for _ in range(40):
        rows = []
        for _ in range(rng.choice([1, 5, 60])):
            k = rng.randrange(8)
            row = (k if key == "bigint" else str(k), rng.random() < 0.7, rng.choice([0, 3, -3, 2**53 + 1]))
            row = (*row[:2], row[2] if row[1] else 0)
            if there and rng.random() < 0.5:
                rows.append((*there.pop(rng.randrange(len(there))), seq, -1))
            elif absent and rng.random() < 0.02:
                rows.append((*row, seq, -1))
            else:
                there.append(row)
                rows.append((*row, seq, 1))
            seq += 1
        frame = pd.DataFrame(rng.sample(rows, len(rows)), columns=["key", "present", "value", "seq", "sign"])
        kept = [[c for piece in both[0].kept for c in piece[i]] for i in range(4)]
        walked += at_once._at_once(kept, frame.sort_values("seq")) is None
        got, expected = (list(p.handleInputRows((0,), iter([frame]), None)) for p in (at_once, by_row))
        texts = [[[str(v) for v in row] for f in frames for row in f.values.tolist()] for frames in (got, expected)]
        assert texts[0] == texts[1]
        states = [sorted(row for piece in entries.kept for row in zip(*piece)) for entries in both]
        assert states[0] == states[1]
    assert walked < 40 and (absent or walked == 0)


def test_totals_beyond_64_bits_are_an_error_still():
    changes = _Retract("sum", "bigint")
    changes.init(Entries())
    frame = pd.DataFrame({"key": ["a", "a"], "seq": [0, 1], "sign": 1, "present": True, "value": [2**63 - 1, 1]})
    with pytest.raises(OverflowError):
        list(changes.handleInputRows((0,), iter([frame]), None))


def test_rows_reach_the_state_packed():
    n = 30_000
    batches = [pa.RecordBatch.from_pydict({"group": pa.array([i % 7 for i in range(a, a + 10_000)], pa.int32()), "key": list(range(a, a + 10_000)),
                                           "seq": list(range(a, a + 10_000)), "sign": [1] * 10_000, "present": [True] * 10_000,
                                           "value": [i * 3 for i in range(a, a + 10_000)]}) for a in range(0, n, 10_000)]
    rows = [r for out in _pack(iter(batches)) for r in out.to_pylist()]
    assert len(rows) <= n // PACK + 7 and max(len(r["seq"]) for r in rows) <= PACK
    assert sorted((r["group"], *one) for r in rows for one in zip(r["key"], r["seq"], r["value"])) == sorted((i % 7, i, i, 3 * i) for i in range(n))
    assert all(r["seq"] == sorted(r["seq"]) for r in rows) and list(_pack(iter([]))) == []


def test_null_and_large_whole_keys_and_few_partitions_of_state(rocksdb):
    rows = [(None, 0, 1, 4, 0), (0, 1, 1, 5, 0), (2**62 + 1, 2, 1, 6, 0), (None, 3, 1, 1, 1), (0, 4, -1, 5, 1), (2**62 + 1, 5, 1, None, 1)]
    table = rocksdb.createDataFrame(rows, "k bigint, seq bigint, s int, v bigint, part int")
    rocksdb.conf.set("spark.sql.shuffle.partitions", "50")  # put back by the fixture

    def sink(stream, folder):
        out = changelog_stream(stream, "k", "seq", "v", sign="s").writeStream.format("parquet").option("path", f"{folder}/out")
        return out.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True)

    folder = replay_into(table, "part", 2, sink, per_core=1)
    assert rocksdb.conf.get("spark.sql.shuffle.partitions") == "50"
    assert bag(rocksdb.read.parquet(f"{folder}/out")) == sorted(
        [(None, 1, "+I", 4), (0, 3, "+I", 5), (2**62 + 1, 5, "+I", 6), (None, 6, "-U", 4), (None, 7, "+U", 5), (0, 8, "-D", 5)], key=repr)
    state = folder.removeprefix("file:") + "/cp/state/0"
    assert sum(name.isdigit() for name in os.listdir(state)) == rocksdb.sparkContext.defaultParallelism


def brute_firings(batches, size, delay, lateness):
    """{(firing, window end): rows} and the late rows; batches of (seq, second), judged by the watermark of the batches before."""
    windows, fired, out, late, top = {}, {}, {}, [], None

    def due():
        for end in sorted(windows):
            if fired[end] == 0 and top is not None and end <= top - delay:
                fired[end] = 1
                out[1, end] = list(windows[end])

    for batch in batches:
        due()
        for seq, second in batch:
            end = second // size * size + size
            if top is not None and end + lateness <= top - delay:
                late.append(seq)
                continue
            windows.setdefault(end, []).append(seq)
            fired.setdefault(end, 0)
            if top is not None and end <= top - delay:
                fired[end] += 1
                out[fired[end], end] = list(windows[end])
        top = max([s for _, s in batch] + ([] if top is None else [top]))
    due()
    return out, late


def firings(spark, batches, size, delay, lateness, piece=2):
    rows = [(seq, "a", at(second), n) for n, batch in enumerate(batches) for seq, second in batch]
    table = spark.createDataFrame(rows, "seq bigint, k string, ts timestamp_ntz, part int")
    got = replay(table, "part", len(batches), lambda s: fired_window_rows_stream(
        s, ["k"], "ts", "seq", f"{size} seconds", f"{delay} seconds", f"{lateness} seconds", piece)).collect()
    out = {}
    for r in sorted(got):
        if r.firing:
            out.setdefault((r.firing, int((r.window_end - at(0)).total_seconds())), []).append(r.seq)
    return out, sorted(r.seq for r in got if r.firing == 0)


@pytest.mark.parametrize("seconds,delay,lateness", [(IN_ORDER, 0, 0), (DISORDERED, 2, 0), (DISORDERED, 2, 4)])
def test_worked_examples_in_three_batches(rocksdb, seconds, delay, lateness):
    rows = list(enumerate(seconds))
    batches = [rows[:4], rows[4:8], rows[8:]]
    out, late = brute_firings(batches, 5, delay, lateness)
    got, got_late = firings(rocksdb, batches, 5, delay, lateness)
    assert got == {k: sorted(v) for k, v in out.items()} and got_late == late
    if lateness:
        assert any(f > 1 for f, _ in got)


def test_a_row_leaves_the_state_once_a_batch_however_often_its_window_fires(rocksdb):
    """40 rows in time, then 30 and 20 late ones: 40 + 30 and 90 spans, and all rows of 50 more firings of them."""
    rows = [(n, "a", at(1), 0) for n in range(40)] + [(40, "b", at(9), 0)]
    rows += [(n, "a", at(2), 1 if n < 80 else 2) for n in range(50, 100)]
    table = rocksdb.createDataFrame(rows, "seq bigint, k string, ts timestamp_ntz, part int")
    spans = replay(table, "part", 3, lambda s: fired_window_rows_stream(s, ["k"], "ts", "seq", "5 seconds", lateness="60 seconds", piece=7, spans=True))
    assert spans.filter("k = 'a'").count() <= 40 + 70 + 90
    expected = [(n, f) for f in range(1, 52) for n in [*range(40), *range(50, 49 + f)]]
    for task_rows in (100, 10_000_000):
        got = each_firing(spans, task_rows, 4).filter("k = 'a'")
        assert sorted((r.seq, r.firing) for r in got.collect()) == sorted(expected)
    assert each_firing(spans, 100, 4).rdd.getNumPartitions() >= len(expected) // 100


def test_row_by_row_it_equals_the_replayed_windows(rocksdb):
    """With one row a batch, the watermark of the batches before is that of the rows before."""
    seconds = [1, 7, 3, 12, 9, 4, 18]
    got, _ = firings(rocksdb, [[r] for r in enumerate(seconds)], 5, 0, 6)
    table = arrivals(rocksdb, seconds)
    expected = window_firings(table, "ts", "seq", "5 seconds", "0 seconds", "6 seconds", value="v", keys=["k"]).collect()
    assert {k: len(v) for k, v in got.items()} == {(r.firing, int((r.window_end - at(0)).total_seconds())): r.rows for r in expected}


def test_a_replay_counts_no_rows_of_the_state_and_leaves_the_session_as_it_was(spark):
    name, seen = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", []
    before = spark.conf.get(name, None)
    table = spark.createDataFrame([(1, 0), (2, 1)], "n bigint, part int")
    got = replay(table, "part", 2, lambda s: seen.append(spark.conf.get(name)) or s)
    assert bag(got) == [(1,), (2,)] and seen == ["false"] * 2 and spark.conf.get(name, None) == before


def test_a_late_row_of_a_new_key_passes(rocksdb):
    stamps = [("a", 0, 0), ("b", 1000, 1), ("b", 2000, 2), ("c", 5, 3), ("b", 2010, 3), ("a", 7, 4), ("c", 2005, 4)]
    table = rocksdb.createDataFrame([(k, at(s), n, p) for n, (k, s, p) in enumerate(stamps)], "k string, ts timestamp_ntz, n bigint, part int")
    got = replay(table, "part", 5, lambda s: dedup_interval_stream(s, ["k"], "ts", "60 seconds", "n"))
    # a's state is gone when row 5 comes; so is c's when row 6 comes; b is still held back at row 4.
    assert sorted(r.n for r in got.collect()) == [0, 1, 2, 3, 5, 6]
    assert got.filter(F.col("k") == "c").count() == 2


def test_ids_stay_unique_over_batches_and_early_rows(rocksdb):
    """A crowded millisecond, rows earlier than those before, two workers, three runs: ids as a clock that never goes back gives them."""
    rng = random.Random(5)
    base = 1_700_000_000_000
    rows = [(n, base + rng.choice([0, 1, 2, 40]) - 30 * (part == 1), rng.randrange(2), part) for part in range(3) for n in range(part * 6000, part * 6000 + 6000)]
    table = rocksdb.createDataFrame(rows, "n bigint, ms bigint, w int, part int").withColumn("ts", F.timestamp_millis("ms"))
    got = replay(table, "part", 3, lambda s: assign_ids_stream(s, "ts", F.col("w"), "n"))
    free, expected = {}, {}
    for n, ms, w, part in sorted(rows, key=lambda r: (r[3], r[1], r[0])):
        slot = max(free.get(w, 0), ms * 4096)
        free[w] = slot + 1
        expected[n] = (slot // 4096 - EPOCH_MS << 22) | (w << 12) | slot % 4096
    assert {r.n: r.id for r in got.collect()} == expected and len(set(expected.values())) == len(rows)
