"""Structured Streaming forms, fed from files, compared with the batch forms on the same rows."""

from __future__ import annotations

import datetime as dt
import os
import time

from data import BASE, DISORDERED, arrivals, at, lines
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import parse_pairs
from tideline.operators import keyed_table as K
from tideline.operators import windows
from tideline.operators.dedup import dedup_interval
from tideline.sources.tables import TableSpec, processing_time
from tideline.sources.text import text_stream
from tideline.streaming import dedup as SD
from tideline.streaming import late, sinks
from tideline.streaming import windows as SW
from tideline.streaming.cumulate import cumulate_steps_stream


class Feed:
    """A folder of Parquet files, replayed one file per micro-batch in the order they were added."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.count = spark, str(path), schema, 0
        os.makedirs(self.path, exist_ok=True)

    def add(self, rows):
        self.count += 1
        folder = f"{self.path}/../staged-{self.count}"
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(folder)
        [part] = [f for f in os.listdir(folder) if f.endswith(".parquet")]
        target = f"{self.path}/{self.count:04d}.parquet"
        os.link(f"{folder}/{part}", target)
        os.utime(target, (1_600_000_000 + self.count,) * 2)
        return self

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def run(df, name, mode, checkpoint):
    query = (df.writeStream.format("memory").queryName(name).outputMode(mode)
             .option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start())
    query.awaitTermination()
    return df.sparkSession.table(name)


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


EVENT = "ts timestamp_ntz, id bigint"


def test_pv_uv_stream_equals_batch(rocksdb, tmp_path):
    feed = Feed(rocksdb, tmp_path / "in", EVENT)
    rows = [(at(s), s % 7 if s % 5 else None) for s in range(0, 100, 2)]
    feed.add(rows[:20]).add(rows[20:]).add([(at(10_000), 1)])
    got = run(SW.pv_uv_stream(feed.stream(), "ts", "id", "30 seconds"), "pvuv", "append", tmp_path / "cp")
    expected = windows.pv_uv(windows.tumble(rocksdb.createDataFrame(rows, EVENT), "ts", "30 seconds"), "id")
    assert bag(got) == bag(expected)


def test_multi_window_stream(rocksdb, tmp_path):
    feed = Feed(rocksdb, tmp_path / "in", EVENT)
    rows = [(at(s), s % 3) for s in range(0, 60, 5)]
    feed.add(rows).add([(at(5_000), 1)])
    df = SW.multi_window_pv_uv_stream(feed.stream(), "ts", "id", ["10 seconds", "20 seconds", "30 seconds"])
    got = run(df, "multi", "append", tmp_path / "cp").select("window_size", "window_start", "window_end", "pv", "uv")
    expected = windows.multi_window_pv_uv(rocksdb.createDataFrame(rows, EVENT), "ts", "id", ["10 seconds", "20 seconds", "30 seconds"])
    assert bag(got) == bag(expected.select(*got.columns))


def test_multi_window_stream_drops_late_rows_like_a_single_size(rocksdb, tmp_path):
    feed = Feed(rocksdb, tmp_path / "in", EVENT)
    feed.add([(at(s), s % 4) for s in (1, 5, 9, 12)]).add([(at(31), 1), (at(8), 9), (None, 3)]).add([(at(11), 7), (at(40), None)]).add([(at(500), 1)])
    sizes = ["10 seconds", "30 seconds"]
    df = SW.multi_window_pv_uv_stream(feed.stream(), "ts", "id", sizes, "2 seconds")
    got = run(df, "fanned", "append", tmp_path / "cp")
    for n, size in enumerate(sizes):
        one = run(SW.pv_uv_stream(feed.stream(), "ts", "id", size, "2 seconds"), f"single{n}", "append", tmp_path / f"cp{n}")
        assert bag(got.filter(F.col("window_size") == size).select(*one.columns)) == bag(one)
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("StreamingRelation") == 1


def test_early_results_of_an_open_day(rocksdb, tmp_path):
    feed = Feed(rocksdb, tmp_path / "in", EVENT)
    feed.add([(at(0), 1), (at(1), 1)]).add([(at(2), 2), (at(3), None)])
    got = run(SW.pv_uv_early(feed.stream(), "ts", "id", "1 day", offset="-8 hours"), "early", "update", tmp_path / "cp")
    assert bag(got.select("measure", "value")) == [("pv", 2), ("pv", 3), ("uv", 1), ("uv", 2)]
    assert got.first().window_start == at(-8 * 3600)


def test_native_watermark_is_one_batch_behind(rocksdb, tmp_path):
    """One row per batch: the native form still takes the late 3, unlike the row-exact replay."""
    feed = Feed(rocksdb, tmp_path / "in", "k string, v bigint, ts timestamp_ntz, seq bigint")
    for row in arrivals(rocksdb, DISORDERED).orderBy("seq").collect():
        feed.add([tuple(row)])
    df = SW.window_stats_stream(feed.stream(), ["k"], "ts", "v", "5 seconds", "2 seconds")
    got = run(df, "native", "append", tmp_path / "cp")
    assert [r["sum"] for r in got.orderBy("window_start").collect()] == [4, 18, 32]


def test_update_mode_shows_a_window_again_within_lateness(rocksdb, tmp_path):
    feed = Feed(rocksdb, tmp_path / "in", "k string, v bigint, ts timestamp_ntz, seq bigint")
    for second in (1, 7, 3, 30, 2, 31):
        feed.add([("a", second, at(second), second)])
    df = SW.window_stats_stream(feed.stream(), ["k"], "ts", "v", "5 seconds", lateness="10 seconds")
    got = run(df, "again", "update", tmp_path / "cp")
    first = got.filter(F.col("window_start") == F.lit(BASE)).orderBy("counts")
    # The 2 comes one batch after the 30 and is judged by the watermark before it; 31 closes the window.
    assert [r["sum"] for r in first.collect()][:2] == [1, 4]


def test_distinct_per_hour_stream(rocksdb, tmp_path):
    feed = Feed(rocksdb, tmp_path / "in", "slot string, ts timestamp_ntz, device string")
    feed.add([("s", at(1), "d1"), ("s", at(2), "d1"), ("s", at(3), "d2"), ("t", at(4), "d1")]).add([("s", at(3700), "d1")]).add([("s", at(20_000), "d9")])
    got = run(SW.distinct_per_hour_stream(feed.stream(), "slot", "ts", "device"), "devices", "append", tmp_path / "cp")
    assert bag(got) == sorted([("s", at(3600), 2), ("s", at(7200), 1), ("t", at(3600), 1)], key=repr)


def test_dedup_stream_equals_batch(rocksdb, tmp_path):
    schema = "k string, ts timestamp_ntz, n bigint"
    feed = Feed(rocksdb, tmp_path / "in", schema)
    stamps = [("a", 0), ("b", 10), ("a", 30), ("a", 59), ("a", 60), ("b", 71), ("a", 100), ("a", 119), ("a", 121), ("b", 5000), ("a", 5001), ("a", 5030)]
    rows = [(k, at(s), i) for i, (k, s) in enumerate(stamps)]
    for start in range(0, len(rows), 3):
        feed.add(rows[start:start + 3])
    got = run(SD.dedup_interval_stream(feed.stream(), ["k"], "ts", "60 seconds", "n"), "dedup", "append", tmp_path / "cp")
    expected = dedup_interval(rocksdb.createDataFrame(rows, schema), ["k"], "ts", "60 seconds", "n")
    assert bag(got.select("k", "n")) == bag(expected.select("k", "n"))


def test_dedup_stream_keeps_numbers_exact(rocksdb, tmp_path):
    schema = "k bigint, ts timestamp_ntz, n bigint, extra bigint, z timestamp, d double, nest struct<x: bigint>"
    big, fine = 2**60 + 1, at(0.123457)
    rows = [(big, fine, 0, big, fine, 0.1, (big,)), (big + 1, at(1), 1, None, None, None, (None,)),
            (None, at(2), 2, 7, fine, float("inf"), None), (None, at(3), 3, 8, None, 1e300, None), (big, at(4), 4, 9, None, 0.0, None)]
    feed = Feed(rocksdb, tmp_path / "in", schema).add(rows)
    got = run(SD.dedup_interval_stream(feed.stream(), ["k"], "ts", "60 seconds", "n"), "exact", "append", tmp_path / "cp")
    assert bag(got) == sorted(rows[:3], key=repr)


def test_dedup_stream_with_time_to_live(rocksdb, tmp_path):
    feed = Feed(rocksdb, tmp_path / "in", "k string, ts timestamp_ntz, n bigint")
    feed.add([("a", at(0), 0), ("a", at(30), 1)]).add([("a", at(61), 2), ("a", at(62), 3)])
    df = SD.dedup_interval_stream(feed.stream(), ["k"], "ts", "60 seconds", "n", processing_ttl=True)
    # In processing-time mode Spark always has another batch to run, so "available now" would never end.
    query = df.writeStream.format("memory").queryName("ttl").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        deadline = time.monotonic() + 60
        while rocksdb.table("ttl").count() < 2 and time.monotonic() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted(r.n for r in rocksdb.table("ttl").collect()) == [0, 2]


def test_late_rows_go_to_a_side_output(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "k string, v bigint, ts timestamp_ntz, seq bigint")
    rows = [tuple(r) for r in arrivals(spark, DISORDERED).orderBy("seq").collect()]
    path, checkpoint = str(tmp_path / "split"), str(tmp_path / "cp")

    def drain():
        late.split_late_stream(feed.stream(), "ts", "seq", "5 seconds", "2 seconds", path, checkpoint, available_now=True).start().awaitTermination()

    feed.add(rows[:4]).add(rows[4:8])
    drain()
    feed.add(rows[8:])
    drain()  # a restart goes on from the carried timestamp
    read = lambda side: [r.v for r in spark.read.parquet(path).filter(F.col("is_late") == side).orderBy("seq").collect()]
    assert read(True) == [3, 4, 9, 8]
    assert read(False) == [1, 5, 6, 7, 10, 12, 10, 22]
    for row in [(("a", s, at(s), 100 + s)) for s in range(40, 48)]:
        feed.add([row])
    drain()
    assert len(os.listdir(f"{checkpoint}/carried")) <= 4  # what is carried does not pile up


def test_upsert_sink_and_change_stream(spark, tmp_path):
    schema = "order_number bigint, buyer struct<first_name: string, last_name: string>, order_time timestamp_ntz"
    feed = Feed(spark, tmp_path / "in", schema)
    feed.add([(1, ("ann", "x"), at(0)), (2, ("bob", "y"), at(0))]).add([(1, ("eve", "z"), at(5)), (2, ("old", "y"), at(-5))])
    flat = feed.stream().select("order_number", "buyer.first_name", "buyer.last_name", "order_time")
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    sinks.upsert_sink(flat, path, checkpoint, available_now=True).start().awaitTermination()
    log = K.read_log(spark, path, flat.schema)
    assert sorted(r._commit for r in log.select("_commit").distinct().collect()) == [1, 2]
    latest = K.upsert_latest(log, "order_number", "order_time")
    assert {(r.order_number, r.first_name) for r in latest.collect()} == {(1, "eve"), (2, "bob")}
    followed = run(K.stream_log(spark, path, flat.schema), "followed", "append", tmp_path / "cp2")
    assert followed.count() == 4
    files = sorted((tmp_path / "log").glob("*/*.parquet"))
    K.write_commit(log.filter("_commit = 2").select(*flat.columns), path, 2, once=True)  # a repeated batch leaves the files alone
    assert sorted((tmp_path / "log").glob("*/*.parquet")) == files
    again = run(K.stream_log(spark, path, flat.schema), "again", "append", tmp_path / "cp3")
    assert again.count() == 4


def test_changes_in_update_mode(rocksdb, tmp_path):
    feed = Feed(rocksdb, tmp_path / "in", "k string, v bigint")
    feed.add([("a", 1), ("b", 5)]).add([("a", 2)])
    got = run(sinks.changes(feed.stream(), "k", "v"), "changes", "update", tmp_path / "cp")
    assert bag(got) == [("a", 1), ("a", 3), ("b", 5)]


def test_text_sink_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.txt").write_text("a 1\nbroken\na 4\n")
    df = parse_pairs(text_stream(spark, str(tmp_path / "in"))).select("k", "v")
    sinks.text_sink(df, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).start().awaitTermination()
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["a,1", "a,4"]


def test_console_and_table_writers(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", EVENT).add([(at(0), 1)])
    query = sinks.preview_sink(feed.stream(), 20, "append").start()
    query.processAllAvailable()
    query.stop()
    spark.sql("DROP TABLE IF EXISTS streamed_rows")
    try:
        sinks.table_sink(feed.stream(), str(tmp_path / "cp"), available_now=True).toTable("streamed_rows").awaitTermination()
        assert spark.table("streamed_rows").count() == 1
    finally:
        spark.sql("DROP TABLE streamed_rows")


def test_cumulative_stream_equals_batch(rocksdb, tmp_path):
    feed = Feed(rocksdb, tmp_path / "in", EVENT)
    rows = [(at(s), (s * 7 // 11) % 9 if s % 13 else None) for s in range(0, 7200, 150)]
    feed.add(rows[:5]).add(rows[5:30]).add(rows[30:]).add([(at(50_000), 1)]).add([(at(100_000), 1)])
    df = cumulate_steps_stream(feed.stream(), "ts", "id", "10 minutes", "1 hour")
    steps = run(df, "steps", "append", tmp_path / "cp").filter(F.col("ts") < F.lit(at(40_000)))
    got = windows.cumulate_steps(steps, "ts", "10 minutes", "1 hour")
    expected = windows.cumulate_pv_uv(rocksdb.createDataFrame(rows, EVENT), "ts", "id", "10 minutes", "1 hour")
    assert bag(got) == bag(expected)


def test_processing_time_window(rocksdb, tmp_path):
    """Windows over the arrival time, reported while they are open."""
    feed = Feed(rocksdb, tmp_path / "in", EVENT).add([(at(0), 1), (at(0), 1), (at(0), 2)])
    df = feed.stream().withColumn("proc_time", processing_time())
    got = run(SW.pv_uv_early(df, "proc_time", "id", "1 day"), "arrival", "update", tmp_path / "cp")
    assert bag(got.select("measure", "value")) == [("pv", 3), ("uv", 2)]
    assert abs((got.first().window_start - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) <= 2 * 86400


def test_declared_table_feeds_a_windowed_stream(rocksdb, tmp_path):
    schema = T.StructType([T.StructField("account_id", T.LongType()), T.StructField("amount", T.LongType()),
                           T.StructField("transaction_time", T.TimestampNTZType())])
    feed = Feed(rocksdb, tmp_path / "in", schema)
    feed.add([(1, 10, at(1)), (1, None, at(2)), (2, 11, at(3))]).add([(1, 10, at(100))])
    spec = TableSpec("transactions", schema, event_time="transaction_time", delay="3 seconds")
    spec.apply(feed.stream())
    df = rocksdb.sql("""SELECT account_id, window.end AS window_end, count(amount) AS count1 FROM transactions
                        GROUP BY account_id, window(transaction_time, '10 seconds')""")
    got = run(df, "per_account", "append", tmp_path / "cp")
    assert sorted((r.account_id, r.count1) for r in got.collect()) == [(1, 1), (2, 1)]
