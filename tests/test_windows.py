from __future__ import annotations

import random
from datetime import datetime

import pytest
from data import TEMPERATURES, at, lines
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import parse_temperatures
from tideline.functions.times import from_micros, micros
from tideline.operators import aggregates, windows
from tideline.operators.watermark import split_late


def cumulate(df: DataFrame, ts: str, step: str, max_size: str) -> DataFrame:
    """Every cumulative window that contains the row, one row each.

    This is the plain definition and makes up to max_size/step copies; `cumulate_pv_uv` needs none.
    """
    step_us, max_us = windows._cumulate_sizes(step, max_size)
    us, kind = micros(ts), df.schema[ts].dataType
    start = us - F.pmod(us, F.lit(max_us))
    first_end = us - F.pmod(us, F.lit(step_us)) + step_us
    return (
        df.filter(F.col(ts).isNotNull())
        .withColumn("_start", start)
        .withColumn("_end", F.explode(F.sequence(first_end, start + max_us, F.lit(step_us))))
        .withColumns({"window_start": from_micros(F.col("_start"), kind), "window_end": from_micros(F.col("_end"), kind)})
        .drop("_start", "_end")
    )


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def events(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, id bigint")


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(7)
    rows = [(at(rng.randrange(0, 3 * 86400)), rng.choice([1, 2, 3, 4, 5, 6, None])) for _ in range(400)]
    rows += [(at(86400), 1), (at(86399.999999), 2), (None, 3), (at(172800), None)]
    return events(spark, rows)


def test_boundary_rows(spark):
    df = windows.tumble(events(spark, [(at(0), 1), (at(9.999999), 1), (at(10), 1), (None, 1)]), "ts", "10 seconds")
    assert [r.window_start for r in df.orderBy("ts").collect()] == [at(0), at(0), at(10)]


def test_offset_day(spark):
    df = windows.tumble(events(spark, [(datetime(2024, 1, 1, 17), 1)]), "ts", "1 day", "-8 hours")
    row = df.first()
    assert (row.window_start, row.window_end) == (datetime(2024, 1, 1, 16), datetime(2024, 1, 2, 16))


def test_pv_uv_skips_null_ids(spark):
    df = events(spark, [(at(0), 1), (at(1), 1), (at(2), None), (at(20), None)])
    got = bag(windows.pv_uv(windows.tumble(df, "ts", "10 seconds"), "id").select("pv", "uv"))
    assert got == [(0, 0), (2, 1)]


def test_multi_size_equals_each_size(mixed):
    sizes = ["1 hour", "90 minutes", "7 hours"]
    got = windows.multi_window_pv_uv(mixed, "ts", "id", sizes)
    plain = windows.pv_uv(windows.tumble_multi(mixed, "ts", sizes), "id", ["window_size", *windows.BOUNDS])
    assert bag(got) == bag(plain)
    for size in sizes:
        one = windows.pv_uv(windows.tumble(mixed, "ts", size), "id")
        assert bag(got.filter(F.col("window_size") == size).drop("window_size")) == bag(one)


@pytest.mark.parametrize("step,top", [("1 hour", "1 day"), ("10 minutes", "2 hours"), ("1 day", "1 day")])
def test_cumulate_equals_definition(mixed, step, top):
    got = windows.cumulate_pv_uv(mixed, "ts", "id", step, top)
    plain = windows.pv_uv(cumulate(mixed, "ts", step, top), "id")
    assert bag(got) == bag(plain)


def test_cumulate_rejects_uneven_step(mixed):
    with pytest.raises(ValueError):
        windows.cumulate_pv_uv(mixed, "ts", "id", "7 hours", "1 day")


def test_empty_input(spark):
    none = events(spark, [])
    assert windows.cumulate_pv_uv(none, "ts", "id", "1 hour", "1 day").count() == 0
    assert windows.multi_window_pv_uv(none, "ts", "id", ["1 hour"]).count() == 0


def test_cumulate_plan_copies_no_rows(mixed):
    plan = windows.cumulate_pv_uv(mixed, "ts", "id", "1 hour", "1 day")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # the only explode sits above the aggregates


def test_temperature_windows(spark):
    df = parse_temperatures(lines(spark, TEMPERATURES))
    got = bag(aggregates.window_stats(df, ["city"], "ts", "temp", "30 seconds").select("city", "max", "min", "sum", "avg", "counts"))
    assert got == sorted([("Hof", -1.5, -2.5, -4.0, -2.0, 2), ("Passau", 5.75, 3.25, 13.5, 4.5, 3),
                          ("Passau", 6.0, 6.0, 6.0, 6.0, 1)], key=repr)


def test_temperature_windows_with_late_rows_dropped(spark):
    rows = lines(spark, TEMPERATURES).coalesce(1).withColumn("seq", F.monotonically_increasing_id())
    fields = F.split("value", ",")
    df = rows.select(fields[1].alias("city"), fields[3].cast("double").alias("temp"),
                     F.to_timestamp(fields[4]).alias("ts"), "seq")
    on_time, late = split_late(df, "ts", "seq", "30 seconds")
    assert late.count() == 1
    stats = aggregates.window_stats(on_time.drop("window_start", "window_end"), ["city"], "ts", "temp", "30 seconds")
    first = stats.filter("city = 'Passau'").orderBy("window_start").first()
    assert (first["max"], first["min"], first["sum"], first["counts"]) == (5.75, 3.25, 9.0, 2)


def test_negative_values_keep_true_maximum(spark):
    df = spark.createDataFrame([("x", at(0), -5.0), ("x", at(1), -2.0)], "k string, ts timestamp_ntz, v double")
    assert aggregates.window_stats(df, ["k"], "ts", "v", "10 seconds").first()["max"] == -2.0


def test_running_word_count(spark):
    df = spark.createDataFrame([(0, "a,b,a"), (1, "a"), (300, "b,a")], "n bigint, t string")
    got = [(r.word, r.total) for r in aggregates.running_word_count(df, "n", "t").orderBy("n", "pos").collect()]
    assert got == [("a", 1), ("b", 1), ("a", 2), ("a", 3), ("b", 2), ("a", 4)]
    assert bag(aggregates.word_count(df, "t")) == [("a", 4), ("b", 2)]


def test_running_word_count_moves_long_tokens_once(spark):
    """Texts of 2,000 letters that differ at the end only, over many buckets of lines; no shuffle goes by the text."""
    lines = [(n, ",".join("x" * 2000 + str((n + i) % 7) for i in range(3))) for n in range(0, 4000, 97)]
    counted = aggregates.running_word_count(spark.createDataFrame(lines, "n bigint, t string"), "n", "t", bucket_bits=6)
    assert "hashpartitioning(word" not in counted._jdf.queryExecution().executedPlan().toString()
    seen, expected = {}, []
    for n, text in lines:
        for pos, word in enumerate(text.split(",")):
            seen[word] = seen.get(word, 0) + 1
            expected.append((n, pos, word, seen[word]))
    assert sorted(map(tuple, counted.collect())) == sorted(expected)


def test_reports(spark):
    df = spark.createDataFrame([(1, 10, at(5)), (1, None, at(3700)), (2, 11, at(3599)), (1, 4, at(6))],
                               "account bigint, amount bigint, ts timestamp_ntz")
    assert bag(aggregates.group_count(df, "account", "amount")) == [(1, 2), (2, 1)]
    assert bag(aggregates.hourly_report(df, "account", "ts", "amount")) == sorted(
        [(1, at(0), 14), (1, at(3600), None), (2, at(0), 11)], key=repr)
    assert bag(aggregates.tumble_count(df, "account", "ts", "amount", "10 seconds")) == sorted(
        [(1, at(10), 2), (1, at(3710), 0), (2, at(3600), 1)], key=repr)
