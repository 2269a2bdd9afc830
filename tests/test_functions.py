from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from data import CLICKS, TEMPERATURES, lines
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tideline.functions import (
    duration_us, epoch_ms, from_epoch_ms, java_hash, parse_clicks, parse_json, parse_pairs, parse_temperatures,
    register_functions, tokens, user_func,
)
from tideline.session import ignore_idle_sources


def column(df, name):
    return [row[name] for row in df.select(name).collect()]


def test_durations():
    assert duration_us("10 seconds") == 10_000_000
    assert duration_us("-8 hours") == -8 * 3_600_000_000
    assert duration_us("1 day 2 hours") == 26 * 3_600_000_000
    assert duration_us("250 milliseconds") == 250_000
    for wrong in ("1 month", "10", "seconds", "1 day x"):
        with pytest.raises(ValueError):
            duration_us(wrong)


def test_java_hash(spark):
    df = lines(spark, ["hello", "江苏", "😀a", None, ""])
    assert [r.h for r in df.select(java_hash("value").alias("h")).collect()] == [1189947864, 10722240, 659519592, None, 0]
    assert [r.h for r in df.select(java_hash("value", 1).alias("h")).collect()][:3] == [99162322, 893520, 54959966]


def test_java_hash_against_definition(spark):
    from hypothesis import HealthCheck, given, settings, strategies as st

    @settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=20),
           st.integers(-2**31, 2**31 - 1))
    def check(texts, factor):
        def wrap(n):
            return (n + 2**31) % 2**32 - 2**31

        def expected(text):
            units = text.encode("utf-16-be")
            h = 0
            for i in range(0, len(units), 2):
                h = (h * 31 + int.from_bytes(units[i:i + 2], "big")) % 2**32
            return wrap(h * factor)

        got = lines(spark, texts).select(java_hash("value", factor).alias("h")).collect()
        assert [r.h for r in got] == [expected(t) for t in texts]

    check()


def test_user_function(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "n")
    df = df.withColumn("record", user_func(df, "n"))
    df = df.withColumn("name", user_func(df, "record"))
    got = [(r.n, r.record.age, r.record.name, r.record.totalBalance, r.name) for r in df.orderBy("n").collect()]
    low = [(i, i, "name1", Decimal("1.10"), "name1") for i in range(1, 6)]
    high = [(i, i, "name2", Decimal("2.20"), "name2") for i in range(6, 11)]
    assert got == low + high
    assert df.schema["record"].dataType.simpleString() == "struct<age:int,name:string,totalBalance:decimal(10,2)>"


def test_user_function_wraps_age(spark):
    df = spark.createDataFrame([(2**32 + 3,), (2**31,), (None,)], "n bigint")
    assert [r.r and r.r.age for r in df.select(user_func(df, "n").alias("r")).collect()] == [3, -2**31, None]


def test_user_function_at_both_ends_of_bigint(spark):
    register_functions(spark)
    df = spark.createDataFrame([(2**63 - 1,), (-2**63,), (-1,), (2**31 - 1,)], "n bigint")
    ages = [-1, 0, -1, 2**31 - 1]
    assert [r.r.age for r in df.select(user_func(df, "n").alias("r")).collect()] == ages
    assert [r.r.age for r in df.selectExpr("user_scalar_func(n) AS r").collect()] == ages


def test_registered_functions(spark):
    register_functions(spark)
    row = spark.sql("""SELECT hashCode('hello') h, user_scalar_func(3L) r,
                       user_scalar_name(user_scalar_func(9L)) n, hashCode(NULL) e""").first()
    assert (row.h, row.r.name, row.n, row.e) == (1189947864, "name1", "name2", None)
    register_functions(spark, hash_factor=1)
    assert spark.sql("SELECT hashCode('hello') h").first().h == 99162322


def test_inline_rows_and_bitmap_in_sql(spark):
    got = spark.sql("""SELECT sum(bitmap_count(places)) AS seen FROM (
        SELECT bitmap_construct_agg(bitmap_bit_position(visitor)) AS places
        FROM VALUES ('mon', 17), ('tue', 40000), ('tue', 17), ('wed', 99) AS visits(day, visitor) GROUP BY bitmap_bucket_number(visitor))""").first().seen
    assert got == 3


def test_idle_source_setting(spark):
    name = "spark.sql.streaming.multipleWatermarkPolicy"
    before = spark.conf.get(name)
    ignore_idle_sources(spark)
    assert spark.conf.get(name) == "max"
    ignore_idle_sources(spark, False)
    assert spark.conf.get(name) == "min" == before


def test_parse_temperatures(spark):
    df = parse_temperatures(lines(spark, TEMPERATURES))
    first = df.first()
    assert (first.province, first.city, first.temp, first.ts) == ("Bavaria", "Passau", 3.25, datetime(2023, 11, 5, 8, 15))


@pytest.mark.parametrize("bad", ["only two, fields", "a,b,1,x,2023-11-05 08:15:00", "a,b,1,2.0,2023-11-05"])
def test_parse_temperatures_fails_on_bad_line(spark, bad):
    with pytest.raises(PySparkException):
        parse_temperatures(lines(spark, [bad])).collect()


def test_parse_clicks(spark):
    df = parse_clicks(lines(spark, [*CLICKS, "1,2,3,buy,5"]))
    assert df.count() == 4
    assert df.first().ts == datetime(2022, 4, 15, 5, 20)
    assert df.first().click_key == "71-9001"
    with pytest.raises(PySparkException):
        parse_clicks(lines(spark, ["1,2,3"])).collect()


def test_parse_pairs(spark):
    df = parse_pairs(lines(spark, ["a 1", "a\t2  ", " a 3", "a x", "a 1 2", "", "b -4", "a 5.0", "c 99999999999"]))
    assert [(r.k, r.v) for r in df.collect()] == [("a", 1), ("a", 2), ("b", -4)]


def test_tokens(spark):
    df = lines(spark, ["a,b,,", ",x", "", ",,,", "one", None, "a,\n"])
    got = [(r.pos, r.word) for r in tokens(df, "value").collect()]
    assert got == [(0, "a"), (1, "b"), (0, ""), (1, "x"), (0, ""), (0, "one"), (0, "a"), (1, "\n")]


def test_tokens_with_longer_separator(spark):
    got = [r.word for r in tokens(lines(spark, ["a::b::", "::", "x.:y", ""]), "value", "::").collect()]
    assert got == ["a", "b", "x.:y", ""]


def test_parse_json(spark):
    df = lines(spark, ['{"id": 1, "n": "x"}', '{"id": "bad", "n": "y"}', '{"n": "z"}', "{broken", None, '{"id": 4, "n": "w", "more": 1}'])
    got = [(r.id, r.n) for r in parse_json(df, "id bigint, n string").collect()]
    assert got == [(1, "x"), (None, "y"), (None, "z"), (4, "w")]


def test_parse_json_keeps_objects_only(spark):
    texts = ['{"k":1,"k":2}', "5", '"x"', "null", "[1]", '[{"k":3}]', "", " ", '{"k":4', ' \t{"k":5}', "{}", '{"k":"no"}', '{"k":null}']
    got = [(r.value, r.k) for r in parse_json(lines(spark, texts), "k int", keep=("value",)).collect()]
    assert got == [('{"k":1,"k":2}', 2), (' \t{"k":5}', 5), ("{}", None), ('{"k":"no"}', None), ('{"k":null}', None)]


def test_parse_json_wants_double_quotes(spark):
    texts = ["{'k':1}", """{"k":'1'}""", """{"k": 2, 'x': 1}""", '{"k":3}', """{"k":4,"x":"it's"}"""]
    assert [r.k for r in parse_json(lines(spark, texts), "k int").collect()] == [3, 4]


def test_parse_json_parses_once(spark):
    plan = parse_json(lines(spark, ["{}"]), "k int")._jdf.queryExecution().optimizedPlan().toString()
    # The second from_json is the one for damaged texts only.
    assert plan.count("from_json(StructField(k") == 1


def test_epoch_milliseconds(spark):
    df = lines(spark, ["2021-01-29 16:00:00"])
    row = df.select(epoch_ms("value").alias("ms"), from_epoch_ms(epoch_ms("value"), "Asia/Shanghai").alias("local")).first()
    assert (row.ms, row.local) == (1611936000000, datetime(2021, 1, 30))
    assert df.select(F.date_format("value", "HH:mm:ss").alias("t")).first().t == "16:00:00"
