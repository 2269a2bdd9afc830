from __future__ import annotations

import re

import pytest
from data import TEMPERATURES, at
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.sources import generator as G
from tideline.sources import text
from tideline.sources.kafka_json import kafka_stream, parse_records
from tideline.sources.tables import TableSpec, inline_rows, insert_into, processing_time

PROFILE = {
    "id": G.uniform_int(1, 5), "big": G.uniform_long(10, 11), "price": G.uniform_double(1, 1000),
    "name": G.random_hex(6), "birthday": G.random_hex(20), "sex": G.choice("0", "1"), "row": G.sequence(),
}


def test_bounded_generator(spark):
    df = G.generate(spark, PROFILE, 500, seed=1)
    stats = df.agg(F.min("id"), F.max("id"), F.countDistinct("big"), F.min("price") >= 1, F.max("price") < 1000,
                   F.countDistinct("row"), F.max(F.length("name")), F.min(F.length("birthday"))).first()
    assert tuple(stats) == (1, 5, 2, True, True, 500, 6, 20)
    assert df.filter(~F.col("name").rlike("^[0-9a-f]{6}$")).count() == 0
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "bigint", "double", "string", "string", "string", "bigint"]
    assert df.collect() == G.generate(spark, PROFILE, 500, seed=1).collect()
    assert df.collect() != G.generate(spark, PROFILE, 500, seed=2).collect()


def test_random_table_from_a_declaration(spark):
    schema = T.StructType([
        T.StructField("n", T.LongType()), T.StructField("id", T.IntegerType()), T.StructField("price", T.DecimalType(32, 2)),
        T.StructField("buyer", T.StructType([T.StructField("first_name", T.StringType()), T.StructField("age", T.ShortType())])),
        T.StructField("order_time", T.TimestampNTZType()),
    ])
    options = {"number-of-rows": "200", "rows-per-second": "2", "fields.n.kind": "sequence", "fields.n.start": "5",
               "fields.id.min": "1", "fields.id.max": "10", "fields.buyer.first_name.length": "8", "fields.buyer.age.max": "90"}
    df = G.random_table(spark, schema, options)
    assert [f.dataType for f in df.schema] == [f.dataType for f in schema] or df.schema.simpleString() == schema.simpleString()
    stats = df.agg(F.min("n"), F.max("n"), F.min("id"), F.max("id"), F.max(F.length("buyer.first_name")), F.max("buyer.age") <= 90,
                   F.count("order_time"), F.countDistinct("price") > 100).first()
    assert tuple(stats) == (5, 204, 1, 10, 8, True, 200, True)
    assert G.random_table(spark, schema, options, stream=True).isStreaming
    with pytest.raises(ValueError):
        G.random_table(spark, schema)


def test_generator_stream_has_the_same_columns(spark):
    df = G.generate_stream(spark, PROFILE, 10, rows=1000, time_column="ts")
    assert df.isStreaming and df.columns == [*PROFILE, "ts"]


def test_declared_table(spark):
    schema = T.StructType([
        T.StructField("account", T.LongType(), False, {"comment": "account id"}), T.StructField("ts", T.TimestampNTZType()),
    ])
    spec = TableSpec("accounts", schema, {"proc_time": processing_time(), "hour": F.date_trunc("HOUR", "ts")}, "ts", "3 seconds", ("account",))
    table = spec.apply(spark.createDataFrame([("7", at(3700))], "account string, ts timestamp_ntz"))
    row = spark.sql("SELECT account, date_format(hour, 'HH:mm:ss') AS h FROM accounts").first()
    assert tuple(row) == (7, "01:00:00")
    assert table.schema["account"].metadata == {"comment": "account id"}
    streamed = spec.apply(spark.readStream.format("rate").load().selectExpr("value account", "timestamp ts"), view=False)
    assert re.search(r"EventTimeWatermark \S+, ts#\d+: timestamp, 3 seconds", streamed._jdf.queryExecution().analyzed().toString())


def test_insert_into_checks_width(spark):
    spark.sql("DROP TABLE IF EXISTS target_pairs")
    spark.sql("CREATE TABLE target_pairs (a BIGINT, b STRING) USING parquet")
    try:
        insert_into(inline_rows(spark, [(1, "x")], "p bigint, q string"), "target_pairs")
        assert list(map(tuple, spark.table("target_pairs").collect())) == [(1, "x")]
        with pytest.raises(ValueError):
            insert_into(inline_rows(spark, [(1,)], "p bigint"), "target_pairs")
    finally:
        spark.sql("DROP TABLE target_pairs")


def test_csv_and_text_files(spark, tmp_path):
    source = tmp_path / "temp.txt"
    source.write_text("\n".join(TEMPERATURES), encoding="utf-8")
    schema = "province string, city string, flag int, temp double, ts timestamp"
    assert text.csv_table(spark, str(source), schema).agg(F.sum("temp")).first()[0] == 15.5
    assert text.text_lines(spark, str(source)).count() == 6
    source.write_text("only two, fields", encoding="utf-8")
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        text.csv_table(spark, str(source), schema).collect()


def test_text_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 2.5)], "a int, b string, c double")
    text.write_lines(df, str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["1,null,2.5"]


def test_records_with_metadata(spark):
    body = "svc_id string, url string, span int, app string"
    raw = spark.createDataFrame(
        [(0, 5, at(0), bytearray(b'{"svc_id": "a", "span": 3}')), (1, 6, at(1), bytearray(b"oops")), (1, 7, at(2), bytearray(b'{"svc_id": "b", "span": "x"}'))],
        "partition int, offset bigint, timestamp timestamp_ntz, value binary")
    got = [(r.partition, r.offset, r.svc_id, r.span) for r in parse_records(raw, body).collect()]
    assert got == [(0, 5, "a", 3), (1, 7, "b", None)]


def test_kafka_start_is_checked(spark):
    with pytest.raises(ValueError):
        kafka_stream(spark, "host:1", "topic", start="middle")
