"""The registered queries: each operator over the given tables, whole.

`events` is stored in time order, so queries on out-of-order arrival derive an arrival number from event_id:
inside each block of 64 events the order is permuted. It is unique and dense, like the offset of a log.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import from_epoch_ms, java_hash, parse_clicks, parse_json, parse_pairs, parse_temperatures, span, user_func
from tideline.functions.register import register_functions
from tideline.functions.times import clock, epoch_ms
from tideline.operators import aggregates, dedup, distinct, idle, ids, keyed_table, ordered, running, userdefined, watermark, windows
from tideline.operators import changelog as changes
from tideline.operators.stored import shared_folder
from tideline.session import configure
from tideline.sources.kafka_json import parse_records
from tideline.sources.tables import TableSpec, insert_into, processing_time, testdata
from tideline.sources.text import text_lines, write_lines
from tideline.streaming.changelog import changelog_stream as stream_changes
from tideline.streaming.dedup import dedup_interval_stream as stream_dedup
from tideline.streaming.firing import each_firing, fired_window_rows_stream
from tideline.streaming.ids import assign_ids_stream
from tideline.streaming.replay import replay, replay_into
from tideline.streaming.sinks import batch_sink, current_table_sink, text_sink, upsert_sink
from tideline.streaming.windows import multi_window_pv_uv_stream as stream_multi_window
from tideline.streaming.windows import pv_uv_early

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(configure(spark), folder)

    _REGISTRY[build.__name__] = run
    return run


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return testdata(spark, folder, "events")


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a dense arrival number that does not follow event time."""
    block = F.pmod("event_id", F.lit(64))
    return _events(spark, folder).withColumn("seq", F.col("event_id") - block + F.pmod(block * 29, F.lit(64)))


def _round(column: str, digits: int = 2):
    return F.round(column, digits).alias(column)


# -- windows ------------------------------------------------------------------------------------------


@query
def tumble_pv_uv(spark, folder):
    return windows.pv_uv(windows.tumble(_events(spark, folder), "ts", "1 hour"), "user_id")


@query
def tumble_pv_uv_clock(spark, folder):
    """The same, reported by time of day as text."""
    counted = windows.pv_uv(windows.tumble(_events(spark, folder), "ts", "6 hours"), "user_id")
    return counted.select(
        F.to_date("window_start").cast("string").alias("day"),
        clock("window_start").alias("start_time"), clock("window_end").alias("end_time"), "pv", "uv",
    )


@query
def multi_window_pv_uv(spark, folder):
    sizes = ["1 hour", "3 hours", "7 hours", "1 day"]
    return windows.multi_window_pv_uv(_events(spark, folder), "ts", "user_id", sizes)


@query
def union_all_pv_uv(spark, folder):
    """Two window reports as a bag union."""
    events = _events(spark, folder)
    hours = windows.pv_uv(windows.tumble(events, "ts", "12 hours"), "user_id")
    days = windows.pv_uv(windows.tumble(events, "ts", "1 day"), "user_id")
    return hours.unionByName(days)


@query
def cumulate_pv_uv(spark, folder):
    return windows.cumulate_pv_uv(_events(spark, folder), "ts", "user_id", "1 hour", "1 day")


@query
def day_window_offset(spark, folder):
    return windows.pv_uv(windows.tumble(_events(spark, folder), "ts", "1 day", "-8 hours"), "user_id")


@query
def window_stats(spark, folder):
    stats = aggregates.window_stats(_events(spark, folder), ["event_type"], "ts", "value", "6 hours")
    return stats.select("event_type", "window_start", "window_end", "max", "min",
                        _round("sum"), _round("avg", 8), "counts")


@query
def window_rows(spark, folder):
    return watermark.window_rows(_events(spark, folder), "ts", "5 minutes").select("event_id", "window_start", "window_end")


# -- aggregates ---------------------------------------------------------------------------------------


@query
def group_count(spark, folder):
    return aggregates.group_count(_events(spark, folder), "user_id", "value")


@query
def hourly_report(spark, folder):
    report = aggregates.hourly_report(_events(spark, folder), "user_id", "ts", "value")
    return report.select("user_id", "log_ts", _round("amount"))


@query
def tumble_count_end(spark, folder):
    return aggregates.tumble_count(_events(spark, folder), "user_id", "ts", "value", "10 minutes")


@query
def word_count(spark, folder):
    return aggregates.word_count(testdata(spark, folder, "documents"), "text")


@query
def running_word_count(spark, folder):
    return aggregates.running_word_count(testdata(spark, folder, "documents"), "doc_id", "text")


@query
def bitmap_distinct(spark, folder):
    return distinct.bitmap_distinct(_events(spark, folder), ["event_type"], "user_id")


@query
def bitmap_distinct_rollup(spark, folder):
    """Daily bitmaps merged to totals per type and over all."""
    events = _events(spark, folder).withColumn("day", F.to_date("ts"))
    daily = distinct.bitmap_state(events, ["day", "event_type"], "event_id")
    per_type = distinct.bitmap_cardinality(distinct.bitmap_rollup(daily, ["event_type"]), ["event_type"], "ids")
    total = distinct.bitmap_cardinality(distinct.bitmap_rollup(daily, []), [], "ids")
    return per_type.unionByName(total.withColumn("event_type", F.lit("all")))


@query
def bitmap_rollup_hashed(spark, folder):
    """Daily states of scattered ids, and of ids that are dense in one range and scattered beyond, merged to totals per type."""
    number = F.col("event_id")
    scattered = F.pmod(number * 2_654_435_761, F.lit(1 << 40))
    mixed = F.when(F.pmod(number, F.lit(4)) == 0, number + 2_000_000_000).otherwise(scattered)
    events = _events(spark, folder).select("event_type", F.to_date("ts").alias("day"), scattered.alias("hashed"), mixed.alias("mixed"))
    parts = []
    for ids_of in ("hashed", "mixed"):
        merged = distinct.bitmap_rollup(distinct.bitmap_state(events, ["day", "event_type"], ids_of), ["event_type"])
        parts.append(distinct.bitmap_cardinality(merged, ["event_type"], "ids").withColumn("kind", F.lit(ids_of)))
    return parts[0].unionByName(parts[1])


def _cents(spark, folder):
    """Amounts per type and day; every 11th event has none."""
    cents = F.when(F.pmod("event_id", F.lit(11)) > 0, F.round(F.col("value") * 100).cast("bigint"))
    return _events(spark, folder).select("event_type", "user_id", F.to_date("ts").cast("string").alias("day"), cents.alias("cents"))


@query
def user_aggregate(spark, folder):
    """An aggregate that a user states as create, add, merge and result."""
    return userdefined.aggregate(_cents(spark, folder), ["event_type", "day"], userdefined.Stats(), ["cents"])


@query
def user_aggregate_sql(spark, folder):
    """The same called from SQL, per type."""
    userdefined.register_aggregate(spark, "amount_stats", userdefined.Stats(), "string")
    _cents(spark, folder).createOrReplaceTempView("user_aggregate_amounts")
    return spark.sql("""SELECT key AS event_type, r.* FROM (
        SELECT key, amount_stats_result(amount_stats_merge(state)) AS r
        FROM amount_stats_partial(TABLE(SELECT event_type, cents FROM user_aggregate_amounts)) GROUP BY key)""")


@query
def user_distinct(spark, folder):
    """Distinct amounts per type: by slices of their hash, which are added up."""
    sliced = _cents(spark, folder).withColumn("slice", F.pmod(F.xxhash64("cents"), F.lit(16)))
    counted = userdefined.aggregate(sliced, ["event_type", "slice"], userdefined.Distinct(), ["cents"])
    return counted.groupBy("event_type").agg(F.sum("uv").alias("uv"))


# -- arrival order and watermarks ---------------------------------------------------------------------


@query
def late_split(spark, folder):
    tagged = watermark.tag_late(_arrivals(spark, folder), "ts", "seq", "30 minutes", "10 minutes", "5 minutes")
    return tagged.select("event_id", "window_end", "wm_before", F.col("is_late").alias("late"))


@query
def late_split_strict(spark, folder):
    """Monotonous watermark: no disorder is tolerated."""
    tagged = watermark.tag_late(_arrivals(spark, folder), "ts", "seq", "30 minutes", "0 seconds")
    return tagged.select("event_id", "window_end", "wm_before", F.col("is_late").alias("late"))


@query
def late_split_per_event(spark, folder):
    """A generator that emits every event's own time as the watermark."""
    tagged = watermark.tag_late(_arrivals(spark, folder), "ts", "seq", "30 minutes", per_event=True)
    return tagged.select("event_id", "window_end", "wm_before", F.col("is_late").alias("late"))


@query
def late_by_arrival_time(spark, folder):
    """The same split where arrival is a time with ties, numbered first."""
    jitter = F.timestamp_micros(
        F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.col("event_id") * 7919, F.lit(3600)) * 1_000_000
    )
    arrived = _events(spark, folder).select("event_id", "ts").withColumn("arrival", jitter)
    minute = F.expr("unix_micros(arrival) div 60000000")
    numbered = running.number_rows(arrived, ["arrival", "event_id"], minute)
    tagged = watermark.tag_late(numbered, "ts", "seq", "30 minutes", "10 minutes")
    return tagged.select("event_id", "seq", "window_end", F.col("is_late").alias("late"))


@query
def idle_sources_late(spark, folder):
    """Three sources with a watermark each. One of them sends nothing from 6 to 18 o'clock, another comes 20 minutes late."""
    silent = (F.pmod("event_id", F.lit(3)) == 2) & F.hour("ts").between(6, 17)
    source = F.when(silent, F.lit(0)).otherwise(F.pmod("event_id", F.lit(3)))
    lag = F.pmod(F.col("event_id") * 7919, F.lit(900)) + F.when(source == 1, 1200).otherwise(0)
    arrival = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + lag * 1_000_000)
    arrived = _events(spark, folder).withColumns({"source": source, "arrival": arrival})
    marked = idle.idle_watermark(arrived, "ts", "source", "arrival", "event_id", "1 hour", "5 minutes")
    tagged = watermark.judge_late(marked, "ts", "30 minutes", "5 minutes")
    return tagged.select("event_id", "source", "window_end", "wm_before", F.col("is_late").alias("late"))


@query
def lateness_firings(spark, folder):
    arrivals = _arrivals(spark, folder).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    return watermark.window_firings(
        arrivals, "ts", "seq", "1 hour", "10 minutes", "4 hours", value="cents", keys=["event_type"]
    )


@query
def windowed_reduce(spark, folder):
    """Every 9th arrival has no value. The label of a group is one value here; windowed_reduce_parts is the form for groups of any size."""
    n = F.when(F.pmod("event_id", F.lit(9)) > 0, F.floor("value").cast("bigint"))
    on_time, _ = watermark.split_late(_arrivals(spark, folder).withColumn("n", n), "ts", "seq", "6 hours", "1 hour")
    return ordered.ordered_reduce(on_time, "event_type", "seq", "n", windows.BOUNDS)


@query
def windowed_reduce_parts(spark, folder):
    """The same reduction in pieces of bounded size, the form for groups of any size."""
    n = F.when(F.pmod("event_id", F.lit(9)) > 0, F.floor("value").cast("bigint"))
    on_time, _ = watermark.split_late(_arrivals(spark, folder).withColumn("n", n), "ts", "seq", "6 hours", "1 hour")
    return ordered.ordered_parts(on_time, "event_type", "seq", "n", windows.BOUNDS, part_bits=8)


@query
def distinct_per_key_hour(spark, folder):
    judged = watermark.replay_watermark(_arrivals(spark, folder), "ts", "seq", "10 minutes")
    hour_end = F.date_trunc("HOUR", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")
    return distinct.distinct_per_key(
        judged.withColumn("hour_end", hour_end), "event_type", "hour_end", "user_id", "wm_before"
    )


@query
def dedup_interval(spark, folder):
    passed = dedup.dedup_interval(_events(spark, folder), ["user_id"], "ts", "12 hours", "event_id")
    return passed.select("event_id", "user_id", "ts")


@query
def dedup_interval_heavy(spark, folder):
    """The same by event type: few keys, each of many chunks."""
    passed = dedup.dedup_interval(_events(spark, folder), ["event_type"], "ts", "1 hour", "event_id", chunks=16)
    return passed.select("event_id", "event_type", "ts")


@query
def dedup_interval_mixed(spark, folder):
    """A key that holds a third of all rows beside small ones."""
    key = F.when(F.pmod("user_id", F.lit(3)) == 0, -1).otherwise(F.col("user_id"))
    keyed = _events(spark, folder).withColumn("account", key.cast("bigint"))
    passed = dedup.dedup_interval(keyed, ["account"], "ts", "2 hours", "event_id", chunks=24)
    return passed.select("event_id", "account", "ts")


@query
def arrival_window_pv_uv(spark, folder):
    """Windows over the time of arrival instead of the time of the event."""
    lag = F.pmod(F.col("event_id") * 7919, F.lit(3600)) * 1_000_000
    arrival = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + lag).cast("timestamp_ntz")
    arrived = _events(spark, folder).withColumn("arrival", arrival)
    return windows.pv_uv(windows.tumble(arrived, "arrival", "1 hour"), "user_id")


# -- changelogs ---------------------------------------------------------------------------------------


def _cents_changelog(spark, folder):
    events = _arrivals(spark, folder).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    return changes.agg_changelog(events, "user_id", "seq", "cents")


@query
def changelog(spark, folder):
    return _cents_changelog(spark, folder)


@query
def changelog_apply(spark, folder):
    return changes.apply_changelog(_cents_changelog(spark, folder), "user_id", "change_seq", "row_kind")


@query
def changelog_apply_deletes(spark, folder):
    """A changelog that at last takes away every fifth user."""
    changelog = _cents_changelog(spark, folder)
    last = F.lit(1 << 40).cast("bigint").alias("change_seq")
    gone = (_events(spark, folder).filter(F.pmod("user_id", F.lit(5)) == 0).select("user_id").distinct()
            .select("user_id", last, F.lit(changes.DELETE).alias("row_kind"), F.lit(None).cast("bigint").alias("result")))
    return changes.apply_changelog(changelog.unionByName(gone), "user_id", "change_seq", "row_kind")


# -- functions and parsing ----------------------------------------------------------------------------


@query
def java_hash_x12(spark, folder):
    return _events(spark, folder).select("event_id", java_hash("props").alias("hash"))


@query
def java_hash_texts(spark, folder):
    """Whole document texts, other factor, as a checksum per language."""
    hashed = testdata(spark, folder, "documents").select("lang", java_hash("text", 7).cast("bigint").alias("h"))
    return hashed.groupBy("lang").agg(F.sum("h").alias("checksum"), F.countDistinct("h").alias("hashes"))


@query
def user_struct(spark, folder):
    numbered = _events(spark, folder).select("event_id", F.pmod("event_id", F.lit(10)).alias("n"))
    with_record = numbered.withColumn("record", user_func(numbered, "n"))
    return with_record.select(
        "event_id", "record.age", "record.name", F.col("record.totalBalance").cast("double").alias("balance"),
        user_func(with_record, "record").alias("name_of_record"),
    )


@query
def user_struct_sql(spark, folder):
    """The registered SQL functions, over numbers at both ends of BIGINT too."""
    register_functions(spark)
    n = (F.when(F.pmod("event_id", F.lit(17)) == 0, F.lit((1 << 63) - 1)).when(F.pmod("event_id", F.lit(19)) == 0, F.lit(-(1 << 63)))
         .otherwise(F.pmod("event_id", F.lit(10))))
    called = _events(spark, folder).select("event_id", "event_type", n.alias("n")).selectExpr(
        "event_id", "user_scalar_func(n) AS record", "hashCode(event_type) AS hash")
    return called.selectExpr("event_id", "record.age", "record.name", "CAST(record.totalBalance AS DOUBLE) AS balance",
                             "user_scalar_name(record) AS name_of_record", "hash")


@query
def declared_table(spark, folder):
    """Orders through a table declaration with a computed column."""
    spec = TableSpec(
        "declared_orders", T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderdate", T.TimestampNTZType()),
                                         T.StructField("o_totalprice", T.DecimalType(32, 2))]),
        computed={"order_day": F.date_format("o_orderdate", "yyyy-MM-dd")}, event_time="o_orderdate", key=("o_orderkey",))
    declared = spec.apply(testdata(spark, folder, "orders"), view=False)
    return declared.groupBy("order_day").agg(F.count("o_orderkey").alias("orders"), F.sum("o_totalprice").cast("double").alias("price"))


@query
def parse_temperature_lines(spark, folder):
    """Events written as comma separated lines and parsed back, with epoch milliseconds of the written time."""
    written = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    events = _events(spark, folder)
    lines = events.select(F.concat_ws(",", "event_type", "user_id", F.lit(1), F.floor("value"), written).alias("value"))
    parsed = parse_temperatures(lines).select("province", "city", "temp", epoch_ms(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ms"))
    return parsed.groupBy("province").agg(F.countDistinct("city").alias("cities"), F.max("temp").alias("top"), F.sum("ms").alias("ms"))


@query
def json_tolerant(spark, folder):
    """Event properties with damage by rule: every 7th is cut off, every 11th has text for its number, some are no objects."""
    number = F.col("event_id")
    damaged = (
        F.when(F.pmod(number, F.lit(7)) == 0, F.expr("substring(props, 1, length(props) - 1)"))
        .when(F.pmod(number, F.lit(11)) == 0, F.lit('{"k": "x"}'))
        .when(F.pmod(number, F.lit(13)) == 0, F.lit('{"other": 1}'))
        .when(F.pmod(number, F.lit(17)) == 0, F.lit("5"))
        .when(F.pmod(number, F.lit(19)) == 0, F.lit('[{"k": 3}]'))
        .when(F.pmod(number, F.lit(23)) == 0, F.lit('{"k": 1, "k": 2}'))
        .when(F.pmod(number, F.lit(29)) == 0, F.lit("null"))
        .otherwise(F.col("props"))
    )
    raw = _events(spark, folder).select("event_id", damaged.alias("value"))
    return parse_json(raw, T.StructType([T.StructField("k", T.IntegerType())]), keep=("event_id",))


@query
def nested_flatten(spark, folder):
    parts = F.split("c_name", "#")
    buyers = testdata(spark, folder, "customer").select(
        "c_custkey", F.struct(parts[0].alias("first_name"), parts[1].alias("last_name")).alias("buyer")
    )
    return buyers.select("c_custkey", F.col("buyer.first_name").alias("first_name"),
                         F.col("buyer.last_name").alias("last_name"))


@query
def parse_csv_lines(spark, folder):
    """Orders written as comma separated lines and parsed back, one status kept."""
    lines = testdata(spark, folder, "orders").select(
        F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus",
                    F.unix_seconds(F.col("o_orderdate").cast("timestamp"))).alias("value")
    )
    clicks = parse_clicks(lines, behavior="F")
    return clicks.select("click_key", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query
def parse_pairs_tolerant(spark, folder):
    """Lines of different shape by rule; only `key number` lines stay."""
    number = F.col("event_id")
    line = (
        F.when(F.pmod(number, F.lit(5)) == 0, F.concat_ws(" ", "event_type", F.lit("x"), number))
        .when(F.pmod(number, F.lit(5)) == 1, F.concat(F.col("event_type"), F.lit(" \t"), number, F.lit("  ")))
        .when(F.pmod(number, F.lit(5)) == 2, F.concat(F.lit(" "), F.col("event_type"), F.lit(" "), number))
        .when(F.pmod(number, F.lit(5)) == 3, F.concat_ws(" ", "event_type", F.lit("12a")))
        .otherwise(F.concat_ws(" ", "event_type", number))
    )
    pairs = parse_pairs(_events(spark, folder).select(line.alias("value")))
    return pairs.groupBy("k").agg(F.count("*").alias("n"), F.sum(F.col("v").cast("bigint")).alias("total"),
                                   F.max("ts").cast("timestamp_ntz").alias("latest"))


@query
def text_source_lines(spark, folder):
    """Events written to text files, read back line by line and parsed; NULL is written as text."""
    at = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    amount = F.when(F.pmod("event_id", F.lit(6)) > 0, F.floor("value"))
    write_lines(_events(spark, folder).select("event_type", amount.alias("amount")), at, separator=" ")
    return parse_pairs(text_lines(spark, at)).groupBy("k").agg(F.count("*").alias("n"), F.sum(F.col("v").cast("bigint")).alias("total"))


@query
def kafka_records(spark, folder):
    """Records as a message log hands them out: JSON bodies, some of them damaged, with partition, offset and time."""
    body = F.when(F.pmod("event_id", F.lit(7)) == 0, F.lit("{broken")).otherwise(
        F.to_json(F.struct("user_id", F.col("event_type").alias("kind"), F.floor("value").alias("amount"))))
    records = _events(spark, folder).select(
        body.cast("binary").alias("value"), F.pmod("user_id", F.lit(4)).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"))
    parsed = parse_records(records, "user_id bigint, kind string, amount bigint")
    return parsed.select("partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("at"), "user_id", "kind", "amount")


@query
def interval_shift(spark, folder):
    """Time arithmetic: shifted time, hour floor, epoch milliseconds, local time and time of day."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return _events(spark, folder).select(
        "event_id",
        (F.col("ts") - span("5 seconds")).alias("shifted"),
        F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("hour"),
        ms.alias("epoch_ms"),
        from_epoch_ms(ms, "Asia/Shanghai").alias("local_ts"),
        clock("ts").alias("time_of_day"),
    )


@query
def processing_time_column(spark, folder):
    """Orders stamped with their arrival in this query, which is one time for all."""
    stamped = testdata(spark, folder, "orders").select("o_orderkey", processing_time().alias("arrived"))
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("arrived")
    return stamped.groupBy("arrived").agg(F.count("*").alias("orders"), F.max(age).alias("age")).select("orders", (F.col("age") == 0).alias("now"))


@query
def insert_rows(spark, folder):
    """A query appended to a catalog table by position, twice."""
    at, name = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}", f"inserted_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (customer bigint, orders bigint) USING parquet LOCATION '{at}'")
    counted = testdata(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    insert_into(counted.filter("o_custkey % 2 = 0"), name)
    insert_into(counted.filter("o_custkey % 2 = 1"), name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema("customer bigint, orders bigint").parquet(at)


# -- keyed tables -------------------------------------------------------------------------------------


def _order_log(spark, folder):
    """Orders as a commit log of customers: seven commits, the newest order date counts."""
    orders = testdata(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", F.pmod("o_orderkey", F.lit(7)).alias("_commit")
    )
    return orders.withColumn("_op", F.lit("U"))


_LOG_KEYS = dict(keys="o_custkey", ordering="o_orderdate", tie=["o_orderkey"])


@query
def upsert_latest(spark, folder):
    return keyed_table.upsert_latest(_order_log(spark, folder), **_LOG_KEYS)


@query
def snapshot_as_of(spark, folder):
    return keyed_table.snapshot(_order_log(spark, folder), as_of=2, **_LOG_KEYS)


@query
def incremental_range(spark, folder):
    return keyed_table.incremental(_order_log(spark, folder), frm=1, to=3, **_LOG_KEYS)


@query
def read_optimized(spark, folder):
    return keyed_table.read_optimized(_order_log(spark, folder), every=3, **_LOG_KEYS)


@query
def read_optimized_timed(spark, folder):
    """Compaction after three commits and fifteen days. A commit holds one to nine days of orders; its time is its last order's."""
    day = F.datediff("o_orderdate", F.lit("1992-01-01").cast("date"))
    orders = testdata(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    stretch = F.floor(day / 100)
    log = orders.withColumns({"_commit": stretch * 1000 + F.floor(F.pmod(day, F.lit(100)) / (stretch % 9 + 1)), "_op": F.lit("U")})
    log = log.filter(F.col("o_orderkey") % 3 > 0)
    commits = log.groupBy("_commit").agg(F.max("o_orderdate").alias("time"))
    return keyed_table.read_optimized(log, every=3, commits=commits, span_text="15 days", **_LOG_KEYS)


@query
def merge_batch(spark, folder):
    """The last two commits merged into a compacted table of the five before."""
    log = _order_log(spark, folder)
    shortened = keyed_table.compact(log, as_of=4, **_LOG_KEYS)
    return keyed_table.upsert_latest(shortened, **_LOG_KEYS)


@query
def merge_rows(spark, folder):
    """The rows of the last two commits merged into the table of all before, newest order date first."""
    orders = testdata(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    late = F.pmod("o_orderkey", F.lit(7)) > 4
    return keyed_table.merge_rows(orders.filter(~late), orders.filter(late), **_LOG_KEYS)


@query
def bootstrap_evolve(spark, folder):
    """An existing table as commit 0, then a commit of another schema: without prices, with a note."""
    schema = testdata(spark, folder, "orders").schema
    first = keyed_table.bootstrap(spark, f"{folder}/orders.parquet", schema).drop("o_orderpriority")
    urgent = testdata(spark, folder, "orders").filter(F.pmod("o_orderkey", F.lit(4)) == 0).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", F.lit("again").alias("note"))
    log = keyed_table.evolve(first, keyed_table.as_commit(urgent, 1))
    latest = keyed_table.upsert_latest(log, "o_orderkey", "o_orderdate")
    return latest.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice", "note")


@query
def delete_keys(spark, folder):
    gone = testdata(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    log = keyed_table.delete_keys(_order_log(spark, folder), gone, **_LOG_KEYS)
    return keyed_table.upsert_latest(log, **_LOG_KEYS)


@query
def struct_key_upsert(spark, folder):
    """Record key that is a struct."""
    log = _order_log(spark, folder).withColumn(
        "key", F.struct(F.pmod("o_custkey", F.lit(50)).alias("a"), (F.col("o_custkey") > 700).alias("b"))
    )
    latest = keyed_table.upsert_latest(log, "key", "o_orderdate", tie=["o_orderkey"])
    return latest.select("key.a", "key.b", "o_orderkey", "o_orderdate")


# -- ids ----------------------------------------------------------------------------------------------


def _with_ids(spark, folder):
    return ids.assign_ids(
        _events(spark, folder), "ts", F.pmod("user_id", F.lit(ids.WORKERS)), "event_id"
    ).select("event_id", "user_id", "ts", "id")


@query
def snowflake_encode(spark, folder):
    return _with_ids(spark, folder).select("event_id", "id")


@query
def snowflake_decode(spark, folder):
    return _with_ids(spark, folder).select("event_id", *[c.alias(n) for n, c in ids.decode_id("id").items()])


@query
def snowflake_overflow(spark, folder):
    """All orders fall into three milliseconds of two workers: ids spill over into the milliseconds after."""
    stamped = testdata(spark, folder, "orders").select(
        "o_orderkey", "o_custkey",
        F.timestamp_millis(F.lit(1_704_067_200_000) + F.pmod("o_orderkey", F.lit(3))).alias("ts"),
    )
    worker = F.when(F.pmod("o_custkey", F.lit(10)) < 8, 37).otherwise(38)
    return ids.assign_ids(stamped, "ts", worker, "o_orderkey").select("o_orderkey", "id")


# -- streams: the table arrives in three parts, one micro-batch each ----------------------------------


def _in_parts(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Add `part`: the third of the arrivals that a row is in."""
    return rows.withColumn("part", F.floor(F.col(seq) * 3 / (F.lit(rows.select(F.max(seq)).scalar()) + 1)).cast("int"))


@query
def changelog_stream(spark, folder):
    events = _arrivals(spark, folder).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    parts = _in_parts(events.select("user_id", "seq", "cents"))
    return replay(parts, "part", 3, lambda s: stream_changes(s, "user_id", "seq", "cents"), per_core=4)


@query
def changelog_stream_deletes(spark, folder):
    """Every third event is taken back 50,000,000 arrivals later, and at last all events of every fifth user."""
    events = _arrivals(spark, folder).select("user_id", "seq", F.round(F.col("value") * 100).cast("bigint").alias("cents"), F.lit(1).alias("sign"))
    third, fifth = F.pmod("seq", F.lit(3)) == 0, F.pmod("user_id", F.lit(5)) == 0
    again = lambda rows, later: rows.withColumns({"seq": F.col("seq") + later, "sign": F.lit(-1)})
    all_rows = (events.unionByName(again(events.filter(third), 50_000_000)).unionByName(again(events.filter(fifth & ~third), 100_000_000)))
    part = F.when(F.col("seq") >= 100_000_000, 2).when(F.col("seq") >= 50_000_000, 1).otherwise(0)
    changed = lambda s: stream_changes(s, "user_id", "seq", "cents", sign="sign")
    return replay(all_rows.withColumn("part", part), "part", 3, changed, per_core=4)


@query
def fired_window_rows(spark, folder):
    """Windows with their rows at every firing. Every 50th event comes one part later than its number says."""
    rows = _in_parts(_arrivals(spark, folder).select("event_id", "event_type", "ts", "seq"))
    later = F.least(F.col("part") + (F.pmod("event_id", F.lit(50)) == 0).cast("int"), F.lit(2))
    fired = replay(rows.withColumn("part", later), "part", 3, lambda s: fired_window_rows_stream(
        s, ["event_type"], "ts", "seq", "6 hours", "10 minutes", "5 days", spans=True))
    return each_firing(fired.select("event_id", "event_type", "window_end", "first_firing", "last_firing"))


@query
def dedup_interval_stream(spark, folder):
    rows = _in_parts(_events(spark, folder).select("event_id", "user_id", "ts"), "event_id")
    return replay(rows, "part", 3, lambda s: stream_dedup(s, ["user_id"], "ts", "12 hours", "event_id"))


@query
def snowflake_stream(spark, folder):
    """Ids handed out by three runs of one stream."""
    rows = _in_parts(_events(spark, folder).select("event_id", "user_id", "ts"), "event_id")
    worker = F.pmod("user_id", F.lit(ids.WORKERS))
    return replay(rows, "part", 3, lambda s: assign_ids_stream(s, "ts", worker, "event_id")).select("event_id", "id")


@query
def cow_upsert(spark, folder):
    """The current table of customers that a stream of orders leaves behind."""
    rows = _in_parts(testdata(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), "o_orderkey")
    at = replay_into(rows, "part", 3, lambda s, folder: current_table_sink(
        s, f"{folder}/table", "o_custkey", "o_orderdate", 16, f"{folder}/cp", tie=["o_orderkey"], available_now=True))
    return keyed_table.read_current(spark, f"{at}/table", rows.drop("part").schema)


@query
def multi_window_stream(spark, folder):
    """PV and UV at several sizes from one state; windows that the watermark has passed."""
    rows = _in_parts(_events(spark, folder).select("event_id", "user_id", "ts"), "event_id")
    return replay(rows, "part", 3, lambda s: stream_multi_window(s, "ts", "user_id", ["1 hour", "7 hours", "1 day"], "10 minutes"))


@query
def declared_watermark(spark, folder):
    """A declared table with a watermark, queried in SQL."""
    rows = _in_parts(_events(spark, folder).select("event_id", "user_id", "ts", "value"), "event_id")
    spec = TableSpec("declared_events", rows.drop("part").schema, event_time="ts", delay="10 minutes")

    def counted(source: DataFrame) -> DataFrame:
        spec.apply(source)
        return source.sparkSession.sql("""SELECT user_id, CAST(window.end AS TIMESTAMP_NTZ) AS window_end, count(value) AS count1
            FROM declared_events GROUP BY user_id, window(ts, '6 hours')""")

    return replay(rows, "part", 3, counted)


@query
def early_results(spark, folder):
    """The last of the early results of all windows, the open one too."""
    rows = _in_parts(_events(spark, folder).select("event_id", "user_id", "ts"), "event_id")

    def sink(source: DataFrame, at: str):
        write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{at}/out/batch={n}")
        return batch_sink(pv_uv_early(source, "ts", "user_id", "1 day", "1 hour", "-8 hours"), write, f"{at}/cp", "update", available_now=True)

    shown = spark.read.parquet(f"{replay_into(rows, 'part', 3, sink)}/out")
    # Both measures only grow while a window is open.
    return shown.groupBy("window_start", "window_end", "measure").agg(F.max("value").alias("value"))


@query
def text_sink_lines(spark, folder):
    """Lines that a stream of three runs writes, each once."""
    rows = _in_parts(_events(spark, folder).select("event_id", "user_id", "event_type"), "event_id")
    at = replay_into(rows, "part", 3, lambda s, at: text_sink(s, f"{at}/out", f"{at}/cp", ["event_id", "event_type"], available_now=True))
    return spark.read.text(f"{at}/out")


@query
def upsert_sink_log(spark, folder):
    """Micro-batches appended to a commit log, read as the current table."""
    rows = _in_parts(testdata(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), "o_orderkey")
    at = replay_into(rows, "part", 3, lambda s, at: upsert_sink(s, f"{at}/log", f"{at}/cp", available_now=True))
    log = keyed_table.read_log(spark, f"{at}/log", rows.drop("part").schema)
    return keyed_table.upsert_latest(log, "o_custkey", "o_orderdate", tie=["o_orderkey"])


@query
def change_stream(spark, folder):
    """A log of a bulk insert and two commits, partitioned by status, followed as a stream to its end."""
    orders = _in_parts(testdata(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), "o_orderkey")
    at, columns = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}", ["o_orderkey", "o_totalprice", "o_orderstatus"]
    keyed_table.bulk_insert(orders.filter("part = 0").select(*columns), f"{at}/log", 1, ["o_orderstatus"])
    keyed_table.write_commit(orders.filter("part = 1").select(*columns), f"{at}/log", 2, partition_by=["o_orderstatus"])
    keyed_table.write_commit(orders.filter("part = 2").select(*columns), f"{at}/log", 3, keyed_table.DELETE, partition_by=["o_orderstatus"])
    followed = keyed_table.stream_log(spark, f"{at}/log", orders.select(*columns).schema)
    writer = followed.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/cp")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out").select(*columns, F.col("_commit").alias("commit"), F.col("_op").alias("op"))
