"""Windowed counts as native Structured Streaming queries.

Late rows are judged by the watermark of the previous micro-batch; `operators.watermark` has the row-exact form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.times import duration_us, type_of
from tideline.operators.windows import _positive_offset


EVENT_TIME = "_event_time"
# Spark's mark of an event-time column: the delay of its watermark in milliseconds.
_WATERMARK = "spark.watermarkDelayMs"


def with_event_time(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Declare the event time, in a column of its own: Spark takes only TIMESTAMP, not TIMESTAMP_NTZ."""
    return df.withColumn(EVENT_TIME, F.col(ts).cast("timestamp")).withWatermark(EVENT_TIME, delay)


def _window(size: str, offset: str = "0 seconds", column: Column | str = EVENT_TIME) -> Column:
    return F.window(column, size, size, _positive_offset(size, offset))


def _bounds(df: DataFrame, column: str, kind: T.DataType, *rest: str) -> DataFrame:
    """Window bounds in the type of the source's timestamp."""
    return df.select(
        F.col(f"{column}.start").cast(kind).alias("window_start"), F.col(f"{column}.end").cast(kind).alias("window_end"), *rest
    )


def pv_uv_stream(df: DataFrame, ts: str, id_col: str, size: str, delay: str = "0 seconds",
                 offset: str = "0 seconds") -> DataFrame:
    """PV and exact UV per tumbling window, for append mode.

    Spark refuses a distinct count on a stream. Counting per (window, id) first and then per window gives it,
    and keeps the state of a crowded window spread over the ids.
    """
    per_id = with_event_time(df, ts, delay).groupBy(_window(size, offset).alias("w"), id_col).agg(F.count(id_col).alias("_n"))
    counted = per_id.groupBy(_window(size, offset, F.window_time("w")).alias("w2")).agg(
        F.sum("_n").alias("pv"), F.count(id_col).alias("uv")
    )
    return _bounds(counted, "w2", type_of(df, ts), "pv", "uv")


def pv_uv_early(df: DataFrame, ts: str, id_col: str, size: str, delay: str = "0 seconds",
                offset: str = "0 seconds") -> DataFrame:
    """PV and UV of windows that are still open, for update mode with a processing-time trigger.

    Rows are (window_start, window_end, measure, value) with measure "pv" or "uv"; the last one counts. The
    ids of a window are spread over the state of a streaming deduplication, not held in one value.
    """
    timed = with_event_time(df, ts, delay).select(_window(size, offset).alias("w"), id_col)
    views = timed.groupBy("w").agg(F.count(id_col).alias("value")).withColumn("measure", F.lit("pv"))
    visitors = (
        timed.filter(F.col(id_col).isNotNull()).dropDuplicates(["w", id_col])
        .groupBy("w").agg(F.count(id_col).alias("value")).withColumn("measure", F.lit("uv"))
    )
    return _bounds(views.unionByName(visitors), "w", type_of(df, ts), "measure", "value")


def multi_window_pv_uv_stream(df: DataFrame, ts: str, id_col: str, sizes: Sequence[str],
                              delay: str = "0 seconds") -> DataFrame:
    """`pv_uv_stream` at several sizes in one output, labelled by window_size, from one source with one state.

    Every row is fanned out to its window of each size ahead of one aggregation per (size, window, id) and one per
    (size, window). A window computed by hand is told to Spark as one over the event time, by the mark that the declared column has.
    """
    at = F.unix_micros(EVENT_TIME)
    moment = lambda us: F.timestamp_micros(us)

    def window_of(size: str) -> Column:
        step = duration_us(size)
        start = at - F.pmod(at, F.lit(step))
        return F.struct(F.lit(size).alias("size"), F.struct(moment(start).alias("start"), moment(start + step).alias("end")).alias("w"))

    mark = {_WATERMARK: duration_us(delay) // 1000}
    timed = with_event_time(df.filter(F.col(ts).isNotNull()), ts, delay)
    fanned = timed.select(F.col(id_col).alias("id"), F.explode(F.array(*[window_of(s) for s in sizes])).alias("x"))
    each = fanned.select("id", F.col("x.size").alias("window_size"), F.col("x.w").alias("w", metadata=mark))
    per_id = each.groupBy("window_size", "w", "id").agg(F.count("id").alias("_n"))
    counted = per_id.groupBy("window_size", "w").agg(F.sum("_n").alias("pv"), F.count("id").alias("uv"))
    return _bounds(counted, "w", type_of(df, ts), "pv", "uv", "window_size")


def window_stats_stream(df: DataFrame, keys: Sequence[str], ts: str, value: str, size: str,
                        delay: str = "0 seconds", lateness: str = "0 seconds") -> DataFrame:
    """max, min, sum, avg and count per key and window.

    In append mode a window shows once, when the watermark passes it. With `lateness` the state is kept
    that much longer; in update mode every late row then shows its window again.
    """
    kept = f"{duration_us(delay) + duration_us(lateness)} microseconds"
    stats = with_event_time(df, ts, kept).groupBy(*keys, _window(size).alias("w")).agg(
        F.max(value).alias("max"), F.min(value).alias("min"), F.sum(value).alias("sum"),
        F.avg(value).alias("avg"), F.count(value).alias("counts"),
    )
    return _bounds(stats, "w", type_of(df, ts), *keys, "max", "min", "sum", "avg", "counts")


def distinct_per_hour_stream(df: DataFrame, key: str, ts: str, device: str, delay: str = "0 seconds") -> DataFrame:
    """Distinct devices per (key, hour), for append mode: two levels, as in `pv_uv_stream`."""
    per_device = with_event_time(df, ts, delay).groupBy(_window("1 hour").alias("w"), key, device).agg(F.count("*").alias("_n"))
    counted = per_device.groupBy(_window("1 hour", column=F.window_time("w")).alias("w2"), key).agg(F.count(device).alias("devices"))
    return counted.select(key, F.col("w2.end").cast(type_of(df, ts)).alias("hour_end"), "devices")
