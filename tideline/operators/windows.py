"""Event-time windows: epoch-aligned, half-open [start, end)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.times import duration_us, from_micros, micros, type_of

BOUNDS = ("window_start", "window_end")


def tumble(df: DataFrame, ts: str, size: str, offset: str = "0 seconds") -> DataFrame:
    """Add window_start and window_end; rows without a timestamp are in no window.

    `offset` moves the grid: "-8 hours" puts one-day windows on midnight of UTC+8.
    """
    return (
        df.withColumn("_w", F.window(ts, size, size, _positive_offset(size, offset)))
        .withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")})
        .drop("_w")
    )


def _positive_offset(size: str, offset: str) -> str:
    return f"{duration_us(offset) % duration_us(size)} microseconds"


def tumble_multi(df: DataFrame, ts: str, sizes: Sequence[str]) -> DataFrame:
    """Like `tumble` for several sizes at once: one scan, one row per size, labelled `window_size`."""
    return _fan_out(df.filter(F.col(ts).isNotNull()), micros(ts), type_of(df, ts), sizes)


def _fan_out(df: DataFrame, us: Column, kind, sizes: Sequence[str]) -> DataFrame:
    options = []
    for size in sizes:
        width = F.lit(duration_us(size))
        start = us - F.pmod(us, width)
        options.append(
            F.struct(
                F.lit(size).alias("window_size"),
                from_micros(start, kind).alias("window_start"),
                from_micros(start + width, kind).alias("window_end"),
            )
        )
    return df.select("*", F.inline(F.array(*options)))


def pv_uv(df: DataFrame, id_col: str, keys: Sequence[str] = BOUNDS) -> DataFrame:
    """Page views (non-null ids) and exact unique visitors per key.

    Spark plans the distinct count as two shuffles, first on (keys, id), so a crowded window is still
    spread over tasks.
    """
    return df.groupBy(*keys).agg(
        F.count(id_col).alias("pv"), F.countDistinct(id_col).alias("uv")
    )


def multi_window_pv_uv(df: DataFrame, ts: str, id_col: str, sizes: Sequence[str]) -> DataFrame:
    """PV and UV at several tumbling sizes.

    The rows are first reduced to (slice, id) counts, the slice being the greatest common divisor of the
    sizes. Those go to the tasks by id, at most one row per slice, and are copied once per size only there:
    an id's copies meet in their task, so just per-window sums are shuffled after that. Windows with no
    non-null id still show up, with zeros.
    """
    slice_us = reduce(gcd, (duration_us(s) for s in sizes))
    us = micros(ts)
    slices = (
        df.filter(F.col(ts).isNotNull())
        .groupBy((us - F.pmod(us, F.lit(slice_us))).alias("_slice"), id_col)
        .agg(F.count(id_col).alias("_views"))
        .repartition(id_col)
    )
    return (
        _fan_out(slices, F.col("_slice"), type_of(df, ts), sizes)
        .groupBy("window_size", *BOUNDS, id_col)
        .agg(F.sum("_views").alias("_views"))
        .groupBy("window_size", *BOUNDS)
        .agg(F.sum("_views").alias("pv"), F.count(id_col).alias("uv"))
    )


def _cumulate_sizes(step: str, max_size: str) -> tuple[int, int]:
    step_us, max_us = duration_us(step), duration_us(max_size)
    if step_us <= 0 or max_us % step_us:
        raise ValueError("max_size must be a multiple of step")
    return step_us, max_us


def cumulate_pv_uv(df: DataFrame, ts: str, id_col: str, step: str, max_size: str) -> DataFrame:
    """PV and UV over cumulative windows without copying rows.

    Rows shrink to (max window, id, step) counts. An id counts as a visitor in its first step only, so both
    measures are running sums over the steps of a max window (at most max_size/step of them). Every step
    from the first with data to the end of the max window gives a row.
    """
    step_us, max_us = _cumulate_sizes(step, max_size)
    us, kind = micros(ts), type_of(df, ts)
    per_id = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(
            (us - F.pmod(us, F.lit(max_us))).alias("_max"),
            (us - F.pmod(us, F.lit(step_us))).alias("_step"),
            id_col,
        )
        .agg(F.count(id_col).alias("_views"))
    )
    first_step = F.min("_step").over(Window.partitionBy("_max", id_col))
    per_step = (
        per_id.withColumn("_new", (F.col(id_col).isNotNull() & (F.col("_step") == first_step)).cast("bigint"))
        .groupBy("_max", "_step")
        .agg(F.sum("_views").alias("_views"), F.sum("_new").alias("_new"))
    )
    return _accumulate(per_step, step_us, max_us, kind)


def cumulate_steps(steps: DataFrame, ts: str, step: str, max_size: str) -> DataFrame:
    """Cumulative windows from increments per step: columns `ts` (start of the step), views and new_ids."""
    step_us, max_us = _cumulate_sizes(step, max_size)
    at = micros(ts)
    per_step = steps.groupBy((at - F.pmod(at, F.lit(max_us))).alias("_max"), at.alias("_step")).agg(
        F.sum("views").alias("_views"), F.sum("new_ids").alias("_new")
    )
    return _accumulate(per_step, step_us, max_us, type_of(steps, ts))


def _accumulate(per_step: DataFrame, step_us: int, max_us: int, kind: T.DataType) -> DataFrame:
    """Running sums over the steps of each max window, with a row for every step up to its end."""
    in_order = Window.partitionBy("_max").orderBy("_step")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_step = F.col("_max") + max_us - step_us
    # Fill the steps without rows by holding each value up to the next step that has some.
    held = per_step.select(
        "_max",
        "_step",
        F.sum("_views").over(upto).alias("pv"),
        F.sum("_new").over(upto).alias("uv"),
        F.coalesce(F.lead("_step").over(in_order) - step_us, last_step).alias("_until"),
    )
    return held.select(
        "_max", F.explode(F.sequence("_step", "_until", F.lit(step_us))).alias("_at"), "pv", "uv"
    ).select(
        from_micros(F.col("_max"), kind).alias("window_start"),
        from_micros(F.col("_at") + step_us, kind).alias("window_end"),
        "pv",
        "uv",
    )
