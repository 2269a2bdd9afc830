"""Watermarks replayed row by row over a table, with late rows, side output and re-firing.

The replay is exact: a row is judged by the watermark just before it. Structured Streaming judges by the
watermark of the previous micro-batch, see `streaming.windows` for that form.

All take `seq`, a unique BIGINT arrival number from 0 (a log offset, for example; `number_rows` makes one).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.times import MILLISECOND, span
from tideline.operators.running import SEQ_BITS, running, seq_bucket
from tideline.operators.windows import BOUNDS, tumble


def _mark(max_ts: Column, delay: str, per_event: bool) -> Column:
    """Watermark after a maximum timestamp. A per-event generator emits the timestamp itself."""
    return max_ts if per_event else max_ts - span(delay) - F.lit(MILLISECOND)


def replay_watermark(
    df: DataFrame, ts: str, seq: str, delay: str = "0 seconds", *,
    per_event: bool = False, start_max: datetime | Column | None = None, bucket_bits: int = SEQ_BITS, dense: bool = True,
) -> DataFrame:
    """Add `wm_before`, the watermark that holds when the row arrives; NULL before the first row.

    start_max: largest timestamp seen before this table, to go on from an earlier part of a stream. dense: arrival numbers are
    offsets or row numbers, so that one fold of 2**16 buckets of 2**16 numbers does; say False for hashes or sparse ids.
    """
    seen = running(df, [], [seq], {"_max_ts": ("max", ts)}, seq_bucket(seq, bucket_bits), levels=1 if dense else 2)
    max_before = F.col("_max_ts_before")
    if start_max is not None:
        max_before = F.greatest(max_before, F.lit(start_max).cast(df.schema[ts].dataType))
    return seen.withColumn("wm_before", _mark(max_before, delay, per_event)).drop("_max_ts", "_max_ts_before")


def tag_late(
    df: DataFrame, ts: str, seq: str, size: str, delay: str = "0 seconds", lateness: str = "0 seconds", **replay
) -> DataFrame:
    """Add window bounds, `wm_before` and `is_late`: the watermark had passed end - 1 ms + lateness."""
    timed = df.filter(F.col(ts).isNotNull())  # a row without time moves no watermark and is in no window
    return judge_late(replay_watermark(timed, ts, seq, delay, **replay), ts, size, lateness)


def judge_late(df: DataFrame, ts: str, size: str, lateness: str = "0 seconds") -> DataFrame:
    """Add window bounds and `is_late` to rows with `wm_before`, of whatever watermark."""
    judged = tumble(df, ts, size)
    closes = F.col("window_end") - F.lit(MILLISECOND) + span(lateness)
    return judged.withColumn("is_late", F.coalesce(closes <= F.col("wm_before"), F.lit(False)))


def split_late(
    df: DataFrame, ts: str, seq: str, size: str, delay: str = "0 seconds", lateness: str = "0 seconds", **replay
) -> tuple[DataFrame, DataFrame]:
    """(rows that reach their window, rows too late for it)."""
    tagged = tag_late(df, ts, seq, size, delay, lateness, **replay)
    return tagged.filter(~F.col("is_late")).drop("is_late"), tagged.filter("is_late").drop("is_late")


def final_watermark(df: DataFrame, ts: str, delay: str = "0 seconds", per_event: bool = False) -> Column:
    """Watermark after the last row, as a scalar subquery."""
    return _mark(df.select(F.max(ts)).scalar(), delay, per_event)


def window_firings(
    df: DataFrame, ts: str, seq: str, size: str, delay: str = "0 seconds", lateness: str = "0 seconds", *,
    value: str, keys: Sequence[str] = (), flush: bool = False, per_event: bool = False,
    bucket_bits: int = SEQ_BITS,
) -> DataFrame:
    """One row per (key, window, firing): count and sum of the window's contents at that firing.

    The first firing holds the rows that came in time. Each row that comes after it, but within the allowed
    lateness, fires the window again. `flush` also fires windows that are still open at the end.
    """
    keys = list(keys)
    kept, _ = split_late(df, ts, seq, size, delay, lateness, per_event=per_event, bucket_bits=bucket_bits)
    last_moment = F.col("window_end") - F.lit(MILLISECOND)
    in_time = F.coalesce(F.col("wm_before") < last_moment, F.lit(True))
    # One row per firing: rows in time share the place before all others, each later row has its own.
    fired = kept.groupBy(*keys, *BOUNDS, F.when(in_time, -1).otherwise(F.col(seq)).alias("_at")).agg(
        F.count("*").alias("_n"), F.sum(value).alias("_v")
    )
    if not flush:
        fired = fired.filter((F.col("_at") >= 0) | (last_moment <= final_watermark(df, ts, delay, per_event)))
    counted = running(
        fired, [*keys, *BOUNDS], ["_at"],
        {"firing": ("count", F.lit(1)), "rows": ("sum", "_n"), "total": ("sum", "_v")},
        seq_bucket("_at", bucket_bits),
    )
    return counted.select(*keys, *BOUNDS, "firing", "rows", "total")


def window_rows(df: DataFrame, ts: str, size: str) -> DataFrame:
    """The raw rows with the window each belongs to."""
    return tumble(df, ts, size)
