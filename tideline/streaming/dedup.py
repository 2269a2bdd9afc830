"""Interval deduplication on a stream: keyed state, cleared by a timer or by a time to live."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.times import duration_us, micros
from tideline.streaming.windows import with_event_time

_STATE = "free_from long"
_EXACT = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


class _PassFirst(StatefulProcessor):
    """State per key: the earliest stamp that may pass next."""

    def __init__(self, interval_us: int, event_time: bool):
        self._interval_us = interval_us
        self._event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        ttl = None if self._event_time else self._interval_us // 1000
        self._free = handle.getValueState("free", _STATE, ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        free = self._free.get()[0] if self._free.exists() else None
        before = free
        batch = pd.concat([part[part["stamp"] >= free] if free is not None else part for part in rows])
        batch = batch.sort_values(["stamp", "place"], kind="stable")
        stamps = batch["stamp"].to_numpy()
        passed, at = [], 0
        while at < len(stamps):
            if free is not None and stamps[at] < free:
                at = int(stamps.searchsorted(free, side="left"))
                continue
            passed.append(at)
            free = int(stamps[at]) + self._interval_us
        if free != before:
            self._free.update((free,))
            if self._event_time:
                for timer in list(self._handle.listTimers()):
                    self._handle.deleteTimer(timer)
                self._handle.registerTimer(-(-free // 1000))
        if passed:
            yield batch.iloc[passed][["record"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._free.clear()
        return iter(())

    def close(self) -> None:
        pass


def dedup_interval_stream(df: DataFrame, keys: Sequence[str], ts: str, interval: str, order: str, *,
                          delay: str = "1 second", processing_ttl: bool = False) -> DataFrame:
    """Pass a row, then drop its key's rows until `interval` after it. Needs the RocksDB state store.

    The default clears a key by an event-time timer, once the watermark has passed its interval. `processing_ttl` lets the
    state expire by wall clock instead; Spark does not mix the two in one operator. A key's rows of one micro-batch that may still
    pass are held together. The watermark only clears state, it holds back no row: a row later than `delay` passes if nothing is
    known of its key, new or cleared, and its state goes with the same batch.
    """
    rows = df.filter(F.col(ts).isNotNull())
    if not processing_ttl:
        rows = with_event_time(rows, ts, delay)
    # Record and key travel as text: whole numbers next to NULLs would become floating point in Python.
    # Without the event time itself in these columns Spark drops no late row ahead of the state.
    staged = rows.select(
        F.to_json(F.struct(*keys), _EXACT).alias("key"), micros(ts).alias("stamp"), F.col(order).alias("place"),
        F.to_json(F.struct(*df.columns), _EXACT).alias("record"),
    )
    return staged.groupBy("key").transformWithStateInPandas(
        statefulProcessor=_PassFirst(duration_us(interval), not processing_ttl),
        outputStructType="record string",
        outputMode="Append",
        timeMode="ProcessingTime" if processing_ttl else "EventTime",
    ).select(F.from_json("record", df.schema, _EXACT).alias("record")).select("record.*")
