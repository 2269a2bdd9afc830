"""Cumulative windows on a stream: exact increments per step, summed up where they are read."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.times import type_of
from tideline.operators.windows import _cumulate_sizes
from tideline.streaming.windows import with_event_time

_COLUMNS = ["max_end", "visitor", "step_time", "views"]
_NOBODY = ""
_OUT = "step_time timestamp, views long, new_ids long"


class _FirstStep(StatefulProcessor):
    """State per (max window, id): whether the id was seen. Cleared by a timer at the window's end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._seen = handle.getValueState("seen", "yes boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # An id has at most one row per step here, and steps arrive in order from batch to batch.
        batch = pd.concat(list(rows))
        batch.columns = _COLUMNS
        batch = batch.sort_values("step_time")
        fresh = [0] * len(batch)
        if key[1] != _NOBODY and not self._seen.exists():
            fresh[0] = 1
            self._seen.update((True,))
            self._handle.registerTimer(int(batch["max_end"].iloc[0]))
        yield pd.DataFrame({"step_time": batch["step_time"], "views": batch["views"], "new_ids": fresh})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def cumulate_steps_stream(df: DataFrame, ts: str, id_col: str, step: str, max_size: str,
                          delay: str = "0 seconds") -> DataFrame:
    """Per step, once the watermark passes it: step start `ts`, views, and ids new to the max window.

    For append mode with the RocksDB state store. `operators.windows.cumulate_steps` turns the output,
    at most max_size/step rows per max window, into cumulative PV and UV.
    """
    _, max_us = _cumulate_sizes(step, max_size)
    kind = type_of(df, ts)
    per_id = (
        with_event_time(df, ts, delay)
        # Ids go to Python as text: a NULL among whole numbers would turn them into floating point there.
        .groupBy(F.window("_event_time", step).alias("w"),
                 F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(_NOBODY)).alias("visitor"))
        .agg(F.count(id_col).alias("views"))
    )
    at = F.window_time("w")
    staged = per_id.withColumn("step_time", at).select(
        F.unix_millis(F.window("step_time", max_size).getField("end")).alias("max_end"), "visitor", "step_time", "views"
    )
    flagged = staged.groupBy("max_end", "visitor").transformWithStateInPandas(
        statefulProcessor=_FirstStep(), outputStructType=_OUT, outputMode="Append", timeMode="EventTime",
        eventTimeColumnName="step_time",
    )
    steps = flagged.groupBy(F.window("step_time", step).alias("w")).agg(
        F.sum("views").alias("views"), F.sum("new_ids").alias("new_ids")
    )
    return steps.select(F.col("w.start").cast(kind).alias(ts), "views", "new_ids")
