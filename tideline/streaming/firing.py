"""Windows on a stream that fire with their rows, and again for rows that come within the allowed lateness."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.times import duration_us, micros, type_of
from tideline.streaming.dedup import _EXACT
from tideline.streaming.windows import with_event_time

# Rows of a window that stand in one entry of the state and go out together.
PIECE = 1_000
# Firings of a row that are made from one entry, and rows that a task makes, when spans become rows.
SPAN = 10_000
TASK_ROWS = 50_000_000


class _Firing(StatefulProcessor):
    """State per (key, window): its rows in pieces, and how often it has fired.

    Spark's watermark here trails by the lateness too. So a window is due when that watermark comes within the lateness of its end,
    and done when it reaches the end. A timer expires once the watermark is greater than it.

    A row goes out once per batch, with the first and the last firing of that batch that it is in, however often the window fires.
    """

    def __init__(self, lateness_ms: int, piece: int):
        self._lateness, self._piece = lateness_ms, piece

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getListState("rows", "records array<string>")
        self._fired = handle.getValueState("fired", "times long")

    def _times(self) -> int:
        return self._fired.get()[0] if self._fired.exists() else 0

    def _kept(self, first: int, last: int) -> Iterator[pd.DataFrame]:
        for (records,) in self._rows.get():
            yield pd.DataFrame({"first": first, "last": last, "record": list(records)})

    def _keep(self, records: list[str]) -> None:
        for i in range(0, len(records), self._piece):
            self._rows.appendValue((records[i:i + self._piece],))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = int(key[1])
        now = timerValues.getCurrentWatermarkInMs()
        records = pd.concat(list(rows)).sort_values("place", kind="stable")["record"].tolist()
        if now >= end:  # the window is gone
            yield pd.DataFrame({"first": 0, "last": 0, "record": records})
            return
        if now < end - self._lateness:
            if not self._fired.exists():
                self._fired.update((0,))
                for timer in {end - self._lateness - 1, end - 1}:
                    self._handle.registerTimer(timer)
            self._keep(records)
            return
        due = self._fired.exists()  # since the last batch, if it has not fired; the rows of this one come after
        if not due:
            self._handle.registerTimer(end - 1)
        before = self._times()
        first, times = (1, 1) if due and before == 0 else (before + 1, before)
        last = times + len(records)
        yield from self._kept(first, last)
        for i in range(0, len(records), self._piece):
            part = records[i:i + self._piece]
            yield pd.DataFrame({"first": range(times + 1 + i, times + 1 + i + len(part)), "last": last, "record": part})
        self._keep(records)
        self._fired.update((last,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = int(key[1])
        if self._fired.exists() and self._times() == 0:
            self._fired.update((1,))
            yield from self._kept(1, 1)
        if expiredTimerInfo.getExpiryTimeInMs() >= end - 1:
            self._rows.clear()
            self._fired.clear()

    def close(self) -> None:
        pass


def fired_window_rows_stream(df: DataFrame, keys: Sequence[str], ts: str, seq: str, size: str, delay: str = "0 seconds",
                             lateness: str = "0 seconds", piece: int = PIECE, spans: bool = False) -> DataFrame:
    """The rows of every window each time it fires: the columns of df, window_start, window_end, firing. RocksDB state store.

    A window of a key fires when the watermark (`delay` behind the latest event time of all batches before) reaches its end, with
    the rows so far: firing 1. Each row that comes later, but within `lateness`, fires it again with all rows so far. Rows still later
    come out alone as firing 0. Rows of one batch count in the order of `seq`; NULL times are left out. Rows are
    kept and sent `piece` at a time, so that a window may be larger than one value of the state.

    spans: one row for a batch's firings that a row is in, with first_firing and last_firing instead of firing. There are
    no more of them than rows that the batch's windows hold; `each_firing` makes the rows of them when the output is read.
    """
    step, late = duration_us(size), duration_us(lateness)
    if step % 1000 or late % 1000:
        raise ValueError("windows and lateness are whole milliseconds")
    timed = with_event_time(df.filter(F.col(ts).isNotNull()), ts, f"{duration_us(delay) + late} microseconds")
    start = micros(ts) - F.pmod(micros(ts), F.lit(step))
    # Without the event time itself in these columns Spark drops no row ahead of the state; the windows judge their rows.
    staged = timed.select(
        F.to_json(F.struct(*keys), _EXACT).alias("key"), ((start + step) / 1000).cast("bigint").alias("end"),
        F.col(seq).cast("bigint").alias("place"), F.to_json(F.struct(*df.columns), _EXACT).alias("record"))
    fired = staged.groupBy("key", "end").transformWithStateInPandas(
        statefulProcessor=_Firing(late // 1000, piece), outputStructType="first bigint, last bigint, record string",
        outputMode="Append", timeMode="EventTime")
    read = fired.select("first", "last", F.from_json("record", df.schema, _EXACT).alias("record"))
    begin = micros(F.col(f"record.{ts}")) - F.pmod(micros(F.col(f"record.{ts}")), F.lit(step))
    bound = lambda at: F.timestamp_micros(at).cast(type_of(df, ts))
    rows = read.select("record.*", bound(begin).alias("window_start"), bound(begin + step).alias("window_end"),
                       F.col("first").alias("first_firing"), F.col("last").alias("last_firing"))
    return rows if spans else _expanded(_short(rows, SPAN))


def _short(spans: DataFrame, span: int) -> DataFrame:
    """The same in spans of at most `span` firings."""
    first, last = F.col("first_firing"), F.col("last_firing")
    columns = [c for c in spans.columns if c not in ("first_firing", "last_firing")]
    cut = spans.select(*columns, F.explode(F.sequence(first, last, F.lit(span).cast("bigint"))).alias("first_firing"), "last_firing")
    return cut.withColumn("last_firing", F.least(last, first + (span - 1)))


def _expanded(spans: DataFrame) -> DataFrame:
    columns = [c for c in spans.columns if c not in ("first_firing", "last_firing")]
    return spans.select(*columns, F.explode(F.sequence("first_firing", "last_firing")).alias("firing"))


def each_firing(spans: DataFrame, task_rows: int = TASK_ROWS, span: int = SPAN) -> DataFrame:
    """The rows of all firings from a table of their spans. The number of tasks grows with the rows; each makes about `task_rows`."""
    total = spans.select(F.sum(F.col("last_firing") - F.col("first_firing") + 1)).first()[0] or 0
    parts = max(spans.sparkSession.sparkContext.defaultParallelism, -(-total // task_rows))
    return _expanded(_short(spans, span).repartition(parts))
