"""Sinks for streaming queries. Those that write tables are safe to repeat for a batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tideline.operators.keyed_table import UPSERT, copy_on_write, write_commit
from tideline.sources.text import as_lines


def _timed(writer: DataStreamWriter, interval: str | None, available_now: bool) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def preview_sink(df: DataFrame, rows: int, mode: str = "update", interval: str | None = None) -> DataStreamWriter:
    """The first `rows` rows of every batch to the console; the rest of a batch is not shown. For the whole output use
    `text_sink` or `table_sink`. `interval` gives early results of open windows in update mode."""
    writer = df.writeStream.format("console").outputMode(mode).option("truncate", False).option("numRows", rows)
    return _timed(writer, interval, False)


def text_sink(df: DataFrame, path: str, checkpoint: str, columns: list[str] | None = None,
              separator: str = ",", interval: str | None = None, available_now: bool = False) -> DataStreamWriter:
    """Rows as text lines, each exactly once."""
    writer = as_lines(df, columns, separator).writeStream.format("text").outputMode("append")
    return _timed(writer.option("path", path).option("checkpointLocation", checkpoint), interval, available_now)


def table_sink(df: DataFrame, checkpoint: str, mode: str = "append", interval: str | None = "10 seconds",
               available_now: bool = False) -> DataStreamWriter:
    """Writer for `.toTable(name)`."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return _timed(writer, interval, available_now)


def batch_sink(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
               interval: str | None = "10 seconds", available_now: bool = False) -> DataStreamWriter:
    """Run `work(batch, batch_id)` per micro-batch. Work must be repeatable for an id."""
    writer = df.writeStream.outputMode(mode).foreachBatch(work).option("checkpointLocation", checkpoint)
    return _timed(writer, interval, available_now)


def upsert_sink(df: DataFrame, log_path: str, checkpoint: str, op: str = UPSERT, partition_by: Sequence[str] = (),
                first_commit: int = 1, interval: str | None = "10 seconds", available_now: bool = False) -> DataStreamWriter:
    """Append each micro-batch to a commit log as commit `first_commit + batch_id`.

    A repeated batch finds its commit complete and leaves it, so each batch counts once, here and for followers. Read the log with
    `operators.keyed_table`. Where earlier commits exist, set `first_commit` past them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_commit(batch, log_path, first_commit + batch_id, op, partition_by, once=True)

    return batch_sink(df, write, checkpoint, "append", interval, available_now)


def current_table_sink(df: DataFrame, path: str, keys: str | Sequence[str], ordering: str, buckets: int, checkpoint: str,
                       tie: Sequence[str] = (), op: str | None = None, interval: str | None = "10 seconds",
                       available_now: bool = False) -> DataStreamWriter:
    """Merge each micro-batch into a table of current rows, of which only the buckets that the batch touches are rewritten. A repeated
    batch changes nothing. Read it with `operators.keyed_table.read_current`, or as any folder of Parquet files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        copy_on_write(batch, path, keys, ordering, buckets, tie, op)

    return batch_sink(df, write, checkpoint, "append", interval, available_now)


def changes(df: DataFrame, key: str, value: str, agg: str = "sum") -> DataFrame:
    """Un-windowed group aggregate as an update stream (for update mode): each new total of a key."""
    aggregate = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[agg]
    return df.groupBy(key).agg(aggregate(value).alias("result"))
