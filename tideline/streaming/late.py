"""Row-exact late-data split on a stream, with a side output for late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tideline.functions.times import micros
from tideline.operators.watermark import tag_late
from tideline.streaming.sinks import batch_sink

_STATE = "batch long, max_us long"
# A repeated batch needs what the one before it left; a few more are kept, in turn.
_SLOTS = 4


def _slot(folder: str, batch_id: int) -> str:
    return f"{folder}/slot={batch_id % _SLOTS}"


def _carried(spark: SparkSession, folder: str, batch_id: int) -> int | None:
    """Largest timestamp (microseconds) before this batch. It was written by the batch before, so a repeat reads the same."""
    if batch_id == 0:
        return None
    row = spark.read.schema(_STATE).parquet(_slot(folder, batch_id - 1)).first()
    if row["batch"] != batch_id - 1:
        raise ValueError(f"batch {batch_id - 1} left no timestamp")
    return row["max_us"]


def split_late_stream(
    df: DataFrame, ts: str, seq: str, size: str, delay: str, path: str, checkpoint: str, *,
    lateness: str = "0 seconds", interval: str | None = "2 seconds", available_now: bool = False,
) -> DataStreamWriter:
    """Write each micro-batch once to `path`, partitioned by batch and `is_late`: rows in time, and rows too late.

    Each batch replays its rows in order of `seq` from the largest timestamp of all batches before, which
    is kept beside the checkpoint for the last few batches. `seq` must not go back from one batch to the next.
    """
    carry = f"{checkpoint}/carried"

    def work(batch: DataFrame, batch_id: int) -> None:
        spark, out = batch.sparkSession, f"{path}/batch={batch_id}"
        before = _carried(spark, carry, batch_id)
        # The replay looks at the rows twice; kept, the source is read once.
        batch.persist()
        try:
            start = F.timestamp_micros(F.lit(before).cast("bigint"))
            tagged = tag_late(batch, ts, seq, size, delay, lateness, start_max=start)
            tagged.write.mode("overwrite").partitionBy("is_late").parquet(out)
            latest = batch.agg(F.greatest(F.max(micros(ts)), F.lit(before).cast("bigint")).alias("max_us"))
            latest.select(F.lit(batch_id).cast("bigint").alias("batch"), "max_us").coalesce(1).write.mode("overwrite").parquet(
                _slot(carry, batch_id))
        finally:
            batch.unpersist()

    return batch_sink(df, work, checkpoint, "append", interval, available_now)
