"""64-bit, time-ordered ids for the rows of a table, and their decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the id layout: 41 bits of milliseconds since the epoch below, data centre, machine, sequence.
EPOCH_MS = 1480166465631
DATACENTER_BITS = 5
MACHINE_BITS = 5
SEQUENCE_BITS = 12
TIME_BITS = 41

WORKERS = 1 << (DATACENTER_BITS + MACHINE_BITS)
PER_MS = 1 << SEQUENCE_BITS
_MACHINE_SHIFT = SEQUENCE_BITS
_DATACENTER_SHIFT = SEQUENCE_BITS + MACHINE_BITS
_TIME_SHIFT = SEQUENCE_BITS + MACHINE_BITS + DATACENTER_BITS


def _mask(bits: int) -> Column:
    return F.lit((1 << bits) - 1)


def encode_id(ms: Column, worker: Column, sequence: Column) -> Column:
    """Id from epoch milliseconds, worker (data centre * 32 + machine) and sequence; range-checked."""
    time = ms - F.lit(EPOCH_MS)
    valid = (
        time.between(0, (1 << TIME_BITS) - 1)
        & worker.between(0, WORKERS - 1)
        & sequence.between(0, PER_MS - 1)
    )
    bits = (
        F.shiftleft(time, _TIME_SHIFT)
        .bitwiseOR(F.shiftleft(worker.cast("bigint"), _MACHINE_SHIFT))
        .bitwiseOR(sequence.cast("bigint"))
    )
    return F.when(valid, bits).otherwise(
        F.raise_error(F.lit("id part out of range: time, worker or sequence")).cast("bigint")
    )


def worker_of(datacenter: Column, machine: Column) -> Column:
    """Worker number from data centre and machine; each must fit its bits."""
    valid = datacenter.between(0, (1 << DATACENTER_BITS) - 1) & machine.between(0, (1 << MACHINE_BITS) - 1)
    return F.when(valid, datacenter * (1 << MACHINE_BITS) + machine).otherwise(
        F.raise_error(F.lit("data centre or machine out of range")).cast("bigint")
    )


def decode_id(column: str | Column) -> dict[str, Column]:
    """The parts of an id as columns: ms, datacenter, machine, sequence."""
    value = F.col(column) if isinstance(column, str) else column
    return {
        "ms": F.shiftrightunsigned(value, _TIME_SHIFT) + F.lit(EPOCH_MS),
        "datacenter": F.shiftrightunsigned(value, _DATACENTER_SHIFT).bitwiseAND(_mask(DATACENTER_BITS)),
        "machine": F.shiftrightunsigned(value, _MACHINE_SHIFT).bitwiseAND(_mask(MACHINE_BITS)),
        "sequence": value.bitwiseAND(_mask(SEQUENCE_BITS)),
    }


def assign_ids(df: DataFrame, ts: str, worker: Column, order: str, name: str = "id", *,
               order_bits: int = 16, ms_bits: int = 12) -> DataFrame:
    """Give every row an id unique in the table.

    worker: expression that spreads rows over 0..1023, stable per row. order: unique BIGINT that orders the rows of one
    millisecond. A worker has 4,096 ids per millisecond; further rows take the next free milliseconds, as a
    generator that waits for the clock would hand them out.

    Rows are counted in blocks of (worker, ms, order >> order_bits). A block of n rows takes the next free slot x to
    max(x, ms * 4096) + n, so a run of blocks takes x to max(x + a, b) for two numbers a and b, and such pairs compose. They
    are scanned in one pass: inside (worker, ms >> ms_bits), then over these buckets of a worker. Rows are numbered in their
    block alone, so a crowded millisecond is not one group. Take order_bits for blocks of some ten thousand rows: 16 for
    numbers that are nearly dense, 48 for hashes.
    """
    rows = df.withColumns({"_worker": worker.cast("bigint"), "_ms": F.unix_millis(F.col(ts).cast("timestamp")),
                           "_block": F.shiftright(F.col(order).cast("bigint"), order_bits)})
    block = ["_worker", "_ms", "_block"]
    none = F.lit(0).cast("bigint")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.groupBy(*block).agg(F.count("*").alias("_n")).withColumn("_bucket", F.shiftright("_ms", ms_bits))
    local = Window.partitionBy("_worker", "_bucket").orderBy("_ms", "_block")
    counted = counted.withColumn("_c", F.coalesce(F.sum("_n").over(before(local)), none))
    # With c rows before it, a block begins at c plus the maximum of (ms * 4096 - c) over the blocks up to it.
    counted = counted.withColumn("_m", F.max(F.col("_ms") * PER_MS - F.col("_c")).over(local.rowsBetween(Window.unboundedPreceding, 0)))
    buckets = counted.groupBy("_worker", "_bucket").agg(F.sum("_n").alias("_a"), F.max("_m").alias("_b"))
    over = Window.partitionBy("_worker").orderBy("_bucket")
    buckets = buckets.withColumn("_rows", F.coalesce(F.sum("_a").over(before(over)), none))
    buckets = buckets.withColumn("_high", F.max(F.col("_b") - F.col("_rows")).over(before(over)))
    begins = counted.join(buckets.select("_worker", "_bucket", "_rows", "_high"), ["_worker", "_bucket"]).select(
        *block, (F.col("_c") + F.col("_rows") + F.greatest(F.col("_m") - F.col("_rows"), "_high")).alias("_begin"))
    nth = F.row_number().over(Window.partitionBy(*block).orderBy(order)) - 1
    slot = F.col("_begin") + F.col("_nth")
    return (rows.withColumn("_nth", nth).join(begins, block)
            .withColumn(name, encode_id(F.shiftright(slot, SEQUENCE_BITS), F.col("_worker"), slot.bitwiseAND(_mask(SEQUENCE_BITS))))
            .drop(*block, "_nth", "_begin"))
