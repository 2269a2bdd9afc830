"""Aggregation changelogs: what an un-windowed group aggregate emits, and how to read it back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.running import SEQ_BITS, running, seq_bucket

# The row kinds.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def agg_changelog(df: DataFrame, key: str, seq: str, value: str, agg: str = "sum",
                  bucket_bits: int = SEQ_BITS) -> DataFrame:
    """Changelog of `agg(value)` per key in arrival order: (key, change_seq, row_kind, result).

    A key's first row inserts; each later one that changes the result retracts the old and adds the new.
    `change_seq` orders the changes (retraction before addition).
    """
    if agg not in ("sum", "count", "max", "min"):
        raise ValueError(f"no changelog for {agg}")
    scanned = running(
        df.select(key, seq, value), [key], [seq],
        {"_rows": ("count", F.lit(1)), "_res": (agg, value)}, seq_bucket(seq, bucket_bits),
    )
    is_first = F.col("_rows") == 1
    changed = ~F.col("_res").eqNullSafe(F.col("_res_before"))
    entry = lambda kind, result, step: F.struct(
        (F.col(seq) * 2 + step).alias("change_seq"), F.lit(kind).alias("row_kind"), F.col(result).alias("result")
    )
    return (
        scanned.filter(is_first | changed)
        .withColumn("_changes", F.when(is_first, F.array(entry(INSERT, "_res", 1))).otherwise(
            F.array(entry(UPDATE_BEFORE, "_res_before", 0), entry(UPDATE_AFTER, "_res", 1))))
        .select(key, F.inline("_changes"))
    )


def apply_changelog(df: DataFrame, key: str | Sequence[str], seq: str, kind: str) -> DataFrame:
    """Current table of a changelog: the last change of each key, unless it took the row away.

    row_number() = 1 lets Spark keep one row per key and task before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    last = Window.partitionBy(*keys).orderBy(F.desc(seq))
    return (
        df.withColumn("_rn", F.row_number().over(last))
        .filter(F.col("_rn") == 1)
        .filter(F.col(kind).isin(INSERT, UPDATE_AFTER))
        .drop("_rn", kind, seq)
    )
