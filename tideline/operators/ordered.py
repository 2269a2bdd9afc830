"""Pairwise reduction that depends on arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.running import seq_bucket

_JOINT = "_"
PART_BITS = 12


def ordered_parts(df: DataFrame, key: str, seq: str, value: str, window: Sequence[str] = (),
                  part_bits: int = PART_BITS) -> DataFrame:
    """Arrival-ordered pieces of each group: (part, values joined, first value, sum, count). Rows with a NULL value take no part.

    A piece covers 2**part_bits arrival numbers, so its size is bounded however large the group is. For
    groups whose label would not fit into one value, these rows, read in order of `part`, are the result.
    """
    return df.filter(F.col(value).isNotNull()).groupBy(key, *window, seq_bucket(seq, part_bits).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(value).cast("string").alias("v")))).alias("_rows"),
        F.sum(value).alias("total"),
        F.count("*").alias("rows"),
    ).select(
        key, *window, "part",
        F.array_join(F.transform("_rows", lambda r: r["v"]), _JOINT).alias("piece"),
        F.col("_rows")[0]["v"].alias("first_value"),
        "total", "rows",
    )


def ordered_reduce(df: DataFrame, key: str, seq: str, value: str, window: Sequence[str] = (),
                   part_bits: int = PART_BITS) -> DataFrame:
    """Fold (label, number) pairs in arrival order: numbers add up, later ones are appended to the label.

    The label starts as the key; the first number is not appended: a:1, a:4 gives (a_4, 5).
    Rows with a NULL value are no arrivals: they are neither counted as the first number nor appended, and a group of them
    alone has no result.
    """
    parts = ordered_parts(df, key, seq, value, window, part_bits)
    joined = F.array_join(F.transform("_parts", lambda p: p["piece"]), _JOINT)
    first = F.col("_parts")[0]["first_value"]
    return (
        parts.groupBy(key, *window)
        .agg(
            F.array_sort(F.collect_list(F.struct("part", "piece", "first_value"))).alias("_parts"),
            F.sum("total").alias("total"),
        )
        .select(
            key, *window,
            F.concat(F.col(key).cast("string"), F.substr(joined, F.length(first) + 1)).alias("label"),
            "total",
        )
    )
