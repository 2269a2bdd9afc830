"""Grouped aggregates. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.parse import tokens
from tideline.operators.running import running
from tideline.operators.windows import BOUNDS, tumble


def group_count(df: DataFrame, key: str | Sequence[str], column: str, name: str = "count1") -> DataFrame:
    """Non-null count per key; on a stream, run it in update mode."""
    return df.groupBy(*([key] if isinstance(key, str) else key)).agg(F.count(column).alias(name))


def hourly_report(df: DataFrame, key: str, ts: str, amount: str, unit: str = "HOUR") -> DataFrame:
    """Sum per key and calendar unit."""
    floored = F.date_trunc(unit, ts).cast(df.schema[ts].dataType)
    return df.groupBy(key, floored.alias("log_ts")).agg(F.sum(amount).alias("amount"))


def tumble_count(df: DataFrame, key: str, ts: str, column: str, size: str) -> DataFrame:
    """Non-null count per key and tumbling window, with the window end."""
    return (
        tumble(df, ts, size)
        .groupBy(key, "window_start", "window_end")
        .agg(F.count(column).alias("count1"))
        .drop("window_start")
    )


def window_stats(df: DataFrame, keys: Sequence[str], ts: str, value: str, size: str) -> DataFrame:
    """max, min, sum, avg and count per key and tumbling window, with the window bounds."""
    return (
        tumble(df, ts, size)
        .groupBy(*keys, *BOUNDS)
        .agg(
            F.max(value).alias("max"),
            F.min(value).alias("min"),
            F.sum(value).alias("sum"),
            F.avg(value).alias("avg"),
            F.count(value).alias("counts"),
        )
    )


def word_count(df: DataFrame, text: str, separator: str = ",") -> DataFrame:
    """Final total per token."""
    return tokens(df, text, separator).groupBy("word").agg(F.count("*").alias("total"))


def running_word_count(df: DataFrame, line_no: str, text: str, separator: str = ",",
                       bucket_bits: int = 8) -> DataFrame:
    """The total of a token after each of its occurrences, in line order.

    Hot tokens are spread: a task holds one token's rows of 2**bucket_bits lines, not all of them. Tokens may be long, so they
    are told apart by 128 bits of their SHA-256, and each travels as text once.
    """
    words = tokens(df, text, separator, keep=(line_no,)).withColumn("_token", F.unhex(F.substring(F.sha2("word", 256), 1, 32)))
    counted = running(
        words, ["_token"], [line_no, "pos"], {"total": ("count", F.lit(1))},
        F.shiftright(F.col(line_no), bucket_bits),
    )
    return counted.select(line_no, "pos", "word", "total")
