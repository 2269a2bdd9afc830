"""Durations and epoch conversions shared by the operators."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_TERM = re.compile(r"\s*([+-]?\d+)\s+([a-z]+?)s?(?=\s|$)")

MILLISECOND = timedelta(milliseconds=1)


def duration_us(text: str) -> int:
    """Microseconds in a duration such as `"10 seconds"`, `"-8 hours"` or `"1 day 2 hours"`."""
    pos, total = 0, 0
    text = text.strip().lower()
    while pos < len(text):
        term = _TERM.match(text, pos)
        if not term or term.group(2) not in _UNIT_US:
            raise ValueError(f"not a fixed duration: {text!r}")
        total += int(term.group(1)) * _UNIT_US[term.group(2)]
        pos = term.end()
    return total


def span(text: str) -> Column:
    """A duration as an interval literal."""
    return F.lit(timedelta(microseconds=duration_us(text)))


def micros(ts: str | Column) -> Column:
    """Epoch microseconds of a TIMESTAMP or TIMESTAMP_NTZ (session zone UTC)."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def from_micros(us: Column, like: T.DataType) -> Column:
    """Epoch microseconds back to the timestamp type `like`."""
    return F.timestamp_micros(us).cast(like)


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def epoch_ms(text: str | Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """String to epoch milliseconds; a string that does not match the pattern is an error."""
    return F.unix_millis(F.to_timestamp(text, pattern))


def from_epoch_ms(ms: str | Column, zone: str = "UTC") -> Column:
    """Epoch milliseconds to the wall-clock date-time of a zone."""
    instant = F.timestamp_millis(ms)
    return F.from_utc_timestamp(instant, zone).cast("timestamp_ntz")


def clock(ts: str | Column, pattern: str = "HH:mm:ss") -> Column:
    """Time-of-day text of a window bound."""
    return F.date_format(ts, pattern)
