"""Text and JSON lines to typed columns. The same functions serve batch and streaming frames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_BROKEN, _TEXT = "_broken", "_text"


def csv_fields(line: str | Column, separator: str = ",") -> Column:
    """Split on a literal separator."""
    return F.split(line, re.escape(separator))


def _required(fields: Column, index: int) -> Column:
    """Field by position; a line that is too short is an error, as is a later failing cast."""
    return F.element_at(fields, index + 1)


def parse_clicks(lines: DataFrame, line: str = "value", behavior: str = "pv", unit: str = "second") -> DataFrame:
    """Click lines of one behaviour to (click_key, ts). Malformed lines fail the query.

    `unit` says what the trailing number counts: seconds or milliseconds since the epoch.
    """
    if unit not in ("second", "millisecond"):
        raise ValueError("unit must be 'second' or 'millisecond'")
    fields = csv_fields(line)
    stamp = _required(fields, 4).cast("bigint")
    return (
        lines.filter(F.lit(behavior).eqNullSafe(_required(fields, 3)))
        .select(
            F.concat_ws("-", _required(fields, 0), _required(fields, 1)).alias("click_key"),
            (F.timestamp_seconds(stamp) if unit == "second" else F.timestamp_millis(stamp)).alias("ts"),
        )
    )


def parse_temperatures(lines: DataFrame, line: str = "value") -> DataFrame:
    """Temperature lines to (province, city, temp, ts). Malformed lines fail the query."""
    fields = csv_fields(line)
    return lines.select(
        _required(fields, 0).alias("province"),
        _required(fields, 1).alias("city"),
        _required(fields, 3).cast("double").alias("temp"),
        F.to_timestamp(_required(fields, 4), "yyyy-MM-dd HH:mm:ss").alias("ts"),
    )


def parse_pairs(lines: DataFrame, line: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Whitespace separated `key seconds` lines to (k, v, ts); other lines are dropped.

    Trailing white space does not count as a field, leading white space makes an empty first one.
    """
    fields = F.split(F.regexp_replace(line, r"\s+\z", ""), r"\s+")
    # A bare cast would also take decimals; the format allows digits only.
    whole = F.when(F.col("_f")[1].rlike(r"^[+-]?\d+$"), F.col("_f")[1].try_cast("int"))
    return (
        lines.select(*keep, fields.alias("_f"))
        .filter(F.size("_f") == 2)
        .select(*keep, F.col("_f")[0].alias("k"), whole.alias("v"))
        .filter(F.col("v").isNotNull())
        .withColumn("ts", F.timestamp_seconds(F.col("v")))
    )


def tokens(df: DataFrame, text: str, separator: str = ",", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token, with its position in the line.

    Trailing empty tokens are dropped. An empty line is one empty token; a line of separators only is none.
    """
    if len(separator) == 1:
        stripped = F.rtrim(F.col(text), F.lit(separator))
    else:
        stripped = F.regexp_replace(text, f"(?:{re.escape(separator)})+\\z", "")
    separators_only = (F.length(stripped) == 0) & (F.length(text) > 0)
    return (
        df.filter(F.col(text).isNotNull() & ~separators_only)
        .select(*keep, F.posexplode(F.split(stripped, re.escape(separator))).alias("pos", "word"))
    )


def parse_json(df: DataFrame, schema: T.StructType | str, value: str = "value",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON objects to columns: missing fields and fields of a wrong type become NULL; of a repeated name the last counts.

    A text that is no JSON, or whose root is not an object, is dropped. A text is parsed once; only one with damage
    is read again, to tell a wrong field from a broken text.
    """
    text = F.col(value).cast("string")
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    marked = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    parsed = F.from_json(text, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN, "allowSingleQuotes": "false"})
    # Behind an explode the parsed value is a column of its own, so the filter below does not parse again.
    rows = df.filter(text.rlike(r"^[ \t\r\n]*\{")).select(*keep, text.alias(_TEXT), F.explode_outer(F.array(parsed)).alias("_j"))
    whole = F.from_json(_TEXT, "map<string,string>", {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}).isNotNull()
    sound = F.when(F.col(f"_j.{_BROKEN}").isNull(), F.lit(True)).otherwise(whole)
    return rows.filter(sound).select(*keep, *[F.col("_j").getField(n).alias(n) for n in schema.names])
