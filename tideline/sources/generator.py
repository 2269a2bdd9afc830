"""Random-row tables, bounded or as a stream, from one column description."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Field = Callable[[int], Column]


def uniform_long(low: int, high: int) -> Field:
    """Whole number from low to high, both included."""
    return lambda seed: (F.lit(low) + F.floor(F.rand(seed) * (high - low + 1))).cast("bigint")


def uniform_int(low: int, high: int) -> Field:
    return lambda seed: uniform_long(low, high)(seed).cast("int")


def uniform_double(low: float, high: float) -> Field:
    return lambda seed: F.lit(float(low)) + F.rand(seed) * (high - low)


def random_hex(length: int) -> Field:
    """Hexadecimal text of fixed length."""
    words = -(-length // 8)

    def column(seed: int) -> Column:
        parts = [F.lpad(F.hex(F.floor(F.rand(seed + 7919 * i) * (1 << 32))), 8, "0") for i in range(words)]
        return F.lower(F.substring(F.concat(*parts), 1, length))

    return column


def choice(*values) -> Field:
    return lambda seed: F.element_at(
        F.array(*[F.lit(v) for v in values]), (F.floor(F.rand(seed) * len(values)) + 1).cast("int")
    )


def sequence() -> Field:
    """The row's own number, from 0."""
    return lambda seed: F.col("_row")


def _field(kind: T.DataType, path: str, options: dict[str, str]) -> Field:
    """Generator of a declared field; `fields.<path>.*` options narrow it."""
    low, high = options.get(f"fields.{path}.min"), options.get(f"fields.{path}.max")
    if options.get(f"fields.{path}.kind", "random") == "sequence":
        first = int(options.get(f"fields.{path}.start", 0))
        return lambda seed: (F.col("_row") + first).cast(kind)
    if isinstance(kind, T.StructType):
        parts = {f.name: _field(f.dataType, f"{path}.{f.name}", options) for f in kind}
        return lambda seed: F.struct(*[make(seed + 31 * i).alias(name) for i, (name, make) in enumerate(parts.items(), 1)])
    if isinstance(kind, T.StringType):
        return random_hex(int(options.get(f"fields.{path}.length", 100)))
    if isinstance(kind, T.BooleanType):
        return choice(True, False)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return lambda seed: F.current_timestamp().cast(kind)
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        make = uniform_double(float(low or 0), float(high or 1_000_000))
    elif isinstance(kind, T.IntegralType):
        top = {T.ByteType: (1 << 7) - 1, T.ShortType: (1 << 15) - 1}.get(type(kind), (1 << 31) - 1)
        make = uniform_long(int(low or 0), int(high or top))
    else:
        raise ValueError(f"no generator for {kind.simpleString()}")
    return lambda seed: make(seed).cast(kind)


def random_table(spark: SparkSession, schema: T.StructType, options: dict[str, str] | None = None, *,
                 stream: bool = False, seed: int = 0) -> DataFrame:
    """A declared table of random rows, with the options of a table declaration.

    rows-per-second and number-of-rows for the table; kind (random or sequence), min, max, start, length for
    `fields.<name>`, with dots into nested fields. Numbers without bounds are not negative; times are the current time.
    """
    options = options or {}
    fields = {f.name: _field(f.dataType, f.name, options) for f in schema}
    rows = options.get("number-of-rows")
    if stream:
        rate = int(options.get("rows-per-second", 10_000))
        return generate_stream(spark, fields, rate, int(rows) if rows else None, seed)
    if rows is None:
        raise ValueError("a bounded table needs number-of-rows")
    return generate(spark, fields, int(rows), seed)


def _columns(fields: dict[str, Field], seed: int) -> list[Column]:
    return [make(seed + 104_729 * i).alias(name) for i, (name, make) in enumerate(fields.items())]


def generate(spark: SparkSession, fields: dict[str, Field], rows: int, seed: int = 0,
             partitions: int | None = None) -> DataFrame:
    """A bounded table of `rows` rows, made where it is used."""
    base = spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)
    return base.withColumnRenamed("id", "_row").select(*_columns(fields, seed))


def generate_stream(spark: SparkSession, fields: dict[str, Field], rows_per_second: int,
                    rows: int | None = None, seed: int = 0, time_column: str | None = None) -> DataFrame:
    """An endless or bounded stream of random rows. `time_column` names the generation time, if wanted."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    base = reader.load().withColumnRenamed("value", "_row")
    if rows is not None:
        base = base.filter(F.col("_row") < rows)
    columns = _columns(fields, seed)
    if time_column:
        columns.append(F.col("timestamp").alias(time_column))
    return base.select(*columns)
