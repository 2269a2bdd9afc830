"""User functions as column expressions. All of them stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The results of the user function and the type of its record.
LOW_NAME, LOW_BALANCE = "name1", "1.10"
HIGH_NAME, HIGH_BALANCE = "name2", "2.20"
LOW_RANGE = (1, 5)
BALANCE_TYPE = "decimal(10,2)"
USER_TYPE = "struct<age:int,name:string,totalBalance:decimal(10,2)>"
HASH_FACTOR = 12


def wrap_int(value: Column) -> Column:
    """Two's-complement wrap of any BIGINT into INT; never an ANSI overflow error."""
    low = F.pmod(value, F.lit(1 << 32))
    return F.when(low < F.lit(1 << 31), low).otherwise(low - F.lit(1 << 32)).cast("int")


def java_hash(text: str | Column, factor: int = HASH_FACTOR) -> Column:
    """The JVM's 32-bit string hash times `factor`, wrapping at 32 bits; NULL stays NULL.

    The hash itself is one call per row into the JVM, linear in the text.
    """
    text = F.col(text) if isinstance(text, str) else text
    raw = F.java_method(F.lit("java.util.Objects"), F.lit("hashCode"), text).cast("bigint")
    return F.when(text.isNotNull(), wrap_int(raw * F.lit(factor).cast("bigint")))


def _is_low(number: Column) -> Column:
    return number.between(*LOW_RANGE)


def user_record(number: str | Column) -> Column:
    """BIGINT to the user record: one name and balance for 1..5, another for all else."""
    number = (F.col(number) if isinstance(number, str) else number).cast("bigint")
    low = F.coalesce(_is_low(number), F.lit(False))
    record = F.struct(
        wrap_int(number).alias("age"),
        F.when(low, LOW_NAME).otherwise(HIGH_NAME).alias("name"),
        F.when(low, F.lit(LOW_BALANCE).cast(BALANCE_TYPE))
        .otherwise(F.lit(HIGH_BALANCE).cast(BALANCE_TYPE))
        .alias("totalBalance"),
    )
    return F.when(number.isNotNull(), record)


def user_name(record: str | Column) -> Column:
    """User record to its name, by age range."""
    record = F.col(record) if isinstance(record, str) else record
    age = record.getField("age")
    return F.when(record.isNotNull(), F.when(_is_low(age), LOW_NAME).otherwise(HIGH_NAME))


def user_func(df: DataFrame, argument: str) -> Column:
    """The overloaded user function: picks the form from the type of the argument column."""
    if isinstance(df.select(argument).schema[0].dataType, T.StructType):
        return user_name(argument)
    return user_record(argument)
