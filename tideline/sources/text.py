"""Text lines: files and sockets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row `value` per line of the file(s)."""
    return spark.read.text(path)


def csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma separated file with a declared schema; a malformed line fails the query."""
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path)


def text_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Lines of the files in a folder, a few files per micro-batch, oldest file first."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket server. Spark's socket source cannot be replayed after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def write_lines(df: DataFrame, path: str, columns: list[str] | None = None, separator: str = ",") -> None:
    """Rows as text lines; NULL prints as "null"."""
    as_lines(df, columns, separator).write.mode("overwrite").text(path)


def as_lines(df: DataFrame, columns: list[str] | None = None, separator: str = ",") -> DataFrame:
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns or df.columns]
    return df.select(F.concat_ws(separator, *fields).alias("value"))
