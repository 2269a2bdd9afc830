"""JSON records from a message log, with its metadata columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tideline.functions.parse import parse_json

METADATA = ("partition", "offset", "timestamp")


def kafka_stream(spark: SparkSession, servers: str, topic: str, start: str = "earliest",
                 group: str | None = None) -> DataFrame:
    """Raw records of a topic. Needs Spark's Kafka package on the class path."""
    if start not in ("earliest", "latest"):
        raise ValueError("start must be 'earliest' or 'latest'")
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load()


def parse_records(records: DataFrame, schema: T.StructType | str, metadata: tuple[str, ...] = METADATA) -> DataFrame:
    """JSON bodies to columns, next to the metadata: lenient on fields, malformed bodies are skipped."""
    return parse_json(records, schema, "value", keep=metadata)
