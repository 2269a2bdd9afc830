"""Declared tables: a fixed schema with computed columns, event time and key."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """What a table declaration states. `apply` turns a raw frame into the declared table."""

    name: str
    schema: T.StructType
    computed: dict[str, Column] = field(default_factory=dict)
    event_time: str | None = None
    delay: str = "0 seconds"
    key: tuple[str, ...] = ()

    def apply(self, raw: DataFrame, view: bool = True) -> DataFrame:
        table = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in self.schema])
        if self.computed:
            table = table.withColumns(self.computed)
        if self.event_time and table.isStreaming:
            # Spark takes event time only as TIMESTAMP, so a declared TIMESTAMP_NTZ becomes one on a stream.
            table = table.withColumn(self.event_time, F.col(self.event_time).cast("timestamp")).withWatermark(
                self.event_time, self.delay
            )
        if view:
            table.createOrReplaceTempView(self.name)
        return table


def processing_time() -> Column:
    """Arrival time of a row: fixed per query, or per micro-batch on a stream."""
    return F.current_timestamp()


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A few literal rows."""
    return spark.createDataFrame(rows, schema)


def insert_into(rows: DataFrame, table: str, overwrite: bool = False) -> None:
    """Append a batch query to a catalog table by position; the number of columns must agree."""
    width = len(rows.sparkSession.table(table).columns)
    if len(rows.columns) != width:
        raise ValueError(f"{table} has {width} columns, the query {len(rows.columns)}")
    rows.write.insertInto(table, overwrite=overwrite)


# Declared schemas of the given tables; declaring them saves a schema job per read.
TESTDATA_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def testdata(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(TESTDATA_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
