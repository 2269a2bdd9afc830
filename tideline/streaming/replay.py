"""A table replayed as a stream, to the end."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tideline.operators.stored import shared_folder
from tideline.session import ROCKSDB

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # A figure of Spark's progress reports only, for which the store would look up every key that it writes or removes.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
_PARTITIONS = "spark.sql.shuffle.partitions"


def replay_into(table: DataFrame, part: str, parts: int, sink: Callable[[DataFrame, str], DataStreamWriter], per_core: int | None = None) -> str:
    """Run a stream over a table that arrives in parts: the rows with `part` 0, then those with 1, and so on.

    Each part is added to a folder of files, and the stream that `sink(rows, folder)` sets up (with a checkpoint in the folder, for
    what is there now) is run to the end. So it goes on from its checkpoint every time. Returns the folder, a new one in the shared folder.

    per_core: keep the state in at most this many partitions for each core, if the session has more: each opens and commits a store
    once a part, which for a small state takes longer than its rows. All rows of a partition are read by one task then.
    """
    spark = table.sparkSession
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    columns = [c for c in table.columns if c != part]
    settings = dict(_STATE)
    if per_core:
        most = per_core * spark.sparkContext.defaultParallelism
        settings[_PARTITIONS] = str(min(int(spark.conf.get(_PARTITIONS)), most))
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for n in range(parts):
            table.filter(F.col(part) == n).select(*columns).write.mode("append").parquet(f"{folder}/in")
            source = spark.readStream.schema(table.select(*columns).schema).parquet(f"{folder}/in")
            sink(source, folder).start().awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return folder


def replay(table: DataFrame, part: str, parts: int, build: Callable[[DataFrame], DataFrame], per_core: int | None = None) -> DataFrame:
    """The rows that an append-mode stream gives for a table that arrives in parts; per_core as in `replay_into`."""

    def sink(rows: DataFrame, folder: str) -> DataStreamWriter:
        writer = build(rows).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
        return writer.trigger(availableNow=True)

    return table.sparkSession.read.parquet(f"{replay_into(table, part, parts, sink, per_core)}/out")
