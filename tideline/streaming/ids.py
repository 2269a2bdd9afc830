"""Ids handed out on a stream: the next free slot of every worker is state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.operators.ids import PER_MS, SEQUENCE_BITS, encode_id
from tideline.streaming.dedup import _EXACT


class _NextSlot(StatefulProcessor):
    """State per worker: the first slot that is free. Slots of 4,096 to a millisecond."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._free = handle.getValueState("free", "slot long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        free = self._free.get()[0] if self._free.exists() else 0
        batch = pd.concat(list(rows)).sort_values(["ms", "place"])
        # A row takes max(one after the last, its millisecond's first slot): a running maximum of what it is ahead of its number.
        ahead = (batch["ms"] * PER_MS).clip(lower=free).to_numpy() - range(len(batch))
        slots = pd.Series(ahead).cummax().to_numpy() + range(len(batch))
        self._free.update((int(slots[-1]) + 1,))
        yield pd.DataFrame({"worker": int(key[0]), "slot": slots, "record": batch["record"].to_numpy()})

    def close(self) -> None:
        pass


def assign_ids_stream(df: DataFrame, ts: str, worker: Column, order: str, name: str = "id") -> DataFrame:
    """`operators.ids.assign_ids` on a stream: the columns of df and an id that no row of the stream has had. RocksDB state store.

    Rows of one micro-batch are numbered in the order of (milliseconds, `order`), after all rows of the batches before. A
    row earlier than those takes the next free slot, as from a generator whose clock does not go back. A restarted stream goes on
    where it stopped. One worker's rows of one micro-batch are held together; there are 1,024 workers.
    """
    ms = F.unix_millis(F.col(ts).cast("timestamp"))
    staged = df.select(worker.cast("bigint").alias("worker"), ms.alias("ms"), F.col(order).cast("bigint").alias("place"),
                       F.to_json(F.struct(*df.columns), _EXACT).alias("record"))
    given = staged.groupBy("worker").transformWithStateInPandas(
        statefulProcessor=_NextSlot(), outputStructType="worker bigint, slot bigint, record string", outputMode="Append", timeMode="None")
    slot = F.col("slot")
    found = encode_id(F.shiftright(slot, SEQUENCE_BITS), F.col("worker"), slot.bitwiseAND(F.lit(PER_MS - 1)))
    return given.select(F.from_json("record", df.schema, _EXACT).alias("record"), found.alias("_id")).select("record.*", F.col("_id").alias(name))
