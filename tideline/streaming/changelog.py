"""Changelogs of an un-windowed group aggregate on a stream, with retractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.times import type_of
from tideline.operators.changelog import DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE
from tideline.streaming.dedup import _EXACT

_BIG = 1 << 63
# Groups that the keys are dealt to, whose totals are read and written at once, and keys that stand in one entry of the state.
GROUPS = 1024
PIECE = 1_000
# Rows of a group that travel as one, and rows and bytes from which on a task packs what it holds.
PACK = 256
HELD = 1 << 18
HELD_BYTES = 1 << 26
_COLUMNS = ["key", "seq", "sign", "present", "value"]
_NO_KEY = -1  # the group of the rows whose key is NULL, where keys travel as whole numbers


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one group together, in lists of up to PACK: a stateful task takes rows up one by one, which costs more than the work on them."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        group = table["group"].to_numpy()
        order = np.argsort(group, kind="stable")
        group, place = group[order], np.arange(len(order))
        opens = np.append(True, group[1:] != group[:-1])
        starts = np.flatnonzero((place - np.maximum.accumulate(np.where(opens, place, 0))) % PACK == 0)
        ends = pa.array(np.append(starts, len(order)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, table[c].take(pa.array(order)).combine_chunks()) for c in _COLUMNS]
        return pa.RecordBatch.from_arrays([pa.array(group[starts]), *lists], ["group", *_COLUMNS])

    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= HELD or size >= HELD_BYTES:
            yield packed(held)
            held, rows, size = [], 0, 0
    if rows:
        yield packed(held)


class _Retract(StatefulProcessor):
    """State per group of keys, in pieces: per key, number of rows, number of rows with a value, and the total that was last sent."""

    def __init__(self, agg: str, kind: str, key: str = "string"):
        self._agg, self._whole, self._numbered = agg, kind == "bigint", key == "bigint"
        self._state = f"keys array<{key}>, rows array<long>, known array<long>, totals array<{'long' if self._whole else 'double'}>"
        self._zero = 0 if self._whole else 0.0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._totals = handle.getListState("totals", self._state)

    def _added(self, known: int, total, value, sign: int):
        if self._agg == "sum":
            total = total + value if sign > 0 else total - value
        elif self._agg == "count":
            total += sign
        elif known == 0:
            total = value
        else:
            total = max(total, value) if self._agg == "max" else min(total, value)
        if self._whole and not -_BIG <= total < _BIG:
            raise OverflowError("a total needs more than 64 bits")
        return total

    def _at_once(self, kept: list[list], batch: pd.DataFrame) -> tuple[list[list], pd.DataFrame] | None:
        """The new totals and the changes of whole sums and counts by running sums, as `_row_by_row` gives them.

        None where that is not certain: a row takes back what is not there, a key without rows has a total left, or 64 bits may not do.
        """
        if not self._whole or self._agg not in ("sum", "count"):
            return None
        old, rows, known, totals = kept
        sign, present = batch["sign"].to_numpy("int64"), batch["present"].to_numpy("bool")
        value = np.where(present, 1 if self._agg == "count" else batch["value"].to_numpy("int64"), 0)
        if np.abs(value.astype("float64")).sum() + np.abs(np.array(totals, "float64")).max(initial=0) >= _BIG / 4:
            return None
        kind = "int64" if self._numbered else "object"
        codes, names = pd.factorize(np.concatenate([np.array(old, kind), batch["key"].to_numpy(kind)]))
        codes = codes[len(old):]
        place = np.argsort(codes, kind="stable")  # by key, then in arrival order; arrivals are by `seq` already
        codes = codes[place]
        opens = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        lasts = np.append(opens[1:], len(codes)) - 1
        run = np.repeat(np.arange(len(opens)), lasts - opens + 1)

        def running(steps, begun):
            """What each key had before and after each of its rows, and what all keys have at last."""
            begun = np.append(np.array(begun, "int64"), np.zeros(len(names) - len(old), "int64"))
            total = np.cumsum(steps)
            after = total + (begun[codes[opens]] - total[opens] + steps[opens])[run]
            begun[codes[opens]] = after[lasts]
            return after - steps, after, begun

        sign, present, value = sign[place], present[place], value[place]
        n_old, n, rows = running(sign, rows)
        known_old, known_new, known = running(np.where(present, sign, 0), known)
        before, after, totals = running(sign * value, totals)
        gone = n == 0
        if (n < 0).any() or (gone & ((known_new != 0) | (after != 0))).any():
            return None
        had, has = (known_old != 0) | (self._agg == "count"), (known_new != 0) | (self._agg == "count")
        first = (n_old == 0) & ~gone
        changed = ~first & ~gone & ((had != has) | (had & has & (before != after)))
        old_rows, new_rows = np.flatnonzero(gone | changed), np.flatnonzero(first | changed)
        order = np.argsort(np.concatenate([2 * place[old_rows], 2 * place[new_rows] + 1]), kind="stable")
        both = lambda a, b: np.concatenate([a[old_rows], b[new_rows]])[order]
        kinds = both(np.where(gone, 0, 1), np.where(first, 2, 3))
        seqs, keys = batch["seq"].to_numpy("int64")[place], names[codes]
        out = pd.DataFrame({"key": both(keys, keys), "change_seq": both(2 * seqs, 2 * seqs + 1),
                            "row_kind": np.array([DELETE, UPDATE_BEFORE, INSERT, UPDATE_AFTER], "object")[kinds],
                            "result": pd.arrays.IntegerArray(both(before, after), ~both(had, has))})
        stays = rows > 0
        return [names[stays].tolist(), rows[stays].tolist(), known[stays].tolist(), totals[stays].tolist()], out

    def _row_by_row(self, kept: list[list], batch: pd.DataFrame) -> tuple[list[list], pd.DataFrame]:
        totals = {k: numbers for k, *numbers in zip(*kept)}
        out = []
        columns = (batch[c].tolist() for c in _COLUMNS)
        for k, seq, sign, present, value in zip(*columns):
            n, known, total = totals.get(k) or (0, 0, self._zero)
            if n == 0 and sign < 0:
                continue  # nothing of this key is there to take back
            before = total if known or self._agg == "count" else None
            first = n == 0
            n += sign
            if present:
                total = self._added(known, total, value if not self._whole else int(value), sign)
                known += sign
            after = total if known or self._agg == "count" else None
            if n == 0:
                out.append((k, 2 * seq, DELETE, before))
                del totals[k]
                continue
            if first:
                out.append((k, 2 * seq + 1, INSERT, after))
            elif before != after:
                out += [(k, 2 * seq, UPDATE_BEFORE, before), (k, 2 * seq + 1, UPDATE_AFTER, after)]
            totals[k] = (n, known, total)
        keys, seqs, kinds, results = zip(*out) if out else ([], [], [], [])
        changes = pd.DataFrame({"key": keys, "change_seq": seqs, "row_kind": kinds,
                                "result": pd.array(results, "Int64" if self._whole else "Float64")})
        return [list(column) for column in zip(*((k, *numbers) for k, numbers in totals.items()))] or [[], [], [], []], changes

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("seq", kind="stable")
        kept = [[], [], [], []]
        for piece in self._totals.get():
            for column, more in zip(kept, piece):
                column.extend(more)
        kept, out = self._at_once(kept, batch) or self._row_by_row(kept, batch)
        self._totals.clear()
        for i in range(0, len(kept[0]), PIECE):
            self._totals.appendValue(tuple(column[i:i + PIECE] for column in kept))
        if len(out):
            yield out

    def close(self) -> None:
        pass


class _RetractPacked(_Retract):
    """The same for rows that come in lists."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        lists = pd.concat(list(rows))
        batch = pd.DataFrame({c: np.concatenate(lists[c].tolist()) for c in _COLUMNS})
        for out in super().handleInputRows(key, iter([batch]), timerValues):
            yield out.assign(key=pd.array([None] * len(out), "Int64")) if self._numbered and key[0] == _NO_KEY else out


def changelog_stream(df: DataFrame, key: str, seq: str, value: str, agg: str = "sum", sign: str | None = None,
                     groups: int = GROUPS) -> DataFrame:
    """The rows of `operators.changelog.agg_changelog` on a stream: (key, change_seq, row_kind, result). RocksDB state store.

    Each micro-batch emits, in arrival order, what its rows change: +I for a key's first row, -U and +U for one that changes the
    result. However the arrivals are cut into micro-batches, the changes are the same, if `seq` does not go back from one
    batch to the next. The state is one number per key. Keys are dealt by hash to `groups` groups, a number that a checkpoint keeps for good.

    sign: a column of 1 and -1; a row of -1 takes back one that was added (sum and count only). When a key's last row is taken
    back it is gone (-D); a row that takes back what is not there is left out. value: whole numbers, or DOUBLE. The rows of one
    group in one micro-batch are held together, as numbers, with the totals of its keys.
    """
    if agg not in ("sum", "count", "max", "min"):
        raise ValueError(f"no changelog for {agg}")
    if sign is not None and agg in ("max", "min"):
        raise ValueError(f"{agg} can't take a row back")
    kind = "bigint" if agg == "count" or isinstance(type_of(df, value), T.IntegralType) else "double"
    given = F.col(value) if agg != "count" else F.when(F.col(value).isNotNull(), 1)
    # The key travels as text if it is no whole number, and NULLs as zeros with a mark: pandas would turn whole numbers next to NULLs into
    # floating point. The mark of a NULL key is its group.
    numbered = isinstance(type_of(df, key), T.IntegralType)
    sent = F.coalesce(F.col(key).cast("bigint"), F.lit(0)) if numbered else F.to_json(F.struct(F.col(key).alias("k")), _EXACT)
    group = F.pmod(F.xxhash64(sent), F.lit(groups)).cast("int")
    staged = df.select(
        (F.when(F.col(key).isNull(), _NO_KEY).otherwise(group) if numbered else group).alias("group"),
        sent.alias("key"), F.col(seq).cast("bigint").alias("seq"),
        (F.lit(1) if sign is None else F.col(sign).cast("int")).alias("sign"), F.col(value).isNotNull().alias("present"),
        F.coalesce(given.cast(kind), F.lit(0).cast(kind)).alias("value"))
    key_kind = "bigint" if numbered else "string"
    packed = staged.mapInArrow(_pack, f"group int, key array<{key_kind}>, seq array<bigint>, sign array<int>, present array<boolean>, value array<{kind}>")
    changed = packed.groupBy("group").transformWithStateInPandas(
        statefulProcessor=_RetractPacked(agg, kind, key_kind),
        outputStructType=f"key {key_kind}, change_seq bigint, row_kind string, result {kind}",
        outputMode="Append", timeMode="None")
    shape = T.StructType([T.StructField("k", type_of(df, key))])
    given_back = F.col("key").cast(type_of(df, key)) if numbered else F.from_json("key", shape, _EXACT).getField("k")
    result = F.col("result") if agg in ("sum", "count") else F.col("result").cast(type_of(df, value))
    return changed.select(given_back.alias(key), "change_seq", "row_kind", result.alias("result"))
