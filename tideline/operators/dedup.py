"""Interval deduplication: per key, pass a row, then drop rows until `interval` after the passed row.

The chain "next passed = first stamp at or after last passed + interval" is sequential, so a key that holds a large share of the
table needs more than a sort per key. All work is done on distinct (key, stamp) pairs, sorted by key and stamp and cut into
chunks of about as many rows each, by range. A chunk is read as a sorted stream:

* where another key begins, or a stamp is at least `interval` after the one before it, a chain starts anew. From there on a chunk
  knows what passes, whatever comes before it;
* what comes ahead of that needs the chunk's entry, the earliest stamp that may pass, from the chunk before. If that one has such a place,
  it knows its exit by itself;
* chunks without such a place belong to one key that holds whole chunks. Each is summarised as a step function from entry to
  exit. The exits are the nodes of a list, each pointing to the exit of the chunk where it lands, and what is reached from
  the run's beginning is found by pointer doubling: as many rounds as the run's number of chunks has binary digits.

A task holds one chunk. The driver sees one row per chunk: its first and last key and stamp, and its exit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.times import duration_us, micros
from tideline.operators.stored import stored

_NEVER = int(np.iinfo(np.int64).min)
_CLOSED = int(np.iinfo(np.int64).max)


def dedup_interval(df: DataFrame, keys: Sequence[str], ts: str, interval: str, order: str, *, chunks: int | None = None) -> DataFrame:
    """Rows that pass, unchanged; columns of any type. `order` is a unique column that decides between equal stamps.

    NULL keys form a group of their own; rows with a NULL stamp never pass. chunks: how many there are; by default as many as Spark
    makes of the data's size.
    """
    keys = list(keys)
    step = duration_us(interval)
    if step <= 0:
        raise ValueError("interval must be positive")
    rows = df.filter(F.col(ts).isNotNull())
    named = {f"_k{i}": F.col(k) for i, k in enumerate(keys)}
    # The first arrival of each (key, stamp) stands for its equals: none of the others can pass.
    stamps = (rows.select(*[c.alias(n) for n, c in named.items()], micros(ts).alias("_us"), F.col(order).alias("_first"))
              .groupBy(*named, "_us").agg(F.min("_first").alias("_first")))
    by = [*named, "_us"]
    dealt = stamps.repartitionByRange(*by) if chunks is None else stamps.repartitionByRange(chunks, *by)
    # Kept as it lies, a partition is a chunk.
    kept = stored(dealt.sortWithinPartitions(*by).withColumn("_chunk", F.spark_partition_id()).select("_chunk", "_us", "_first", *named))
    entries = _entries(kept, list(named), step)
    passed = _pick(kept, list(named), step, entries).withColumnRenamed("_first", order)
    return rows.join(passed, order, "left_semi").select(*df.columns)


def _same(a, b) -> bool:
    return a == b or (isinstance(a, float) and isinstance(b, float) and a != a and b != b)


def _changes(columns: list[pa.Array], before: tuple | None) -> np.ndarray:
    """Where a row's key differs from the row's before; `before` is the key ahead of the first."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    for column in columns:
        later, earlier = column.slice(1), column.slice(0, n - 1)
        if pa.types.is_nested(column.type):
            values = column.to_pylist()
            out[1:] |= np.array([not _same(a, b) for a, b in zip(values[1:], values)], bool)
            continue
        same = pc.or_(pc.fill_null(pc.equal(later, earlier), False), pc.and_(pc.is_null(later), pc.is_null(earlier)))
        if pa.types.is_floating(column.type):
            same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(later), pc.is_nan(earlier)), False))
        out[1:] |= ~np.asarray(same, bool)
    if before is not None:
        out[0] = not all(_same(c[0].as_py(), b) for c, b in zip(columns, before))
    return out


class _Chunk:
    """The stamps of one chunk, and the places where a chain starts anew whatever came before."""

    def __init__(self, batches: Iterator[pa.RecordBatch], n_keys: int, step: int):
        stamps, firsts, anew, before = [], [], [], None
        self.number = None
        for batch in batches:
            if not batch.num_rows:
                continue
            us, key = batch.column(1).to_numpy(), batch.columns[3:3 + n_keys]
            changed = _changes(key, before)
            if self.number is None:
                self.number = batch.column(0)[0].as_py()
                self.head = batch.slice(0, 1).select(range(3, 3 + n_keys))
            before = tuple(c[-1].as_py() for c in key)
            self.tail = batch.slice(batch.num_rows - 1, 1).select(range(3, 3 + n_keys))
            stamps.append(us)
            firsts.append(batch.column(2))
            anew.append(changed)
        self.empty = self.number is None
        if self.empty:
            return
        self.us, self.firsts = np.concatenate(stamps), pa.chunked_array(firsts)
        changed = np.concatenate(anew)
        changed[1:] |= np.diff(self.us) >= step
        places = np.flatnonzero(changed)
        # Parts that are chains of their own; the first one needs an entry.
        self.bounds = [0, *places[places > 0].tolist(), len(self.us)]
        self.whole = len(self.bounds) == 2

    def passing(self, part: int, free: int, step: int) -> tuple[list[int], int]:
        """(places that pass in a part, earliest stamp that may pass after it)."""
        begin, end, found = self.bounds[part], self.bounds[part + 1], []
        us = self.us
        while (begin := begin + int(np.searchsorted(us[begin:end], free))) < end:
            found.append(begin)
            free = int(us[begin]) + step
        return found, free

    def function(self, step: int) -> tuple[np.ndarray, np.ndarray]:
        """(at, to) of a whole chunk: an entry e leads to `to` of the first at >= e; with none, it passes the chunk untouched.

        An entry comes from a stamp ahead of the chunk, so only stamps up to the first one past start + interval can begin a chain.
        """
        us, n = self.us, len(self.us)
        jump = np.searchsorted(us, us + step)
        jump = np.where(jump < n, jump, np.arange(n))
        while True:  # to the last stamp of every chain
            further = jump[jump]
            if np.array_equal(further, jump):
                break
            jump = further
        heads = min(n, int(np.searchsorted(us, us[0] + step)) + 1)
        at, to = us[:heads], us[jump[:heads]] + step
        keep = np.append(to[1:] != to[:-1], True)
        return at[keep], to[keep]


def _struct_of(row: pa.RecordBatch) -> pa.Array:
    return pa.StructArray.from_arrays(row.columns, names=row.schema.names)


def _entries(kept: DataFrame, keys: list[str], step: int) -> dict[int, int]:
    """The entry of every chunk: the earliest stamp of its first key that may pass there."""
    kind = T.StructType([kept.schema[k] for k in keys])
    longs = [T.StructField(n, T.LongType()) for n in ("chunk", "start", "end", "exit")]
    shape = T.StructType([*longs, T.StructField("whole", T.BooleanType()), T.StructField("first", kind), T.StructField("last", kind)])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(batches, len(keys), step)
        if chunk.empty:
            return
        _, free = chunk.passing(len(chunk.bounds) - 2, _NEVER, step)
        numbers = [pa.array([int(v)], pa.int64()) for v in (chunk.number, chunk.us[0], chunk.us[-1], free)]
        yield pa.RecordBatch.from_arrays([*numbers, pa.array([chunk.whole]), _struct_of(chunk.head), _struct_of(chunk.tail)],
                                         [f.name for f in shape])

    info = sorted(kept.mapInArrow(summarise, shape).collect(), key=lambda r: r.chunk)
    goes_on = [False] + [all(map(_same, a.last, b.first)) and b.start - a.end < step for a, b in zip(info, info[1:])]
    open_ = [on and r.whole for on, r in zip(goes_on, info)]
    entries, runs = {}, {}
    for i, r in enumerate(info):
        if not goes_on[i]:
            entries[r.chunk] = _NEVER
        elif not open_[i - 1]:
            entries[r.chunk] = info[i - 1].exit
        if open_[i]:
            if i and open_[i - 1]:
                runs[max(runs)].append(r)
            else:
                runs[r.chunk] = [r]
    if runs:
        found = _reached(kept, keys, step, runs, {run: entries[run] for run in runs})
        place = {r.chunk: i for i, r in enumerate(info)}
        for run, chunks in runs.items():
            after = place[chunks[-1].chunk] + 1
            for r in chunks:
                entries[r.chunk] = found.get((run, r.chunk), _CLOSED)
            if after < len(info) and goes_on[after]:
                entries[info[after].chunk] = found[run, -1]
    return entries


def _reached(kept: DataFrame, keys: list[str], step: int, runs: dict[int, list[Row]], roots: dict[int, int]) -> dict[tuple[int, int], int]:
    """{(run, chunk): entry} for the chunks where the chain lands, and (run, -1) for where it leaves the run."""
    spark = kept.sparkSession
    run_of = {r.chunk: run for run, chunks in runs.items() for r in chunks}
    ends = {run: np.array([r.end for r in chunks]) for run, chunks in runs.items()}
    numbers = {run: np.array([r.chunk for r in chunks] + [-1]) for run, chunks in runs.items()}

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(batches, len(keys), step)
        if not chunk.empty and chunk.number in run_of:
            at, to = chunk.function(step)
            same = lambda v: pa.array(np.full(len(at), v, np.int64))
            yield pa.RecordBatch.from_arrays([same(run_of[chunk.number]), same(chunk.number), pa.array(at), pa.array(to)], ["run", "chunk", "at", "to"])

    def land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            run, entry = (batch.column(i).to_numpy() for i in range(2))
            chunk = np.full(len(run), -1, np.int64)
            for r in np.unique(run).tolist():
                own = run == r
                chunk[own] = numbers[r][np.searchsorted(ends[r], entry[own])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk)], ["run", "e", "chunk"])

    steps = stored(kept.mapInArrow(functions, "run bigint, chunk bigint, at bigint, to bigint"))
    first = spark.createDataFrame(list(roots.items()), "run bigint, e bigint")
    nodes = steps.select("run", F.col("to").alias("e")).unionByName(first).distinct().mapInArrow(land, "run bigint, e bigint, chunk bigint")

    def follow(asked: pa.Table, known: pa.Table) -> pa.Table:
        at, to = (known[c].to_numpy() for c in ("at", "to"))
        order = np.argsort(at)
        entry = asked["e"].to_numpy()
        # A node lands in its chunk, so some stamp of it is at or after the node.
        return pa.table({"run": asked["run"], "e": asked["e"], "further": to[order][np.searchsorted(at[order], entry)]})

    jumps = stored(nodes.filter("chunk >= 0").groupBy("chunk").cogroup(steps.groupBy("chunk"))
                   .applyInArrow(follow, "run bigint, e bigint, further bigint"))
    reached, known = first, len(roots)
    while True:
        landed = reached.join(jumps, ["run", "e"]).select("run", F.col("further").alias("e"))
        reached = stored(reached.unionByName(landed).distinct())
        now = reached.count()
        if now == known:
            break
        known = now
        beyond = jumps.select("run", F.col("e").alias("further"), F.col("further").alias("_next"))
        jumps = stored(jumps.join(beyond, ["run", "further"]).select("run", "e", F.col("_next").alias("further")))
    return {(r.run, r.chunk): r.e for r in reached.mapInArrow(land, "run bigint, e bigint, chunk bigint").collect()}


def _pick(kept: DataFrame, keys: list[str], step: int, entries: dict[int, int]) -> DataFrame:
    """_first of the stamps that pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(batches, len(keys), step)
        if chunk.empty:
            return
        found = [p for part in range(len(chunk.bounds) - 1) for p in chunk.passing(part, entries[chunk.number] if part == 0 else _NEVER, step)[0]]
        for part in chunk.firsts.take(pa.array(found, pa.int64())).chunks:
            yield pa.RecordBatch.from_arrays([part], ["_first"])

    return kept.mapInArrow(run, T.StructType([kept.schema["_first"]]))
